"""Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tollbook.operators.shape import with_lineage


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of a Parquet folder; lineage already stored in it is kept."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return with_lineage(reader.parquet(path))
