"""Delimited record files with a header row."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollbook.operators.shape import fit_to_schema, with_lineage
from tollbook.schemas import LINEAGE_COLUMNS, LINEAGE_SCHEMA
from tollbook.session import empty_frame


def empty_records(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, with the columns of ``schema`` and lineage."""
    return empty_frame(spark, T.StructType(schema.fields + LINEAGE_SCHEMA.fields))


def _reader(spark: SparkSession) -> DataFrameReader:
    # enforceSchema=false makes Spark compare every file's header with the columns in use.
    return spark.read.options(header=True, inferSchema=False, enforceSchema=False, mode="PERMISSIVE")


def first_lines(spark: SparkSession, paths: Sequence[str]) -> list[Row]:
    """``file, line``: the first line of every file, in one job whose tasks stop after the lines they need."""

    def head(batches):
        # A task reads one block; only the first line of the first block is a header.
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    # As dear to open as a whole block: no two files share a task.
    spark.conf.set(key, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        lines = spark.read.text(list(paths)).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), F.col("value").alias("line")
        )
        return lines.mapInArrow(head, "file string, begin long, line string").where("begin = 0").collect()
    finally:
        spark.conf.set(key, before)


def paths_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their header: one job for all first lines, and the names of each different one."""
    lines: dict[str, list[str]] = defaultdict(list)
    for row in first_lines(spark, paths):
        lines[row["line"]].append(unquote(row["file"]))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for files in lines.values():
        groups[tuple(_reader(spark).csv(files[0]).columns)] += files
    return dict(groups)


def read_csv_records(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, same_header: bool = False
) -> DataFrame:
    """Records of the files fitted to ``schema``, with source file and ingest time.

    ``same_header`` requires one header for all files and fails otherwise. By
    default files are read per header, so added or reordered columns do no harm.
    """
    if not paths:
        return empty_records(spark, schema)
    if same_header:
        frames = [_reader(spark).csv(list(paths))]
    else:
        frames = [
            _reader(spark).schema(T.StructType([T.StructField(name, T.StringType()) for name in names])).csv(group)
            for names, group in paths_by_header(spark, paths).items()
        ]
    fitted = [fit_to_schema(with_lineage(frame), schema, keep=LINEAGE_COLUMNS) for frame in frames]
    return reduce(DataFrame.unionByName, fitted) if fitted else empty_records(spark, schema)
