"""Listing of files that have arrived in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Path, change time and length of the files below ``folder``; contents are not read."""
    found = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter=pattern)
        .load(folder)
    )
    return found.select(F.col("path").alias("s3_path"), "modificationTime", "length")


def total_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Length of the files at ``paths`` together; contents are not read."""
    lengths = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("length")
    return lengths.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]
