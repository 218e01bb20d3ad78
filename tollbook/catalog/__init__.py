"""Every operator as a query over the test tables, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = check
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load() -> None:
    """Import the modules that register queries."""
    from tollbook.catalog import files, manifest, quality, records, serving, warehouse  # noqa: F401
