"""Database tables and queries."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 10_000


@dataclass(frozen=True)
class Split:
    """Parallel scan: ranges of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int


def jdbc_options(
    url: str, source: str, connection: Mapping[str, str], split: Split | None = None
) -> dict[str, str]:
    """Reader options. A ``source`` starting with SELECT runs in the database as a derived table."""
    is_query = source.lstrip().lower().startswith("select")
    options = {
        "url": url,
        "dbtable": f"({source}) source_query" if is_query else source,
        "fetchsize": str(FETCH_ROWS),
        **connection,
    }
    if split:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": split.lower,
            "upperBound": split.upper,
            "numPartitions": str(split.partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession, url: str, source: str, connection: Mapping[str, str], split: Split | None = None
) -> DataFrame:
    """Scan a table or query. Without ``split`` one task reads it all, so pass one for large sources."""
    return spark.read.format("jdbc").options(**jdbc_options(url, source, connection, split)).load()
