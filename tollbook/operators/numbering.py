"""Consecutive numbers without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the key digest that form a group: 16 ** 3 = 4096 groups at most.
GROUP_DIGITS = 3


def next_after(existing: DataFrame, column: str) -> Column:
    """Largest value of ``column`` as a scalar subquery, 0 for an empty frame."""
    return F.coalesce(existing.agg(F.max(column)).scalar(), F.lit(0))


def number_rows(df: DataFrame, key: str, number: str, after: Column) -> DataFrame:
    """Add ``number``: after + 1, after + 2, ... over rows with distinct string ``key``.

    The order is (digest prefix, key), hence repeatable. Rows are ranked inside
    their digest group; a running total over the group sizes, at most 4096 rows,
    gives each group its start.
    """
    grouped = df.withColumn("_group", F.substring(F.md5(F.col(key).cast("binary")), 1, GROUP_DIGITS))
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        grouped.groupBy("_group")
        .agg(F.count("*").alias("_size"))
        .select("_group", (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) + after).alias("_start"))
    )
    rank = F.row_number().over(Window.partitionBy("_group").orderBy(key))
    return (
        grouped.withColumn("_rank", rank)
        .join(F.broadcast(starts), "_group")
        .withColumn(number, (F.col("_start") + F.col("_rank")).cast("bigint"))
        .drop("_group", "_start", "_rank")
    )
