"""Pages of an ordered frame, near the start or far into it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollbook.session import shuffle_partitions_for, written_once

# Up to this many rows (offset + limit) every task may send its candidates to one task.
SHALLOW_ROWS = 10_000
# Estimates of joins can be far too large.
MOST_BYTES = 1 << 50


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    """Rows offset + 1 .. offset + limit of ``df`` in ``order``, which must leave no ties between different rows."""
    if offset + limit <= SHALLOW_ROWS:
        return df.orderBy(*order).offset(offset).limit(limit)
    return deep_page(df, order, limit, offset)


def deep_page(df: DataFrame, order: Sequence[Column], limit: int, offset: int) -> DataFrame:
    """The same page without gathering offset + limit rows from every task.

    Range partitions are written to the shared folder, one directory each. Their
    row counts tell which of them hold the page, and only those are read and ranked.
    """
    spark = df.sparkSession
    # Spark's estimate of the frame sizes the ranges, each of which one task puts in order.
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    ranges = shuffle_partitions_for(min(size, MOST_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranked = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(ranges, *order, F.col("_tie"))
    ordered = written_once(ranked.withColumn("_range", F.spark_partition_id()), "page", "_range")
    last = F.sum("rows").over(Window.orderBy("_range"))
    overlapping = (
        ordered.groupBy("_range")
        .agg(F.count("*").alias("rows"))
        .select("_range", (last - F.col("rows")).alias("_before"), "rows")
        .where((F.col("_before") < offset + limit) & (F.col("_before") + F.col("rows") > offset))
    )
    span = overlapping.agg(F.min("_range").alias("first"), F.max("_range").alias("last")).first()
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order, "_tie"))
    return (
        ordered.where(F.col("_range").between(span["first"], span["last"]))
        .withColumn("_rank", rank)
        .join(F.broadcast(overlapping.select("_range", "_before")), "_range")
        .where((F.col("_before") + F.col("_rank")).between(offset + 1, offset + limit))
        .orderBy("_range", "_rank")
        .select(*df.columns)
    )


def days_of_page(df: DataFrame, time: str, limit: int, offset: int) -> tuple[DataFrame, int]:
    """Part of ``df`` whose days of ``time`` hold the page newest first, and the offset inside it.

    One pass over the ``time`` column counts rows per day; rows without a time
    come first. The page query then reads only the days it needs.
    """
    newest = F.col("day").desc_nulls_first()
    through = F.sum("rows").over(Window.orderBy(newest))
    needed = (
        df.groupBy(F.to_date(time).alias("day"))
        .agg(F.count("*").alias("rows"))
        .select("day", "rows", (through - F.col("rows")).alias("before"))
        .where((F.col("before") < offset + limit) & (F.col("before") + F.col("rows") > offset))
        .agg(
            F.min("day").alias("oldest"),
            F.max("day").alias("newest"),
            F.bool_or(F.col("day").isNull()).alias("undated"),
            F.min("before").alias("skipped"),
        )
        .first()
    )
    if needed["skipped"] is None:
        return df.where(F.lit(False)), 0
    inside = F.lit(False)
    if needed["oldest"] is not None:
        inside = (F.col(time) >= F.lit(needed["oldest"])) & (
            F.col(time) < F.lit(needed["newest"] + timedelta(days=1))
        )
    if needed["undated"]:
        inside = inside | F.col(time).isNull()
    return df.where(inside), offset - needed["skipped"]


def newest_page(df: DataFrame, time: str, ties: Sequence[str], limit: int, offset: int = 0) -> DataFrame:
    """Page by ``time`` descending; ``ties`` settle the order of equal times."""
    part, rest = days_of_page(df, time, limit, offset)
    order = [F.col(time).desc_nulls_first(), *[F.col(name).asc_nulls_last() for name in ties]]
    return page(part, order, limit, rest)
