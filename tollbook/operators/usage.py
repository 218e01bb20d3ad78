"""Daily usage aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.functions.text import plain_double, usage_code


def prepare_usage(
    staged: DataFrame,
    record_id: str = "charging_id",
    category: str = "record_type",
    duration: str = "duration",
) -> DataFrame:
    """Dated usage rows from staging rows; rows without a date are left out.

    The parts of a date are all known or all NULL. Icc rows fit as well: pass their column names.
    """
    return staged.where("year is not null").select(
        F.make_date("year", "month", "day").alias("usage_date"),
        usage_code(category).alias("call_type_code"),
        plain_double(duration).alias("used_duration"),
        F.col(record_id).alias("record_id"),
    )


#: Categories that the sketch reports at most, and counters it holds for them.
TOP, COUNTERS = 64, 4096


def hot_categories(prepared: DataFrame, share: float) -> list[str]:
    """Categories with more than ``share`` of the rows, by a sketch of heavy hitters: one row leaves the tasks.

    The sketch never counts a category too low by more than its bound, far below any share worth salting, and at most
    ``1 / share`` categories have so many rows.
    """
    code = F.col("call_type_code")
    found = prepared.agg(F.expr(f"approx_top_k(call_type_code, {TOP}, {COUNTERS})").alias("top"), F.count(code).alias("rows")).first()
    return sorted(t["item"] for t in found["top"] or [] if t["item"] is not None and t["count"] > share * found["rows"])


def daily_usage(prepared: DataFrame, salt_buckets: int | None = None, hot: Sequence[str] | None = None) -> DataFrame:
    """Record count and total duration per date and category.

    Partial aggregation already sends one row per task and group. ``salt_buckets``
    adds a level between, for when so many tasks feed one hot group that its
    final step is slow; the result is the same. With ``hot``, as from :func:`hot_categories`,
    only rows of these categories are spread, and without any there is no further level.
    """
    if hot is not None and not hot:
        salt_buckets = None
    group = ["usage_date", "call_type_code"]
    if not salt_buckets:
        return prepared.groupBy(*group).agg(
            F.count("*").alias("event_count"), F.sum("used_duration").alias("total_used_duration")
        )
    # The salt covers the whole row, so one hot id, or NULL ids, still spread.
    salt = F.pmod(F.xxhash64(*prepared.columns), F.lit(salt_buckets))
    if hot is not None:
        salt = F.when(F.col("call_type_code").isin(*hot), salt).otherwise(F.lit(0))
    partly = (
        prepared.withColumn("_salt", salt)
        .groupBy(*group, "_salt")
        .agg(F.count("*").alias("event_count"), F.sum("used_duration").alias("total_used_duration"))
    )
    return partly.groupBy(*group).agg(
        F.sum("event_count").alias("event_count"), F.sum("total_used_duration").alias("total_used_duration")
    )
