"""Daily fact, its curated and stored forms, and the summary."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.functions.dates import date_key, date_of_key
from tollbook.functions.text import fixed_amount
from tollbook.operators.dimensions import unique_keys
from tollbook.session import broadcast_within

# Columns of the fact and the summary.
FACT_COLUMNS = ["date_key", "call_type_key", "call_type_code", "event_count", "total_used_duration"]
CURATED_COLUMNS = ["date_key", "call_type_key", "usage_date", "call_type_code", "event_count", "total_used_duration"]
SUMMARY_COLUMNS = ["usage_date", "call_type_key", "call_type_code", "event_count", "total_used_duration"]


def fact_usage_daily(daily: DataFrame, dim: DataFrame, broadcast_rows: int | None = None) -> DataFrame:
    """Daily aggregate with its keys; rows without a date or a known category are left out.

    With ``broadcast_rows`` the dimension is counted up to that many rows and the lookup
    broadcast if it fits. Without it adaptive execution decides by the measured size.
    """
    lookup = unique_keys(dim)
    if broadcast_rows is not None:
        lookup = broadcast_within(lookup, broadcast_rows, counted=dim)
    return (
        daily.where("usage_date is not null")
        .join(lookup, "call_type_code")
        .where("call_type_key is not null")
        .select(
            date_key("usage_date").alias("date_key"),
            F.col("call_type_key").cast("bigint").alias("call_type_key"),
            "call_type_code",
            "event_count",
            F.coalesce("total_used_duration", F.lit(0.0)).alias("total_used_duration"),
        )
    )


def curate_fact(fact: DataFrame) -> DataFrame:
    """Fact rows with the date spelled out."""
    return fact.withColumn("usage_date", date_of_key("date_key")).select(*CURATED_COLUMNS)


def stored_fact(curated: DataFrame) -> DataFrame:
    """Curated rows as the warehouse keeps them: category column renamed, fixed-point total."""
    return curated.select(
        "date_key",
        "call_type_key",
        "usage_date",
        F.col("call_type_code").alias("call_type"),
        "event_count",
        fixed_amount("total_used_duration").alias("total_used_duration"),
    )


def usage_summary_daily(curated: DataFrame) -> DataFrame:
    """Summary rows of a batch: a projection, the fact has this grain already."""
    return curated.select(*SUMMARY_COLUMNS)


def with_month(df: DataFrame) -> DataFrame:
    """Add the first day of the month, the folder a row is stored in."""
    return df.withColumn("usage_month", F.trunc("usage_date", "month"))


def months_of(incoming: DataFrame) -> list[date]:
    """Months that occur in ``incoming``: a few values, by which stored folders are named."""
    return sorted(row[0] for row in with_month(incoming).select("usage_month").distinct().collect())


def replace_dates(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Existing rows of other dates plus all incoming rows."""
    touched = incoming.select("usage_date").distinct()
    return existing.join(touched, "usage_date", "left_anti").unionByName(incoming)


def accumulate_dates(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Summary of every date in ``incoming``, rebuilt from all stored fact rows of that date.

    ``stored`` must hold the incoming rows already.
    """
    touched = incoming.select("usage_date").distinct()
    return (
        stored.join(touched, "usage_date", "left_semi")
        .groupBy("usage_date", "call_type_key", F.col("call_type").alias("call_type_code"))
        .agg(
            F.sum("event_count").alias("event_count"),
            F.sum("total_used_duration").cast("decimal(18,2)").alias("total_used_duration"),
        )
        .select(*SUMMARY_COLUMNS)
    )
