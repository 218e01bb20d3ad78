"""Staging rows: clean records with the parts of their usage date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollbook.functions.dates import flexi_date, icc_date
from tollbook.functions.text import lenient_double


def with_date_parts(df: DataFrame, usage_date: Column) -> DataFrame:
    """Add year, month and day; NULL where the date is unknown, the row stays."""
    dated = df.withColumn("_usage_date", usage_date)
    parts = {"year": F.year("_usage_date"), "month": F.month("_usage_date"), "day": F.dayofmonth("_usage_date")}
    return dated.withColumns(parts).drop("_usage_date")


def stage_flexi(df: DataFrame) -> DataFrame:
    """Flexi staging rows."""
    return with_date_parts(df, flexi_date("record_opening_time"))


def stage_icc(df: DataFrame) -> DataFrame:
    """Icc staging rows."""
    timed = df.withColumn("used_duration", lenient_double("used_duration"))
    return with_date_parts(timed, icc_date("call_sta_time"))


def rows_per_day(staged: DataFrame) -> DataFrame:
    """Rows per day of their ingest (in UTC), date parts and batch: what pages are found by."""
    day = F.date_from_unix_date(F.floor(F.unix_seconds("_ingested_at") / 86_400).cast("int"))
    return staged.groupBy(day.alias("ingested_day"), "year", "month", "day", "batch_id").agg(F.count("*").alias("row_count"))
