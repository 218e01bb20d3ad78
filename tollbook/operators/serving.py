"""Read queries over the stored tables: pages, totals, range summaries and trends."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.functions.dates import check_year_month_day
from tollbook.operators.paging import newest_page, page
from tollbook.operators.shape import require_columns
from tollbook.schemas import FLEXI_KEYS, ICC_KEYS

MAX_USAGE_PAGE = 500
MAX_STAGING_PAGE = 1_000_000
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}

STAGING_FLEXI_COLUMNS = [
    "charging_id", "record_sequence_number", "record_opening_time", "served_msisdn", "ftp_filename",
    "year", "month", "day", "_source_file", "_ingested_at",
]
STAGING_ICC_COLUMNS = [
    "org_call_id", "call_reference", "call_sta_time", "call_type", "used_duration", "_source_file", "_ingested_at",
]


def _check_page(limit: int, offset: int, most: int) -> None:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}")
    if offset < 0:
        raise ValueError("offset must not be negative")


def _check_range(date_from: date, date_to: date) -> None:
    if date_to < date_from:
        raise ValueError(f"the range ends on {date_to}, before it begins on {date_from}")


def filter_usage(df: DataFrame, date_from: date, date_to: date, call_type: str | None = None) -> DataFrame:
    """Rows of an inclusive date range, and of one category if given (case ignored)."""
    return _of_type(_in_range(df, date_from, date_to), call_type)


def _in_range(df: DataFrame, date_from: date, date_to: date) -> DataFrame:
    _check_range(date_from, date_to)
    rows = df.where(F.col("usage_date").between(F.lit(date_from), F.lit(date_to)))
    if "usage_month" in df.columns:
        # Stored tables have a folder per month; others are not read. ``TableStore.read`` with the
        # months of ``months_between`` does not even list them.
        rows = rows.where(F.col("usage_month").between(F.lit(date_from.replace(day=1)), F.lit(date_to)))
    return rows


def _of_type(df: DataFrame, call_type: str | None) -> DataFrame:
    return df.where(F.upper(F.trim("call_type_code")) == call_type.upper()) if call_type else df


def _usage_daily(fact: DataFrame, dim: DataFrame, date_from: date, date_to: date, call_type: str | None) -> DataFrame:
    codes = dim.select("call_type_key", "call_type_code")
    amounts = _in_range(fact, date_from, date_to).select(
        "usage_date", "call_type_key", "event_count", "total_used_duration"
    )
    return _of_type(amounts.join(codes, "call_type_key", "left"), call_type)


def usage_daily_page(
    fact: DataFrame,
    dim: DataFrame,
    date_from: date,
    date_to: date,
    call_type: str | None = None,
    limit: int = 50,
    offset: int = 0,
    include_total: bool = False,
) -> DataFrame:
    """Fact rows with their category, newest date first; with ``include_total`` each says how many there are on all pages."""
    _check_page(limit, offset, MAX_USAGE_PAGE)
    rows = _usage_daily(fact, dim, date_from, date_to, call_type)
    columns = ["usage_date", "call_type_code", "event_count", "total_used_duration"]
    order = [F.col("usage_date").desc_nulls_first(), *[F.col(name).asc_nulls_last() for name in columns[1:]]]
    return _with_total(page(rows.select(*columns), order, limit, offset), rows, include_total)


def _with_total(shown: DataFrame, rows: DataFrame, include_total: bool) -> DataFrame:
    """The rows of a page, and beside them the number of all rows, counted in the same query."""
    return shown.withColumn("total", rows.agg(F.count("*")).scalar()) if include_total else shown


def usage_daily_total(
    fact: DataFrame, dim: DataFrame, date_from: date, date_to: date, call_type: str | None = None
) -> DataFrame:
    """Number of rows :func:`usage_daily_page` pages through."""
    return _usage_daily(fact, dim, date_from, date_to, call_type).agg(F.count("*").alias("total"))


def _totals():
    # The count is narrowed after summing; too large a count raises.
    events = F.sum(F.coalesce("event_count", F.lit(0))).cast("int")
    duration = F.sum(F.coalesce(F.col("total_used_duration"), F.lit(0).cast("decimal(18,2)"))).cast("decimal(18,2)")
    return events.alias("event_count"), duration.alias("total_used_duration")


def usage_summary_range(
    summary: DataFrame, date_from: date, date_to: date, call_type: str | None = None
) -> DataFrame:
    """Totals per category over a date range, busiest first."""
    rows = filter_usage(summary, date_from, date_to, call_type)
    return (
        rows.groupBy("call_type_code")
        .agg(*_totals())
        .orderBy(F.col("event_count").desc_nulls_first(), F.col("call_type_code").asc_nulls_last())
    )


def usage_summary_totals(range_rows: DataFrame) -> DataFrame:
    """Grand totals over the rows of :func:`usage_summary_range`; zeros without rows."""
    zero = F.lit(0).cast("decimal(28,2)")
    return range_rows.agg(
        F.coalesce(F.sum("event_count"), F.lit(0)).cast("bigint").alias("event_count"),
        F.coalesce(F.sum("total_used_duration"), zero).cast("decimal(28,2)").alias("total_used_duration"),
    )


def usage_summary_with_totals(
    summary: DataFrame, date_from: date, date_to: date, call_type: str | None = None
) -> DataFrame:
    """The rows of :func:`usage_summary_range` and, with ``is_total``, that of :func:`usage_summary_totals`, from one pass.

    Without rows in the range there is no total either; :func:`split_totals` gives zeros then.
    """
    rows = filter_usage(summary, date_from, date_to, call_type)
    events, duration = F.sum(F.coalesce("event_count", F.lit(0))), F.sum(F.coalesce(F.col("total_used_duration"), F.lit(0).cast("decimal(18,2)")))
    sets = rows.groupingSets([["call_type_code"], []], "call_type_code")
    both = sets.agg(events.alias("event_count"), duration.cast("decimal(28,2)").alias("total_used_duration"), F.grouping_id().alias("_level"))
    return both.select("call_type_code", "event_count", "total_used_duration", (F.col("_level") == 1).alias("is_total"))


def split_totals(both: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Range rows and grand totals out of the rows of :func:`usage_summary_with_totals`, as the two queries give them."""
    ranges = both.where("not is_total").select(
        "call_type_code", F.col("event_count").cast("int").alias("event_count"), F.col("total_used_duration").cast("decimal(18,2)").alias("total_used_duration")
    )
    order = [F.col("event_count").desc_nulls_first(), F.col("call_type_code").asc_nulls_last()]
    return ranges.orderBy(*order), usage_summary_totals(both.where("is_total").drop("call_type_code"))


def usage_trend(
    summary: DataFrame, date_from: date, date_to: date, grain: str = "day", call_type: str | None = None
) -> DataFrame:
    """Totals per day or month over a date range, oldest period first."""
    if grain not in GRAINS:
        raise ValueError(f"no grain {grain}; there are {' and '.join(GRAINS)}")
    period = F.date_format("usage_date", GRAINS[grain]).alias("period")
    rows = filter_usage(summary, date_from, date_to, call_type)
    return rows.groupBy(period).agg(*_totals()).orderBy(F.col("period").asc_nulls_last())


def latest_daily(summary: DataFrame, rows: int = 50) -> DataFrame:
    """Newest summary rows."""
    columns = ["usage_date", "call_type_code", "event_count", "total_used_duration"]
    order = [F.col("usage_date").desc_nulls_first(), F.col("call_type_code").asc_nulls_last()]
    return page(summary.select(*columns), order, rows)


def filter_staging(
    staging: DataFrame, year: int | None = None, month: int | None = None, day: int | None = None
) -> DataFrame:
    """Staging rows of a year, month or day; a frame without these columns serves only the open filter."""
    check_year_month_day(year, month, day)
    wanted = {name: value for name, value in (("year", year), ("month", month), ("day", day)) if year and value}
    rows = require_columns(staging, wanted, "staging")
    for name, value in wanted.items():
        rows = rows.where(F.col(name) == value)
    return rows


def staging_page_flexi(
    staging: DataFrame,
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
    limit: int = 50,
    offset: int = 0,
    include_total: bool = False,
) -> DataFrame:
    """Flexi staging rows, last ingested first; absent date parts read as NULL, ``include_total`` as for the usage page."""
    _check_page(limit, offset, MAX_STAGING_PAGE)
    rows = filter_staging(staging, year, month, day)
    absent = {name: F.lit(None).cast("int") for name in ("year", "month", "day") if name not in rows.columns}
    shown = rows.withColumns(absent).select(*STAGING_FLEXI_COLUMNS)
    found = newest_page(shown, "_ingested_at", [*FLEXI_KEYS, "_source_file"], limit, offset)
    return _with_total(found, rows, include_total)


def staging_page_icc(staging: DataFrame, limit: int = 50, offset: int = 0, include_total: bool = False) -> DataFrame:
    """Icc staging rows, last ingested first; ``include_total`` as for the usage page."""
    _check_page(limit, offset, MAX_STAGING_PAGE)
    shown = staging.select(*STAGING_ICC_COLUMNS)
    found = newest_page(shown, "_ingested_at", [*ICC_KEYS, "_source_file"], limit, offset)
    return _with_total(found, staging, include_total)


def find_records(staging: DataFrame, column: str, *values: str) -> DataFrame:
    """Staging rows with one of a few values in a lookup column; files and parts of files that can't hold them are skipped."""
    return staging.where(F.col(column).isin(*values))


def staging_total(
    staging: DataFrame, year: int | None = None, month: int | None = None, day: int | None = None
) -> DataFrame:
    """Number of staging rows a page query goes through."""
    return filter_staging(staging, year, month, day).agg(F.count("*").alias("total"))
