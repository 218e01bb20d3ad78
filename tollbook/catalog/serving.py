"""Read queries; orders and events play the stored tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook import schemas as S
from tollbook.catalog import query, table
from tollbook.operators import paging, serving, staging
from tollbook.plans import pages
from tollbook.session import scratch_path
from tollbook.sinks.store import TableStore

FROM, TO = date(1996, 3, 15), date(1999, 12, 31)
RANGE = f"usage_date between date '{FROM}' and date '{TO}'"

SUMMARY = (
    "summary as (select cast(o_orderdate as date) as usage_date, upper(o_orderpriority) as call_type_code, "
    "count(*) as event_count, sum(cast(o_totalprice as decimal(18,2))) as total_used_duration from orders group by 1, 2)"
)
# Keys follow the digit the priorities start with; one of them is missing from the dimension.
FACT = (
    f"{SUMMARY}, fact as (select usage_date, cast(substr(call_type_code, 1, 1) as bigint) as call_type_key, event_count, "
    "cast(total_used_duration as decimal(18,2)) as total_used_duration from summary), "
    "dim as (select distinct cast(substr(call_type_code, 1, 1) as bigint) as call_type_key, call_type_code from summary "
    "where call_type_code <> '2-HIGH'), "
    "daily as (select f.usage_date, d.call_type_code, f.event_count, f.total_used_duration "
    "from fact f left join dim d on f.call_type_key = d.call_type_key)"
)


def summary(spark, folder):
    return (
        table(spark, folder, "orders")
        .groupBy(F.to_date("o_orderdate").alias("usage_date"), F.upper("o_orderpriority").alias("call_type_code"))
        .agg(
            F.count("*").alias("event_count"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("total_used_duration"),
        )
    )


def _key():
    return F.substring("call_type_code", 1, 1).cast("bigint").alias("call_type_key")


def fact(spark, folder):
    return summary(spark, folder).select("usage_date", _key(), "event_count", "total_used_duration")


def dim(spark, folder):
    return summary(spark, folder).where("call_type_code <> '2-HIGH'").select(_key(), "call_type_code").distinct()


@query(
    "usage_daily_page",
    f"with {FACT} select * from daily where {RANGE} order by usage_date desc nulls first, call_type_code nulls last, "
    "event_count nulls last, total_used_duration nulls last limit 50 offset 75",
)
def usage_daily_page(spark, folder):
    return serving.usage_daily_page(fact(spark, folder), dim(spark, folder), FROM, TO, limit=50, offset=75)


@query(
    "usage_daily_page_and_total",
    f"with {FACT} select *, (select count(*) from daily where {RANGE}) as total from daily where {RANGE} "
    "order by usage_date desc nulls first, call_type_code nulls last, event_count nulls last, total_used_duration nulls last limit 20 offset 40",
)
def usage_daily_page_and_total(spark, folder):
    """A page and the number of all rows from one call."""
    return serving.usage_daily_page(fact(spark, folder), dim(spark, folder), FROM, TO, limit=20, offset=40, include_total=True)


@query("usage_daily_total", f"with {FACT} select count(*) as total from daily where {RANGE}")
def usage_daily_total(spark, folder):
    return serving.usage_daily_total(fact(spark, folder), dim(spark, folder), FROM, TO)


@query(
    "usage_daily_total_of_type",
    f"with {FACT} select count(*) as total from daily where {RANGE} and upper(trim(call_type_code)) = '5-LOW'",
)
def usage_daily_total_of_type(spark, folder):
    return serving.usage_daily_total(fact(spark, folder), dim(spark, folder), FROM, TO, "5-Low")


@query(
    "usage_filter",
    f"with {SUMMARY} select usage_date, call_type_code, event_count, "
    "cast(total_used_duration as decimal(18,2)) as total_used_duration "
    f"from summary where {RANGE} and upper(trim(call_type_code)) = '1-URGENT'",
)
def usage_filter(spark, folder):
    return serving.filter_usage(summary(spark, folder), FROM, TO, "1-urgent")


TOTALS = (
    "cast(sum(event_count) as integer) as event_count, cast(sum(total_used_duration) as decimal(18,2)) as total_used_duration"
)


@query(
    "usage_summary_range",
    f"with {SUMMARY} select call_type_code, {TOTALS} from summary where {RANGE} group by 1",
)
def usage_summary_range(spark, folder):
    return serving.usage_summary_range(summary(spark, folder), FROM, TO)


@query(
    "usage_summary_totals",
    f"with {SUMMARY} select cast(sum(event_count) as bigint) as event_count, "
    f"cast(sum(total_used_duration) as decimal(28,2)) as total_used_duration from summary where {RANGE}",
)
def usage_summary_totals(spark, folder):
    return serving.usage_summary_totals(usage_summary_range(spark, folder))


@query(
    "usage_summary_with_totals",
    f"with {SUMMARY} select case when grouping(call_type_code) = 0 then call_type_code end as call_type_code, "
    "cast(sum(event_count) as bigint) as event_count, cast(sum(total_used_duration) as decimal(28,2)) as total_used_duration, "
    f"grouping(call_type_code) = 1 as is_total from summary where {RANGE} group by grouping sets ((call_type_code), ())",
)
def usage_summary_with_totals(spark, folder):
    return serving.usage_summary_with_totals(summary(spark, folder), FROM, TO)


@query(
    "usage_trend_day",
    f"with {SUMMARY} select strftime(usage_date, '%Y-%m-%d') as period, {TOTALS} from summary where {RANGE} group by 1",
)
def usage_trend_day(spark, folder):
    return serving.usage_trend(summary(spark, folder), FROM, TO, "day")


@query(
    "usage_trend_month",
    f"with {SUMMARY} select strftime(date_trunc('month', usage_date), '%Y-%m') as period, {TOTALS} from summary "
    f"where {RANGE} and upper(trim(call_type_code)) = '3-MEDIUM' group by 1",
)
def usage_trend_month(spark, folder):
    return serving.usage_trend(summary(spark, folder), FROM, TO, "month", "3-medium")


@query(
    "latest_daily",
    f"with {SUMMARY} select usage_date, call_type_code, event_count, "
    "cast(total_used_duration as decimal(18,2)) as total_used_duration "
    "from summary order by usage_date desc, call_type_code limit 50",
)
def latest_daily(spark, folder):
    return serving.latest_daily(summary(spark, folder))


STAMP = "yyyy-MM-dd HH:mm:ss"


def flexi(spark, folder):
    text = {"charging_id": "event_id", "record_sequence_number": "user_id", "served_msisdn": "user_id"}
    return table(spark, folder, "events").select(
        *[F.col(source).cast("string").alias(name) for name, source in text.items()],
        F.date_format("ts", STAMP).alias("record_opening_time"),
        F.lit("f1.csv").alias("ftp_filename"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.col("event_type").alias("_source_file"),
        F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("_ingested_at"),
    )


def shown(df):
    return df.withColumn("_ingested_at", F.date_format("_ingested_at", STAMP))


FLEXI = (
    "flexi as (select cast(event_id as varchar) as charging_id, cast(user_id as varchar) as record_sequence_number, "
    "strftime(ts, '%Y-%m-%d %H:%M:%S') as record_opening_time, cast(user_id as varchar) as served_msisdn, "
    "'f1.csv' as ftp_filename, cast(year(ts) as integer) as year, cast(month(ts) as integer) as month, "
    "cast(day(ts) as integer) as day, event_type as _source_file, "
    "strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') as _ingested_at from events)"
)
FLEXI_ORDER = "order by _ingested_at desc, charging_id, record_sequence_number, record_opening_time"


@query("staging_page_flexi", f"with {FLEXI} select * from flexi where year = 2024 and month = 1 {FLEXI_ORDER} limit 100 offset 250")
def staging_page_flexi(spark, folder):
    return shown(serving.staging_page_flexi(flexi(spark, folder), 2024, 1, limit=100, offset=250))


@query(
    "staging_page_undated",
    f"with {FLEXI} select * replace (cast(null as integer) as year, cast(null as integer) as month, "
    f"cast(null as integer) as day) from flexi {FLEXI_ORDER} limit 50",
)
def staging_page_undated(spark, folder):
    """A staging table from before the date parts were added."""
    return shown(serving.staging_page_flexi(flexi(spark, folder).drop("year", "month", "day")))


@query("staging_page_deep", f"with {FLEXI} select * from flexi {FLEXI_ORDER} limit 20000 offset 300")
def staging_page_deep(spark, folder):
    """A page too large to gather in one task."""
    return shown(serving.staging_page_flexi(flexi(spark, folder), limit=20_000, offset=300))


@query("staging_total", f"with {FLEXI} select count(*) as total from flexi where year = 2024 and month = 1 and day = 9")
def staging_total(spark, folder):
    return serving.staging_total(flexi(spark, folder), 2024, 1, 9)


BATCH = "concat('b', cast(day({time}) % 5 as {text}))"


def stored_flexi(spark, folder):
    """The staging rows in a store, written batch by batch with their counts."""
    store = TableStore(spark, scratch_path(spark, "store"))
    rows = flexi(spark, folder).withColumns({
        "record_type": F.lit(None).cast("string"), "duration": F.lit(None).cast("string"),
        "batch_id": F.expr(BATCH.format(time="_ingested_at", text="string")),
    })
    store.replace_partitions(rows, S.STAGING_FLEXI)
    store.append(staging.rows_per_day(store.read(S.STAGING_FLEXI)), S.DAYS_FLEXI)
    return store


@query(
    "staging_pages_by_token",
    f"with {FLEXI} select *, cast((row_number() over ({FLEXI_ORDER}) - 1) // 120 as integer) as page, "
    f"(select count(*) from flexi where year = 2024) as total from flexi where year = 2024 {FLEXI_ORDER} limit 480",
)
def staging_pages_by_token(spark, folder):
    """Four pages, each by the token of the one before, with the total."""
    store, token, made = stored_flexi(spark, folder), None, []
    for number in range(4):
        found = pages.staging_page(store, pages.FLEXI, 120, token, year=2024, include_total=True)
        made.append(shown(found.rows).withColumns({"page": F.lit(number), "total": F.lit(found.total).cast("bigint")}))
        token = found.token
        if token is None:
            break
    return reduce(DataFrame.unionByName, made)


@query(
    "records_by_number",
    f"with {FLEXI} select charging_id, record_sequence_number, record_opening_time from flexi where served_msisdn in ('7', '42')",
)
def records_by_number(spark, folder):
    found = serving.find_records(stored_flexi(spark, folder).read(S.STAGING_FLEXI), "served_msisdn", "7", "42")
    return found.select("charging_id", "record_sequence_number", "record_opening_time")


ICC = (
    "icc as (select cast(o_orderkey as varchar) as org_call_id, cast(o_custkey as varchar) as call_reference, "
    "strftime(o_orderdate, '%d/%m/%Y') as call_sta_time, o_orderpriority as call_type, o_totalprice as used_duration, "
    "o_orderstatus as _source_file, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as _ingested_at from orders)"
)


def icc_rows(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("org_call_id"),
        F.col("o_custkey").cast("string").alias("call_reference"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("call_sta_time"),
        F.col("o_orderpriority").alias("call_type"),
        F.col("o_totalprice").alias("used_duration"),
        F.col("o_orderstatus").alias("_source_file"),
        F.col("o_orderdate").cast("timestamp").alias("_ingested_at"),
    )


@query(
    "staging_page_icc",
    f"with {ICC} select * from icc order by _ingested_at desc, org_call_id, call_reference limit 200 offset 1000",
)
def staging_page_icc(spark, folder):
    return shown(serving.staging_page_icc(icc_rows(spark, folder), limit=200, offset=1000))


@query(
    "staging_page_icc_and_total",
    f"with {ICC} select *, (select count(*) from icc) as total from icc order by _ingested_at desc, org_call_id, call_reference limit 30 offset 60",
)
def staging_page_icc_and_total(spark, folder):
    return shown(serving.staging_page_icc(icc_rows(spark, folder), limit=30, offset=60, include_total=True))


@query(
    "deep_page",
    "select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem "
    "order by l_quantity desc, l_orderkey, l_linenumber, l_partkey limit 1000 offset 3000",
)
def deep_page(spark, folder):
    """Exact page far into a table where many rows share the leading sort value."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    order = [F.col("l_quantity").desc(), F.col("l_orderkey").asc(), F.col("l_linenumber").asc(), F.col("l_partkey").asc()]
    return paging.deep_page(items, order, 1000, 3000)
