"""Daily aggregate, dimensions, fact and summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from tollbook.catalog import inputs as I
from tollbook.catalog import query, table
from tollbook.catalog.records import staged_through_table
from tollbook.functions.dates import date_key, date_of_key
from tollbook.functions.text import fixed_amount
from tollbook.operators import dimensions, facts, usage
from tollbook.schemas import FACT_USAGE_DAILY
from tollbook.session import scratch_path, written_once
from tollbook.sinks.store import TableStore

SPLIT = "2024-01-16"


def daily(spark, folder, salt_buckets=None):
    """Daily usage of the events, which are clean."""
    staged = table(spark, folder, "events").select(
        F.col("event_id").alias("charging_id"),
        F.col("event_type").alias("record_type"),
        F.col("value").alias("duration"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
    )
    return usage.daily_usage(usage.prepare_usage(staged), salt_buckets)


def daily_once(spark, folder):
    """The same, written first where a query uses it several times: the events are scanned once."""
    return written_once(daily(spark, folder), "daily")


def rounded(df):
    return df.withColumn("total_used_duration", F.round("total_used_duration", 2))


DAILY = (
    "daily as (select cast(ts as date) as usage_date, upper(trim(event_type)) as call_type_code, "
    "count(*) as event_count, sum(value) as total_used_duration from events group by 1, 2)"
)
DAILY_SHOWN = "usage_date, call_type_code, event_count, round(total_used_duration, 2) as total_used_duration"


@query("daily_usage", f"with {DAILY} select {DAILY_SHOWN} from daily")
def daily_usage(spark, folder):
    return rounded(daily(spark, folder))


@query("daily_usage_salted", f"with {DAILY} select {DAILY_SHOWN} from daily")
def daily_usage_salted(spark, folder):
    return rounded(daily(spark, folder, salt_buckets=8))


@query(
    "daily_usage_hot_salted",
    "with usage as (select cast(l_shipdate as date) as usage_date, case when l_orderkey % 5 < 2 then 'BULK' else concat(l_returnflag, l_linestatus) end as code, "
    "l_quantity from lineitem), shares as (select code, count(*) > 0.3 * (select count(*) from usage) as salted from usage group by code) "
    "select usage_date, code as call_type_code, count(*) as event_count, round(sum(l_quantity), 2) as total_used_duration, salted "
    "from usage join shares using (code) group by usage_date, code, salted",
)
def daily_usage_hot_salted(spark, folder):
    """Two fifths of the rows are of one category: a sketch finds it, and with the others above the share it is spread."""
    prepared = table(spark, folder, "lineitem").select(
        F.to_date("l_shipdate").alias("usage_date"),
        F.when(F.col("l_orderkey") % 5 < 2, "BULK").otherwise(F.concat("l_returnflag", "l_linestatus")).alias("call_type_code"),
        F.col("l_quantity").alias("used_duration"), F.col("l_orderkey").alias("record_id"),
    )
    hot = usage.hot_categories(prepared, 0.3)
    return rounded(usage.daily_usage(prepared, 8, hot)).withColumn("salted", F.col("call_type_code").isin(*hot))


@query("daily_usage_cleaned", f"with {I.DAILY_FLEXI} select {DAILY_SHOWN} from daily")
def daily_usage_cleaned(spark, folder):
    """From raw records: clean, write, stage, prepare, aggregate."""
    return rounded(usage.daily_usage(usage.prepare_usage(staged_through_table(spark, folder))))


@query(
    "daily_usage_lineitem",
    "select cast(l_shipdate as date) as usage_date, concat(l_returnflag, l_linestatus) as call_type_code, "
    "count(*) as event_count, round(sum(l_quantity), 2) as total_used_duration from lineitem group by 1, 2",
)
def daily_usage_lineitem(spark, folder):
    """The largest table as usage records."""
    staged = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("charging_id"),
        F.concat("l_returnflag", "l_linestatus").alias("record_type"),
        F.col("l_quantity").alias("duration"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.dayofmonth("l_shipdate").alias("day"),
    )
    return rounded(usage.daily_usage(usage.prepare_usage(staged)))


DATES = (
    "dates as (select cast(strftime(d, '%Y%m%d') as integer) as date_key, d as full_date, "
    "cast(day(d) as smallint) as day_of_month, cast(month(d) as smallint) as month_of_year, "
    "cast(quarter(d) as smallint) as quarter_of_year, cast(year(d) as integer) as year_number, "
    "cast(weekofyear(d) as smallint) as week_of_year, strftime(d, '%a') as day_name, strftime(d, '%b') as month_name, "
    "dayofweek(d) in (0, 6) as is_weekend from (select distinct usage_date as d from daily))"
)


@query("dim_date", f"with {DAILY}, {DATES} select * from dates")
def dim_date(spark, folder):
    return dimensions.dim_date(daily(spark, folder))


@query("dim_date_new", f"with {DAILY}, {DATES} select * from dates where full_date >= date '{SPLIT}'")
def dim_date_new(spark, folder):
    candidates = dim_date(spark, folder)
    existing = candidates.where(F.col("full_date") < SPLIT)
    return dimensions.new_members(candidates, existing, "date_key")


CODES = "codes as (select distinct call_type_code from daily)"
EXISTING = (
    "existing as (select case call_type_code when 'VIEW' then 1 else 2 end as call_type_key, call_type_code, "
    "call_type_code as call_type_name, true as is_active from codes where call_type_code in ('VIEW', 'ERROR'))"
)
ADDED = (
    "added as (select (select max(call_type_key) from existing) + "
    "row_number() over (order by substr(md5(call_type_code), 1, 3), call_type_code) as call_type_key, call_type_code, "
    "call_type_code as call_type_name, true as is_active "
    "from codes where call_type_code not in (select call_type_code from existing))"
)
MEMBERS = f"{CODES}, {EXISTING}, {ADDED}, members as (select * from existing union all select * from added)"
MEMBERS_SHOWN = "cast(call_type_key as bigint) as call_type_key, call_type_code, call_type_name, is_active"


def existing_types(days):
    known = dimensions.dim_call_type(days).where("call_type_code in ('VIEW', 'ERROR')")
    key = F.when(F.col("call_type_code") == "VIEW", 1).otherwise(2).cast("bigint")
    return known.select(key.alias("call_type_key"), "call_type_code", "call_type_name", "is_active")


def added_types(days):
    existing = existing_types(days)
    fresh = dimensions.new_members(dimensions.dim_call_type(days), existing, "call_type_code")
    return dimensions.assign_call_type_keys(fresh, existing)


def all_types(days):
    return existing_types(days).unionByName(added_types(days))


@query(
    "dim_call_type",
    f"with {DAILY}, {CODES} select call_type_code, call_type_code as call_type_name, true as is_active from codes",
)
def dim_call_type(spark, folder):
    return dimensions.dim_call_type(daily(spark, folder))


@query("dim_call_type_keys", f"with {DAILY}, {MEMBERS} select {MEMBERS_SHOWN} from added")
def dim_call_type_keys(spark, folder):
    return added_types(daily_once(spark, folder))


@query("dim_new_members", f"with {DAILY}, {MEMBERS} select {MEMBERS_SHOWN} from members")
def dim_new_members(spark, folder):
    return all_types(daily_once(spark, folder))


@query(
    "dim_lookup_subset",
    f"with {DAILY}, {MEMBERS} select call_type_code, cast(call_type_key as bigint) as call_type_key from members "
    "where call_type_code in (select upper(event_type) from events where value > 50 and event_type < 'p')",
)
def dim_lookup_subset(spark, folder):
    codes = table(spark, folder, "events").where("value > 50 and event_type < 'p'").select(F.upper("event_type").alias("call_type_code"))
    return dimensions.lookup_codes(all_types(daily_once(spark, folder)), codes)


# One category is left out of the dimension, so its rows must not reach the fact.
FACT = (
    f"{DAILY}, {MEMBERS}, fact as (select cast(strftime(usage_date, '%Y%m%d') as integer) as date_key, "
    "cast(call_type_key as bigint) as call_type_key, usage_date, d.call_type_code, event_count, "
    "round(coalesce(total_used_duration, 0), 2) as total_used_duration "
    "from daily d join members m on d.call_type_code = m.call_type_code where d.call_type_code <> 'SIGNUP')"
)


def fact(spark, folder):
    days = daily_once(spark, folder)
    known = all_types(days).where("call_type_code <> 'SIGNUP'")
    return facts.fact_usage_daily(days, known)


@query(
    "fact_usage_daily",
    f"with {FACT} select date_key, call_type_key, call_type_code, event_count, total_used_duration from fact",
)
def fact_usage_daily(spark, folder):
    return rounded(fact(spark, folder))


@query("fact_curated", f"with {FACT} select * from fact")
def fact_curated(spark, folder):
    return rounded(facts.curate_fact(fact(spark, folder)))


STORED = (
    "select date_key, call_type_key, usage_date, call_type_code as call_type, event_count, "
    "cast(total_used_duration as decimal(18,2)) as total_used_duration from fact"
)


@query("fact_append", f"with {FACT} {STORED} where usage_date < date '{SPLIT}' union all {STORED}")
def fact_append(spark, folder):
    """Rows of an earlier batch stay when a batch with the same dates is added; adding it again changes nothing."""
    rows = written_once(facts.with_month(facts.stored_fact(rounded(facts.curate_fact(fact(spark, folder))))), "fact")
    store = TableStore(spark, scratch_path(spark, "store"))
    for batch_id, part in (("b1", rows.where(F.col("usage_date") < SPLIT)), ("b2", rows), ("b2", rows)):
        store.put_batch(part, FACT_USAGE_DAILY, batch_id)
    added = store.read(FACT_USAGE_DAILY)
    return added.select("date_key", "call_type_key", "usage_date", "call_type", "event_count", "total_used_duration")


@query("fact_months_merged", f"with {FACT} {STORED} where usage_date < date '{SPLIT}' union all {STORED}")
def fact_months_merged(spark, folder):
    """The rows of two batches after their months were brought together, twice."""
    rows = written_once(facts.with_month(facts.stored_fact(rounded(facts.curate_fact(fact(spark, folder))))), "fact")
    store = TableStore(spark, scratch_path(spark, "store"))
    for batch_id, part in (("b1", rows.where(F.col("usage_date") < SPLIT)), ("b2", rows)):
        store.put_batch(part, FACT_USAGE_DAILY, batch_id)
    for _ in range(2):
        store.merge_partitions(FACT_USAGE_DAILY, store.pointer(FACT_USAGE_DAILY).folders)
    merged = store.read(FACT_USAGE_DAILY)
    return merged.select("date_key", "call_type_key", "usage_date", "call_type", "event_count", "total_used_duration")


@query(
    "insert_time",
    f"with {FACT} select usage_date, call_type_code as call_type, true as stamped from fact",
)
def insert_time(spark, folder):
    """Stored rows carry the time of their insert."""
    begun = spark.sql("select current_timestamp()").first()[0]
    store = TableStore(spark, scratch_path(spark, "store"))
    rows = facts.with_month(facts.stored_fact(facts.curate_fact(fact(spark, folder))))
    store.put_batch(rows, FACT_USAGE_DAILY, "b1", checked=True)
    stamped = F.col("created_at").between(F.lit(begun), F.current_timestamp())
    return store.read(FACT_USAGE_DAILY).select("usage_date", "call_type", stamped.alias("stamped"))


SUMMARY_SHOWN = "usage_date, call_type_key, call_type_code, event_count, total_used_duration"


@query("usage_summary_daily", f"with {FACT} select {SUMMARY_SHOWN} from fact")
def usage_summary_daily(spark, folder):
    return rounded(facts.usage_summary_daily(facts.curate_fact(fact(spark, folder))))


@query(
    "summary_replace_dates",
    f"with {FACT} select usage_date, call_type_key, call_type_code, event_count, total_used_duration, 'old' as batch "
    f"from fact where usage_date < date '{SPLIT}' union all select usage_date, call_type_key, call_type_code, "
    f"event_count + 1, total_used_duration, 'new' from fact where usage_date >= date '{SPLIT}'",
)
def summary_replace_dates(spark, folder):
    rows = written_once(usage_summary_daily(spark, folder), "summary")
    old = rows.withColumn("batch", F.lit("old"))
    new = rows.where(F.col("usage_date") >= SPLIT).withColumns(
        {"event_count": F.col("event_count") + 1, "batch": F.lit("new")}
    )
    return facts.replace_dates(old, new)


@query(
    "summary_accumulate",
    f"with {FACT} select usage_date, call_type_key, call_type_code, cast(2 * event_count as bigint) as event_count, "
    "cast(2 * total_used_duration as decimal(18,2)) as total_used_duration "
    f"from fact where usage_date >= date '{SPLIT}'",
)
def summary_accumulate(spark, folder):
    """Two batches with the same dates in the fact, the second one being the incoming."""
    curated = written_once(rounded(facts.curate_fact(fact(spark, folder))), "curated")
    incoming = curated.where(F.col("usage_date") >= SPLIT)
    stored = facts.stored_fact(curated.unionByName(incoming))
    return facts.accumulate_dates(stored, incoming)


@query(
    "date_key_roundtrip",
    "select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as integer) as date_key, "
    "cast(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') as date) as usage_date from orders",
)
def date_key_roundtrip(spark, folder):
    keyed = table(spark, folder, "orders").select("o_orderkey", date_key("o_orderdate").alias("date_key"))
    return keyed.withColumn("usage_date", date_of_key("date_key"))


@query(
    "duration_fixed_point",
    "select l_orderkey, l_linenumber, cast(l_extendedprice as decimal(18,2)) as amount from lineitem",
)
def duration_fixed_point(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", fixed_amount("l_extendedprice").alias("amount")
    )
