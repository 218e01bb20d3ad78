"""Rules and backfills; holes are made by case expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tollbook.catalog import query, table
from tollbook.catalog.warehouse import DAILY, FACT, MEMBERS, all_types, daily_once, fact
from tollbook.operators import dimensions, facts, quality, shape
from tollbook.session import written_once

HOLES = (
    "holes as (select case when day(usage_date) % 3 = 0 then null else cast(strftime(usage_date, '%Y%m%d') as integer) "
    "end as date_key, case when day(usage_date) % 2 = 0 then null else cast(call_type_key as bigint) end as call_type_key, "
    "usage_date, concat(' ', lower(d.call_type_code)) as call_type, event_count from daily d left join members m "
    "on d.call_type_code = m.call_type_code and d.call_type_code <> 'SIGNUP')"
)


def holes(spark, folder):
    days = daily_once(spark, folder)
    known = all_types(days).where("call_type_code <> 'SIGNUP'").select("call_type_code", "call_type_key")
    rows = days.join(known, "call_type_code", "left")
    day = F.dayofmonth("usage_date")
    return rows.select(
        F.when(day % 3 != 0, F.date_format("usage_date", "yyyyMMdd").cast("int")).alias("date_key"),
        F.when(day % 2 != 0, F.col("call_type_key")).alias("call_type_key"),
        "usage_date",
        F.concat(F.lit(" "), F.lower("call_type_code")).alias("call_type"),
        "event_count",
    )


@query(
    "backfill_date_key",
    f"with {DAILY}, {MEMBERS}, {HOLES} select coalesce(date_key, cast(strftime(usage_date, '%Y%m%d') as integer)) "
    "as date_key, call_type_key, usage_date, call_type, event_count from holes",
)
def backfill_date_key(spark, folder):
    return quality.backfill_date_key(holes(spark, folder))


@query(
    "backfill_call_type_key",
    f"with {DAILY}, {MEMBERS}, {HOLES} select date_key, coalesce(h.call_type_key, cast(m.call_type_key as bigint)) "
    "as call_type_key, usage_date, call_type, event_count from holes h "
    "left join members m on upper(trim(h.call_type)) = m.call_type_code",
)
def backfill_call_type_key(spark, folder):
    return quality.backfill_call_type_key(holes(spark, folder), all_types(daily_once(spark, folder)))


@query(
    "fk_orphans",
    f"with {FACT} select date_key, usage_date, call_type_code, event_count from fact where day(usage_date) % 3 = 0",
)
def fk_orphans(spark, folder):
    """Fact rows whose date is missing from a dimension that lacks every third day of a month."""
    rows = written_once(facts.curate_fact(fact(spark, folder)), "curated")
    known = dimensions.dim_date(rows.where(F.dayofmonth("usage_date") % 3 != 0))
    return quality.orphans(rows, known, "date_key").select("date_key", "usage_date", "call_type_code", "event_count")


@query(
    "required_columns",
    "select user_id, event_type, count(*) as rows, true as refused from events group by user_id, event_type",
)
def required_columns(spark, folder):
    """A frame with the columns passes; without one of them it is refused."""
    events = table(spark, folder, "events")
    try:
        shape.require_columns(events.drop("event_type"), ["user_id", "event_type"], "events")
        refused = False
    except ValueError:
        refused = True
    passed = shape.require_columns(events, ["user_id", "event_type"], "events")
    return passed.groupBy("user_id", "event_type").agg(F.count("*").alias("rows"), F.lit(refused).alias("refused"))


@query(
    "empty_tables",
    " union all ".join(
        f"select '{name}' as table_name, (select count(*) from {name} where {test}) = 0 as is_empty"
        for name, test in (("events", "value < 0"), ("events", "value >= 0"), ("orders", "true"), ("orders", "false"))
    ),
)
def empty_tables(spark, folder):
    """The test a batch makes before it adds members; each table is read up to its first row."""
    tests = (("events", "value < 0"), ("events", "value >= 0"), ("orders", "true"), ("orders", "false"))
    made = [quality.empty_tables({name: table(spark, folder, name).where(test)}) for name, test in tests]
    return made[0].union(made[1]).union(made[2]).union(made[3])


@query(
    "pk_violations",
    "select user_id, event_type, count(*) as rows from events group by user_id, event_type having count(*) > 1",
)
def pk_violations(spark, folder):
    return quality.duplicate_keys(table(spark, folder, "events"), ["user_id", "event_type"])


@query(
    "not_null_violations",
    f"with {DAILY}, {MEMBERS}, {HOLES} select 'date_key is null' as rule, count(*) as violations from holes "
    "where date_key is null union all select 'call_type_key is null', count(*) from holes where call_type_key is null "
    "union all select 'usage_date is null', count(*) from holes where usage_date is null "
    "union all select 'call_type over 5', count(*) from holes where length(call_type) > 5",
)
def not_null_violations(spark, folder):
    required = ["date_key", "call_type_key", "usage_date"]
    return quality.rule_violations(holes(spark, folder), required, {"call_type": 5})


@query(
    "table_counts",
    " union all ".join(f"select '{name}' as table_name, count(*) as rows from {name}" for name in ("events", "orders", "lineitem")),
)
def table_counts(spark, folder):
    return quality.table_counts({name: table(spark, folder, name) for name in ("events", "orders", "lineitem")})
