"""Every registered query against its SQL, and the plans of the larger ones."""

import os
import re

import pytest

import __spark_entry__ as entry
from compare import database, difference
from tollbook import catalog
from tollbook.functions.dates import months_between
from tollbook.operators import serving
from tollbook.schemas import USAGE_SUMMARY_DAILY
from tollbook.sinks.store import TableStore

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


#: Queries that compare no rows at the smallest size.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_its_check():
    assert catalog.QUERIES.keys() == catalog.CHECKS.keys()
    assert catalog.QUERIES.keys() <= entry.queries().keys()


def test_entry(spark):
    assert entry.entry(spark).columns == ["usage_date", "call_type_code", "event_count", "total_used_duration"]


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_check(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    assert name in MAY_BE_EMPTY or not df.isEmpty()
    assert difference(df, con, entry.oracle_sql()[name]) is None
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan(df))


def test_scans_read_only_the_columns_in_use(spark):
    text = plan(entry.queries()["daily_usage_lineitem"](spark, FOLDER))
    assert re.search(r"ReadSchema: struct<l_quantity:double,l_returnflag:string,l_linestatus:string,l_shipdate", text)
    assert "PushedFilters: [IsNotNull(l_shipdate)]" in text


def test_date_ranges_prune_stored_months(spark, tmp_path):
    from datetime import date

    from pyspark.sql import functions as F

    store = TableStore(spark, str(tmp_path / "t"))
    days = spark.sql("select explode(sequence(date'2024-01-30', date'2024-03-02')) as usage_date")
    rows = days.withColumns({"usage_month": F.trunc("usage_date", "month"), "event_count": F.lit(1)})
    empty = {f.name: F.lit(None).cast(f.dataType) for f in USAGE_SUMMARY_DAILY.schema if f.name not in rows.columns}
    store.replace_partitions(rows.withColumns(empty), USAGE_SUMMARY_DAILY)
    df = serving.filter_usage(store.read(USAGE_SUMMARY_DAILY), date(2024, 2, 5), date(2024, 2, 29))
    assert df.count() == 25
    assert re.search(r"PartitionFilters: \[isnotnull\(usage_month#\d+\), \(usage_month#\d+ >= 2024-02-01\)", plan(df))
    february = store.read(USAGE_SUMMARY_DAILY, {"usage_month": months_between(date(2024, 2, 5), date(2024, 2, 29))})
    assert len(february.inputFiles()) == 1
    assert serving.filter_usage(february, date(2024, 2, 5), date(2024, 2, 29)).count() == 25
    assert len({r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect()}) == 1


def test_aggregation_scans_three_staging_columns_of_one_batch(spark, tmp_path):
    from pyspark.sql import functions as F

    from tollbook.operators.usage import daily_usage, prepare_usage
    from tollbook.schemas import STAGING_FLEXI

    store = TableStore(spark, str(tmp_path / "t"))
    row = spark.range(3).select(*[F.lit("1").try_cast(f.dataType).alias(f.name) for f in STAGING_FLEXI.schema])
    store.write_batch(row, STAGING_FLEXI, "b1")
    daily = daily_usage(prepare_usage(store.read_batch(STAGING_FLEXI, "b1")))
    text = plan(daily)
    assert "ReadSchema: struct<record_type:string,duration:string,day:int>" in text
    assert "PartitionFilters: [isnotnull(year" in text
    assert text.count("Exchange") == 1
    assert [r["event_count"] for r in daily.collect()] == [3]


def test_staging_filters_prune_folders(spark, tmp_path):
    from pyspark.sql import functions as F

    from tollbook.schemas import STAGING_FLEXI

    store = TableStore(spark, str(tmp_path / "t"))
    dated = spark.range(1, 13).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in STAGING_FLEXI.schema if f.name not in ("year", "month", "day")],
        F.lit(2024).alias("year"), F.col("id").cast("int").alias("month"), F.lit(3).alias("day"),
    )
    store.write_batch(dated, STAGING_FLEXI, "b1")
    found = serving.filter_staging(store.read(STAGING_FLEXI), 2024, 5, 3)
    assert re.search(r"PartitionFilters: \[.*year#\d+ = 2024.*month#\d+ = 5", plan(found)) and found.count() == 1
    assert len(store.read(STAGING_FLEXI, {"year": [2024], "month": [5]}).inputFiles()) == 1


@pytest.mark.parametrize("name", ["fact_usage_daily", "summary_replace_dates", "fk_orphans"])
def test_events_are_scanned_once(spark, name):
    """The query itself reads what was aggregated from the events once."""
    assert "event_type" not in plan(entry.queries()[name](spark, FOLDER))
