import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tollbook import schemas as S
from tollbook.operators import clean, dimensions, facts, manifest, paging, quality, serving, shape, usage
from tollbook.operators.numbering import number_rows

DAY = dt.date(2024, 1, 15)


def rows(df, *columns):
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=str)


# Cleaning


def test_select_present_skips_absent_columns_and_keeps_lineage(spark):
    df = spark.createDataFrame([(1, 2, "f")], "b int, a int, _source_file string")
    assert shape.select_present(df, ["a", "x", "b", "a"]).columns == ["a", "b", "_source_file"]


def test_fit_to_schema_casts_by_exact_name(spark):
    df = spark.createDataFrame([("1.5", "x", "y")], ["used_duration", " call_type", "extra"])
    fitted = shape.fit_to_schema(df, S.ICC_SCHEMA)
    assert fitted.schema.simpleString() == S.ICC_SCHEMA.simpleString()
    assert tuple(fitted.first()) == (None, None, None, None, 1.5)


def test_lineage_already_there_is_kept(spark):
    df = spark.createDataFrame([("a", "f1")], "c string, _source_file string")
    row = shape.with_lineage(df, "c").first()
    assert row["_source_file"] == "f1" and row["_ingested_at"] is not None


def test_only_chosen_string_columns_are_normalised(spark):
    df = spark.createDataFrame([(" a ", " NULL ", 1)], "x string, y string, n int")
    assert tuple(clean.normalize_strings(df, ["y", "n"]).first()) == (" a ", None, 1)
    assert tuple(clean.normalize_strings(df).first()) == ("a", None, 1)


def test_rows_with_lineage_only_are_dropped(spark):
    df = spark.createDataFrame([(None, None, "f"), ("a", None, "f")], "x string, y string, _source_file string")
    assert rows(clean.drop_all_null(df)) == [("a", None, "f")]


def test_dedup_treats_null_keys_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "k string, v int")
    assert rows(clean.deduplicate(df, ["k"])) == [("a", 3), (None, 1)]


def test_dedup_without_keys_compares_business_columns(spark):
    df = spark.createDataFrame([("a", "f2"), ("a", "f1"), ("b", "f1")], "v string, _source_file string")
    assert rows(clean.deduplicate(df, ["missing"])) == [("a", "f1"), ("b", "f1")]


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = clean.deduplicate(df, ["k"])._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in plan


@settings(max_examples=8, deadline=None)
@given(
    records=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=20),
    partitions=st.integers(1, 5),
)
def test_dedup_does_not_depend_on_partitioning(spark, records, partitions):
    df = spark.createDataFrame(records, "k string, v int, w int")
    expected = {}
    for k, v, w in records:
        expected[k] = min(expected.get(k, (9, 9)), (v, w))
    assert rows(clean.deduplicate(df.repartition(partitions), ["k"])) == sorted(((k, *p) for k, p in expected.items()), key=str)


def test_known_records_are_dropped(spark):
    df = spark.createDataFrame([("a", None), ("b", 1), (None, None)], "k string, n int")
    existing = spark.createDataFrame([("a", None), (None, None), ("b", 2)], "k string, n int")
    assert rows(clean.drop_known(df, existing, ["k", "n"])) == [("b", 1)]


# Usage and warehouse


def staged(spark, records):
    schema = "charging_id string, record_type string, duration string, year int, month int, day int"
    return spark.createDataFrame(records, schema)


def test_daily_usage_counts_rows_without_a_number(spark):
    df = staged(spark, [("1", " v ", "2", 2024, 1, 15), (None, "V", "1e5", 2024, 1, 15), ("3", "", "x", 2024, 1, 15),
                        ("4", "v", "1", None, None, None)])
    assert rows(usage.daily_usage(usage.prepare_usage(df))) == [(DAY, "UNKNOWN", 1, None), (DAY, "V", 2, 2.0)]


@settings(max_examples=8, deadline=None)
@given(
    records=st.lists(st.tuples(st.sampled_from(["1", "2", None]), st.sampled_from(["a", "B", ""]), st.integers(0, 99).map(str)),
                     min_size=1, max_size=20),
    buckets=st.integers(1, 9),
)
def test_salting_changes_no_result(spark, records, buckets):
    prepared = usage.prepare_usage(staged(spark, [(*r, 2024, 1, 15) for r in records]))
    assert rows(usage.daily_usage(prepared)) == rows(usage.daily_usage(prepared, buckets))


def test_icc_rows_can_be_aggregated(spark):
    df = spark.createDataFrame([("9", "sms", 3.5, 2024, 1, 15)], "org_call_id string, call_type string, used_duration double, year int, month int, day int")
    prepared = usage.prepare_usage(df, "org_call_id", "call_type", "used_duration")
    assert rows(usage.daily_usage(prepared)) == [(DAY, "SMS", 1, 3.5)]


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2021, 1, 3),), (None,)], "usage_date date")
    assert rows(dimensions.dim_date(df)) == [
        (20210103, dt.date(2021, 1, 3), 3, 1, 1, 2021, 53, "Sun", "Jan", True)
    ]


def test_new_categories_get_keys_after_the_existing_ones(spark):
    existing = spark.createDataFrame([(7, "A")], "call_type_key long, call_type_code string")
    candidates = dimensions.dim_call_type(spark.createDataFrame([(c,) for c in "ABCD"] * 2, "call_type_code string"))
    fresh = dimensions.new_members(candidates, existing, "call_type_code")
    keyed = dimensions.assign_call_type_keys(fresh, existing)
    assert sorted(r["call_type_key"] for r in keyed.collect()) == [8, 9, 10]
    assert {r["call_type_code"] for r in keyed.collect()} == {"B", "C", "D"}
    none = dimensions.assign_call_type_keys(candidates, existing.limit(0))
    assert sorted(r["call_type_key"] for r in none.collect()) == [1, 2, 3, 4]


def test_numbers_are_consecutive_and_repeatable(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    first = dict(rows(number_rows(df, "k", "n", F.lit(10)), "k", "n"))
    assert sorted(first.values()) == list(range(11, 5011))
    assert dict(rows(number_rows(df.repartition(7), "k", "n", F.lit(10)), "k", "n")) == first


def test_fact_drops_unknown_categories_and_fills_totals(spark):
    daily = spark.createDataFrame(
        [(DAY, "A", 1, None), (DAY, "B", 1, 2.0), (None, "A", 1, 1.0)],
        "usage_date date, call_type_code string, event_count long, total_used_duration double",
    )
    dim = spark.createDataFrame([(5, "A"), (3, "A"), (None, "C")], "call_type_key long, call_type_code string")
    for limit in (None, 0, 10):
        curated = facts.curate_fact(facts.fact_usage_daily(daily, dim, limit))
        assert rows(curated) == [(20240115, 3, DAY, "A", 1, 0.0)]


def test_small_dimension_is_broadcast_and_a_larger_one_is_not_hinted(spark):
    daily = spark.createDataFrame([(DAY, "A", 1, 1.0)], "usage_date date, call_type_code string, event_count long, total_used_duration double")
    dim = spark.createDataFrame([(1, "A"), (2, "B")], "call_type_key long, call_type_code string")
    hinted = facts.fact_usage_daily(daily, dim, 10)._jdf.queryExecution()
    assert "BroadcastHashJoin" in hinted.executedPlan().toString()
    assert "Hint broadcast" not in facts.fact_usage_daily(daily, dim, 1)._jdf.queryExecution().logical().toString()


def test_amounts_are_rounded_half_up(spark):
    curated = spark.createDataFrame([(20240115, 1, DAY, "A", 1, 1.005)],
                                    "date_key int, call_type_key long, usage_date date, call_type_code string, event_count long, total_used_duration double")
    assert facts.stored_fact(curated).first()["total_used_duration"] == Decimal("1.01")


def test_replacing_dates_leaves_other_dates_alone(spark):
    schema = "usage_date date, n int"
    old = spark.createDataFrame([(DAY, 1), (DAY, 2), (dt.date(2024, 1, 16), 3)], schema)
    assert rows(facts.replace_dates(old, spark.createDataFrame([(DAY, 9)], schema))) == [(DAY, 9), (dt.date(2024, 1, 16), 3)]


# Manifest

MANIFEST = "id long, job_name string, s3_path string, ingest_time timestamp, processed_flag short, processed_time timestamp, batch_id string, error_message string"


def work(spark, *entries):
    time = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(i, job, f"s3://b/{i}.csv", time - dt.timedelta(days=i), flag, None, batch, "old") for i, job, flag, batch in entries], MANIFEST
    )


def test_claim_takes_the_oldest_pending_rows_of_the_job(spark):
    current = work(spark, (1, "j", 0, None), (2, "j", 0, None), (3, "j", 1, "b"), (4, "other", 0, None), (5, "j", 0, None))
    claimed = manifest.claim_oldest(current, "j", "new", 2)
    assert rows(claimed, "id", "processed_flag", "batch_id", "error_message") == [(2, 9, "new", None), (5, 9, "new", None)]
    after = manifest.apply_changes(current, claimed)
    assert [r["id"] for r in manifest.claimed_rows(after, "j", "new").collect()] == [5, 2]
    assert after.count() == 5


def test_status_is_set_only_for_rows_of_the_batch_and_errors_are_cut(spark):
    current = work(spark, (1, "j", 9, "b1"), (2, "j", 9, "b2"), (3, "j", 9, "b1"))
    ids = spark.createDataFrame([(1,), (2,)], "id long")
    changed = manifest.status_changes(current, ids, "b1", S.FAILED, "e'" * 1000).collect()
    assert [(r["id"], r["processed_flag"], len(r["error_message"])) for r in changed] == [(1, 2, 1900)]
    assert manifest.status_changes(current, ids, "b1", S.SUCCESS, "").first()["error_message"] is None


def test_files_are_registered_once(spark):
    current = work(spark, (7, "j", 1, "b"), (8, "other", 1, "b"))
    found = spark.createDataFrame([(p,) for p in ("s3://b/7.csv", "s3://b/8.csv", "s3://b/9.csv", "s3://b/9.csv")], "s3_path string")
    fresh = manifest.register_files(found, current, "j")
    assert sorted((r["s3_path"], r["processed_flag"]) for r in fresh.collect()) == [("s3://b/8.csv", 0), ("s3://b/9.csv", 0)]
    assert sorted(r["id"] for r in fresh.collect()) == [9, 10]


def test_first_mark_decides_the_dataset(spark):
    paths = ["s3://b/FRT_FLEXI_EXPORT_1.csv", "x/frt_in_icc_1", "x/Frt_In_Ccc_1", "x/frt_in_icc_frt_flexi_export_", "x/other"]
    df = manifest.with_dataset(spark.createDataFrame([(p,) for p in paths], "s3_path string"))
    assert [r["dataset"] for r in df.collect()] == ["flexi", "icc", "icc", "flexi", "unknown"]


# Rules


def test_rules_are_counted_and_enforced(spark):
    df = spark.createDataFrame([(1, "x" * 51), (1, None), (None, "a"), (None, "a")], "call_type_key long, call_type_code string")
    assert rows(quality.rule_violations(df, ["call_type_code"], {"call_type_code": 50})) == [
        ("call_type_code is null", 1), ("call_type_code over 50", 1)
    ]
    assert rows(quality.duplicate_keys(df, ["call_type_key"])) == [(1, 2)]
    table = S.Table("t", df.schema, unique=(("call_type_key",),), required=("call_type_code",))
    with pytest.raises(quality.ConstraintError, match=r"call_type_code is null \(1\); duplicate call_type_key \(1\)"):
        quality.enforce(df, table)
    parents = {"call_type_key": spark.createDataFrame([(2,)], "call_type_key long")}
    with pytest.raises(quality.ConstraintError, match="without its dimension row"):
        quality.enforce(df, S.Table("t", df.schema), parents)


def test_backfills_keep_known_keys(spark):
    fact = spark.createDataFrame([(None, None, DAY, " voice"), (1, 9, DAY, "x"), (None, None, None, None)],
                                 "date_key int, call_type_key long, usage_date date, call_type string")
    dim = spark.createDataFrame([(4, "VOICE"), (5, "X")], "call_type_key long, call_type_code string")
    filled = quality.backfill_call_type_key(quality.backfill_date_key(fact), dim)
    assert rows(filled, "date_key", "call_type_key") == [(1, 9), (20240115, 4), (None, None)]


# Reading


@pytest.fixture
def summary(spark):
    return spark.createDataFrame(
        [(dt.date(2024, 1, 31), "A", 1, Decimal("1.00")), (dt.date(2024, 2, 1), "A", 2, Decimal("2.00")),
         (dt.date(2024, 2, 2), "B", 3, None), (dt.date(2024, 3, 1), "A", 4, Decimal("4.00"))],
        "usage_date date, call_type_code string, event_count long, total_used_duration decimal(18,2)",
    )


JAN, FEB = dt.date(2024, 1, 1), dt.date(2024, 2, 29)


def test_summary_range_and_totals(spark, summary):
    ranged = serving.usage_summary_range(summary, JAN, FEB)
    assert [tuple(r) for r in ranged.collect()] == [("A", 3, Decimal("3.00")), ("B", 3, Decimal("0.00"))]
    assert tuple(serving.usage_summary_totals(ranged).first()) == (6, Decimal("3.00"))
    nothing = serving.usage_summary_range(summary, JAN, FEB, "a ")
    assert tuple(serving.usage_summary_totals(nothing).first()) == (0, Decimal("0.00"))


def test_trends(spark, summary):
    assert [tuple(r) for r in serving.usage_trend(summary, JAN, FEB, "month", "a").collect()] == [
        ("2024-01", 1, Decimal("1.00")), ("2024-02", 2, Decimal("2.00"))
    ]
    assert [r["period"] for r in serving.usage_trend(summary, JAN, FEB).collect()] == ["2024-01-31", "2024-02-01", "2024-02-02"]


def test_too_large_a_count_is_an_error(spark, summary):
    big = summary.withColumn("event_count", F.lit(2**31))
    with pytest.raises(Exception, match="OVERFLOW"):
        serving.usage_summary_range(big, JAN, FEB).collect()


@pytest.mark.parametrize(
    "call",
    [
        lambda s: serving.usage_trend(s, JAN, FEB, "week"),
        lambda s: serving.usage_summary_range(s, FEB, JAN),
        lambda s: serving.usage_daily_page(s, s, JAN, FEB, limit=501),
        lambda s: serving.usage_daily_page(s, s, JAN, FEB, offset=-1),
        lambda s: serving.staging_page_icc(s, limit=0),
        lambda s: serving.filter_staging(s, 2024),
    ],
)
def test_bad_parameters_are_rejected(summary, call):
    with pytest.raises(ValueError):
        call(summary)


def test_usage_page_keeps_rows_without_a_category(spark):
    fact = spark.createDataFrame([(DAY, 1, 5, Decimal(1)), (DAY, 2, 6, Decimal(2)), (DAY, None, 7, Decimal(3))],
                                 "usage_date date, call_type_key long, event_count long, total_used_duration decimal(18,2)")
    dim = spark.createDataFrame([(1, "A")], "call_type_key long, call_type_code string")
    page = serving.usage_daily_page(fact, dim, DAY, DAY, limit=10)
    assert [(r["call_type_code"], r["event_count"]) for r in page.collect()] == [("A", 5), (None, 6), (None, 7)]
    assert serving.usage_daily_page(fact, dim, DAY, DAY, limit=1, offset=1).first()["event_count"] == 6
    assert serving.usage_daily_total(fact, dim, DAY, DAY).first()["total"] == 3
    assert serving.usage_daily_total(fact, dim, DAY, DAY, "a").first()["total"] == 1


@pytest.mark.parametrize("limit, offset", [(1, 0), (7, 3), (30, 90), (10, 99), (10, 200), (500, 0)])
def test_deep_pages_equal_sorted_slices(spark, limit, offset):
    values = [(i % 5, i) for i in range(100)]
    df = spark.createDataFrame(values, "a int, b int").repartition(3)
    found = paging.deep_page(df, [F.col("a").desc(), F.col("b").asc()], limit, offset)
    expected = sorted(values, key=lambda v: (-v[0], v[1]))[offset:offset + limit]
    assert [tuple(r) for r in found.collect()] == expected


@pytest.mark.parametrize("limit, offset", [(2, 0), (3, 1), (4, 2), (50, 0), (5, 50)])
def test_pages_newest_first_read_the_days_they_need(spark, limit, offset):
    times = [None, None, *[dt.datetime(2024, 1, 1 + i // 3, i % 3) for i in range(9)]]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(times)], "t timestamp, i int")
    order = sorted(range(len(times)), key=lambda i: (times[i] is not None, -times[i].timestamp() if times[i] else 0, i))
    found = paging.newest_page(df, "t", ["i"], limit, offset)
    assert [r["i"] for r in found.collect()] == order[offset:offset + limit]
