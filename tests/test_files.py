"""Sources, sinks and the arrival stream."""

import json
import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from tollbook import schemas as S
from tollbook.plans.registry import Manifest
from tollbook.session import broadcast_within, scratch_path, shuffle_partitions_for, shuffles_sized_for
from tollbook.sinks.files import target_partitions, write_parquet
from tollbook.sinks.jdbc import jdbc_write_options, with_retries
from tollbook.sinks.store import TableStore
from tollbook.sources.csv_files import paths_by_header, read_csv_records
from tollbook.sources.files import list_files, total_bytes
from tollbook.sources.jdbc import Split, jdbc_options
from tollbook.sources.parquet import read_parquet
from tollbook.streaming.arrivals import register_arrivals

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ICC = "org_call_id,call_reference,call_sta_time,call_type,used_duration"


@pytest.fixture
def csv(tmp_path):
    def write(name, *lines):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


def test_no_files_give_an_empty_frame(spark):
    df = read_csv_records(spark, [], S.ICC_SCHEMA)
    assert df.columns == [*S.ICC_COLUMNS, *S.LINEAGE_COLUMNS] and df.isEmpty()


@pytest.mark.parametrize("same_header", [True, False])
def test_records_carry_their_file_and_bad_numbers_are_null(spark, csv, same_header):
    paths = [csv("a.csv", ICC, "1,r,t,sms,1.5", "2,r,t,sms,bad,surplus"), csv("b.csv", ICC, "3,r")]
    df = read_csv_records(spark, paths, S.ICC_SCHEMA, same_header)
    found = sorted((r["org_call_id"], r["used_duration"], r["_source_file"].rsplit("/", 1)[1]) for r in df.collect())
    assert found == [("1", 1.5, "a.csv"), ("2", None, "a.csv"), ("3", None, "b.csv")]
    assert df.schema["used_duration"].dataType == S.DOUBLE


def test_files_with_other_headers(spark, csv):
    paths = [csv("a.csv", ICC, "1,r,t,sms,1"), csv("b.csv", "call_reference,org_call_id,new", "r2,2,x"), csv("c.csv", ICC, "3,r,t,sms,3")]
    df = read_csv_records(spark, paths, S.ICC_SCHEMA)
    assert sorted((r["org_call_id"], r["call_reference"], r["used_duration"]) for r in df.collect()) == [
        ("1", "r", 1.0), ("2", "r2", None), ("3", "r", 3.0)
    ]
    with pytest.raises(Exception, match="header"):
        read_csv_records(spark, paths, S.ICC_SCHEMA, same_header=True).collect()


def test_listing_reads_no_contents(spark, csv, tmp_path):
    csv("a.csv", "12345")
    csv("b.txt", "12345")
    found = list_files(spark, str(tmp_path))
    assert [r["length"] for r in found.collect()] == [6]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    assert total_bytes(spark, [str(tmp_path)]) == 12


def test_parquet_keeps_stored_lineage(spark, tmp_path):
    write_parquet(spark.createDataFrame([("a", "f1")], "v string, _source_file string"), str(tmp_path / "p"))
    row = read_parquet(spark, str(tmp_path / "p")).first()
    assert row["_source_file"] == "f1" and row["_ingested_at"] is not None


def test_target_partitions(spark, tmp_path):
    df = spark.range(100).repartition(4)
    assert target_partitions(df, None) is df
    write_parquet(df, str(tmp_path / "one"), partitions=0, shrink=True)
    write_parquet(df, str(tmp_path / "six"), partitions=6)
    for name, files in (("one", 1), ("six", 6)):
        assert len(list((tmp_path / name).glob("*.snappy.parquet"))) == files


def test_store_replaces_batches_and_reads_missing_tables_as_empty(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    assert store.read(S.USAGE_SUMMARY_DAILY).isEmpty()
    df = spark.createDataFrame([(str(i),) for i in range(3)], "charging_id string")
    df = df.select(*[F.col(n) if n == "charging_id" else F.lit(None).alias(n) for n in S.FLEXI_COLUMNS + S.LINEAGE_COLUMNS])
    for batch_id, rows in (("01", df), ("02", df), ("01", df.limit(1))):
        store.write_batch(rows, S.PROCESSED_FLEXI, batch_id)
    assert {b: store.read_batch(S.PROCESSED_FLEXI, b).count() for b in ("01", "02", "03")} == {"01": 1, "02": 3, "03": 0}
    assert len(store.read_batch(S.PROCESSED_FLEXI, "01").inputFiles()) == 1
    store.remove_batch(S.PROCESSED_FLEXI, "02")
    assert store.read(S.PROCESSED_FLEXI).select("batch_id").distinct().collect() == [("01",)]


def test_store_lists_only_the_folders_it_is_asked_for(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    days = spark.sql("select explode(sequence(date'2020-01-15', date'2023-12-15', interval 1 month)) as usage_date")
    rows = days.withColumns({"usage_month": F.trunc("usage_date", "month"), "event_count": F.lit(1)})
    empty = {f.name: F.lit(None).cast(f.dataType) for f in S.USAGE_SUMMARY_DAILY.schema if f.name not in rows.columns}
    store.replace_partitions(rows.withColumns(empty), S.USAGE_SUMMARY_DAILY)
    assert len(store.read(S.USAGE_SUMMARY_DAILY).inputFiles()) == 48
    month = store.read(S.USAGE_SUMMARY_DAILY, {"usage_month": ["2021-03-01"]})
    assert len(month.inputFiles()) == 1 and month.count() == 1
    assert store.read(S.USAGE_SUMMARY_DAILY, {"usage_month": ["2021-03-01", "2021-04-01", "1999-01-01"]}).count() == 2
    assert store.read(S.USAGE_SUMMARY_DAILY, {"usage_month": ["1999-01-01"]}).isEmpty()


def test_staging_is_stored_by_month_and_undated_rows_apart(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    row = spark.range(4).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in S.STAGING_FLEXI.schema if f.name not in ("year", "month")], F.lit(2024).alias("year"), F.when(F.col("id") > 0, F.col("id")).cast("int").alias("month"))
    undated = row.where("month is null").withColumn("year", F.lit(None).cast("int"))
    for batch_id in ("a{1}", "b,c"):
        store.write_batch(row.where("month is not null").union(undated.select(*row.columns)), S.STAGING_FLEXI, batch_id)
    assert store.read_batch(S.STAGING_FLEXI, "a{1}").count() == store.read_batch(S.STAGING_FLEXI, "b,c").count() == 4
    assert len(store.read(S.STAGING_FLEXI, {"year": [2024], "month": [2, 3]}).inputFiles()) == 4
    assert store.read(S.STAGING_FLEXI, {"year": [None]}).where("year is null").count() == 2
    store.remove_batch(S.STAGING_FLEXI, "a{1}")
    assert store.read(S.STAGING_FLEXI).count() == 4


def test_headers_take_one_job_for_any_number_of_files(spark, csv):
    def jobs(paths):
        spark.sparkContext.setJobGroup(f"headers {len(paths)}", "")
        groups = paths_by_header(spark, paths)
        spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers {len(paths)}")), groups

    paths = [csv(f"a {i}.csv", ICC, "1,r,t,sms,1.5") for i in range(12)] + [csv("empty.csv")]
    few, _ = jobs(paths[:2] + paths[-1:])
    many, groups = jobs(paths)
    assert few == many and [len(files) for names, files in groups.items() if names == tuple(S.ICC_COLUMNS)] == [12]
    assert read_csv_records(spark, paths, S.ICC_SCHEMA).count() == 12


def test_retries_stop_at_the_first_success_and_raise_the_last_error():
    calls = []

    def fails_until(n):
        def action():
            calls.append(1)
            if len(calls) < n:
                raise OSError(f"attempt {len(calls)}")

        return action

    with_retries(fails_until(3), attempts=3, wait_seconds=0)
    assert len(calls) == 3
    calls.clear()
    with pytest.raises(OSError, match="attempt 2"):
        with_retries(fails_until(9), attempts=2, wait_seconds=0)
    calls.clear()
    with pytest.raises(OSError, match="attempt 1"):
        with_retries(fails_until(9), attempts=0, wait_seconds=0)


def test_database_options():
    connection = {"user": "u", "driver": "d"}
    table = jdbc_options("jdbc:x", "dwh.dim_date", connection)
    assert (table["dbtable"], table["fetchsize"], table["user"]) == ("dwh.dim_date", "10000", "u")
    part = jdbc_options("jdbc:x", " SELECT 1", connection, Split("id", "0", "9", 4))
    assert part["dbtable"] == "( SELECT 1) source_query"
    assert (part["partitionColumn"], part["lowerBound"], part["upperBound"], part["numPartitions"]) == ("id", "0", "9", "4")
    written = jdbc_write_options(connection, 50, 30)
    assert (written["reWriteBatchedInserts"], written["queryTimeout"]) == ("true", "30")
    assert (written["batchsize"], written["isolationLevel"], written["truncate"]) == ("50", "NONE", "false")


def test_arrivals_are_registered_once(spark, csv, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    manifest = Manifest(TableStore(spark, str(tmp_path / "t")), "job")
    for name in ("in/a.csv", "in/b.csv"):
        csv(name, "x")
        register_arrivals(spark, manifest, str(folder), str(tmp_path / "checkpoint")).awaitTermination()
    # A new checkpoint sees every file again; known paths are left out.
    register_arrivals(spark, manifest, str(folder), str(tmp_path / "other")).awaitTermination()
    rows = manifest.state().collect()
    assert sorted((r["id"], r["s3_path"].rsplit("/", 1)[1], r["processed_flag"]) for r in rows) == [(1, "a.csv", 0), (2, "b.csv", 0)]


def test_shuffle_size_follows_the_input(spark):
    assert shuffle_partitions_for(0, 4) == 4
    assert shuffle_partitions_for(100 * 2**40, 200) == 81920
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with shuffles_sized_for(spark, 2**33):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared)


def test_broadcast_needs_few_rows(spark):
    def plan(df):
        return df._jdf.queryExecution().logical().toString()

    assert "Hint broadcast" in plan(broadcast_within(spark.range(3), 3))
    assert "Hint broadcast" not in plan(broadcast_within(spark.range(4), 3))


def test_scratch_is_gone_when_the_program_has_ended(tmp_path):
    """Of stores, pages and tables written once nothing stays in the shared folder, with or without a stopped session."""
    shared = tmp_path / "shared"
    for stop in ("spark.stop()", ""):
        program = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from tollbook import catalog
from tollbook.session import build_session, written_once
spark = build_session("t", "local[2]", spark__ui__enabled="false", spark__checkpoint__dir={str(shared)!r}, spark__sql__shuffle__partitions="2")
catalog.load()
for name in ("deep_page", "fact_append", "manifest_compacted"):
    catalog.QUERIES[name](spark, {FOLDER!r}).count()
written_once(spark.range(5), "kept").count()
import os
assert len(os.listdir({str(shared)!r})) >= 4
{stop}
"""
        done = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, timeout=240)
        assert done.returncode == 0, done.stderr[-2000:]
        left = lambda: [name for name in os.listdir(shared) if os.listdir(shared / name)]
        deadline = time.time() + 30
        while left() and time.time() < deadline:
            time.sleep(0.5)
        # Spark itself makes an empty folder of each program.
        assert left() == [] and len(os.listdir(shared)) <= 2


def test_files_of_many_claims_are_written_without_a_sort(spark, tmp_path):
    """A task's memory does not grow with the rows of its files; the event log of a session of its own tells."""
    spark.range(900).selectExpr(
        "id as event_id", "timestamp_seconds(id * 90000) as ts", "id % 30 as user_id", "'sms' as event_type", "id / 4d as value"
    ).write.parquet(str(tmp_path / "events.parquet"))
    (tmp_path / "log").mkdir()
    code = """
import json, sys
from tollbook.catalog import files
from tollbook.session import build_session
folder = sys.argv[1]
session = build_session("log", "local[2]", spark__ui__enabled="false", spark__checkpoint__dir=f"{folder}/shared", spark__eventLog__enabled="true",
    spark__eventLog__dir=f"{folder}/log", spark__eventLog__compress="false", spark__eventLog__rolling__enabled="false")
key = "spark.sql.maxConcurrentOutputFileWriters"
class Written(Exception):
    pass
def found(spark, place):
    rows = spark.read.options(header=True).csv(place).selectExpr("file_no", "_metadata.file_path as path")
    print(json.dumps([rows.groupBy("file_no").count().orderBy("file_no").collect(), rows.distinct().count()]))
    raise Written
files.list_files = found
before = session.conf.get(key)
try:
    files.batch_many_claims(session, folder)
except Written:
    assert session.conf.get(key) == before
session.stop()
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path)], cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    counts, paths = json.loads(done.stdout)
    assert counts == [[n, 300] for n in range(1, 7)] and paths == 6
    events = [json.loads(line) for log in (tmp_path / "log").iterdir() if not log.name.startswith(".") for line in log.read_text().splitlines()]
    writing = {
        e["Stage Info"]["Stage ID"] for e in events if e["Event"] == "SparkListenerStageCompleted"
        and any('"WriteFiles"' in r.get("Scope", "") for r in e["Stage Info"]["RDD Info"])
    }
    peaks = [e["Task Metrics"]["Peak Execution Memory"] for e in events if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in writing]
    assert peaks and max(peaks) == 0
