"""Whole batches from CSV files to the summary."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tollbook import schemas as S
from tollbook.operators import manifest as M
from tollbook.plans import job
from tollbook.plans.batch import BatchOptions, run_all, run_batch
from tollbook.plans.registry import Manifest
from tollbook.sinks.store import TableStore
from tollbook.sources.files import list_files

FLEXI_HEADER = "charging_id,record_sequence_number,record_opening_time,record_type,duration,served_msisdn,ftp_filename"
ICC_HEADER = "org_call_id,call_reference,call_sta_time,call_type,used_duration"


def write(folder, name, header, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def flexi(folder, name, *lines):
    write(folder, name, FLEXI_HEADER, *lines)


@pytest.fixture(scope="module", autouse=True)
def interpreted(spark):
    """Many small jobs on a few rows: compiling them takes longer than running them."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.fixture
def place(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    return tmp_path / "in", store, Manifest(store, S.DEFAULT_JOB)


def register(spark, place):
    folder, _, manifest = place
    manifest.register(list_files(spark, str(folder)))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def summary(store):
    return rows(store.read(S.USAGE_SUMMARY_DAILY), "usage_date", "call_type_code", "event_count", "total_used_duration")


def flags(manifest):
    return sorted((r["s3_path"].rsplit("/", 1)[1], r["processed_flag"]) for r in manifest.state().collect())


JAN15, JAN16 = dt.date(2024, 1, 15), dt.date(2024, 1, 16)


def test_first_batch_fills_every_table_and_the_second_finds_nothing(spark, place):
    folder, store, manifest = place
    flexi(
        folder, "FRT_FLEXI_EXPORT_1.csv",
        "1,1,2024-01-15 10:11:12, voice ,12.50,84900000001,f1",
        "1,1,2024-01-15 10:11:12, voice ,12.50,84900000001,f1",
        "2,1,20240115,null,1e5,84900000002,f1",
        "3,1,Tue Jan 16 10:11:12 2024,sms,2.25,,f1",
        "4,1,junk,sms,1,,f1",
        ",NULL,n/a,,None,NA,",
    )
    write(folder, "frt_in_icc_1.csv", ICC_HEADER, "9,r1,15/01/2024 10:11:12,sms,3.5", "9,r1,15/01/2024 10:11:12,sms,bad")
    write(folder, "other.csv", "a,b", "1,2")
    register(spark, place)
    register(spark, place)
    assert manifest.state().count() == 3

    result = run_batch(spark, store)
    assert (result.flexi_files, result.icc_files, result.unknown_files) == (1, 1, 1)
    assert summary(store) == [
        (JAN15, "UNKNOWN", 1, Decimal("0.00")),
        (JAN15, "VOICE", 1, Decimal("12.50")),
        (JAN16, "SMS", 1, Decimal("2.25")),
    ]
    assert store.read(S.PROCESSED_FLEXI).count() == 4
    assert rows(store.read(S.STAGING_FLEXI), "charging_id", "year", "month", "day") == [
        ("1", 2024, 1, 15), ("2", 2024, 1, 15), ("3", 2024, 1, 16), ("4", None, None, None)
    ]
    assert rows(store.read(S.STAGING_ICC), "org_call_id", "day") == [("9", 15)]
    assert rows(store.read(S.DIM_DATE), "date_key") == [(20240115,), (20240116,)]
    assert sorted(r[0] for r in store.read(S.DIM_CALL_TYPE).select("call_type_key").collect()) == [1, 2, 3]
    assert store.read(S.CURATED_FACT).count() == store.read(S.FACT_USAGE_DAILY).count() == 3
    assert flags(manifest) == [("FRT_FLEXI_EXPORT_1.csv", 1), ("frt_in_icc_1.csv", 1), ("other.csv", 9)]
    assert {(r["processed_flag"], r["rows"]) for r in M.status_counts(manifest.state(), S.DEFAULT_JOB).collect()} == {
        (1, 2), (9, 1)
    }

    before = summary(store)
    assert run_batch(spark, store) is None
    assert summary(store) == before


def late_batches(spark, place, mode):
    folder, store, _ = place
    options = BatchOptions(summary_mode=mode, files=1)
    flexi(folder, "frt_flexi_export_1.csv", "1,1,2024-01-15,voice,1,,", "2,1,2024-01-16,voice,5,,")
    register(spark, place)
    run_batch(spark, store, options)
    keys = dict(rows(store.read(S.DIM_CALL_TYPE), "call_type_code", "call_type_key"))
    flexi(folder, "frt_flexi_export_2.csv", "3,1,2024-01-15,voice,2,,", "4,1,2024-01-15,sms,3,,")
    register(spark, place)
    assert len(run_all(spark, store, options)) == 1
    assert dict(rows(store.read(S.DIM_CALL_TYPE), "call_type_code", "call_type_key")).items() >= keys.items()
    assert store.read(S.FACT_USAGE_DAILY).count() == 4
    return summary(store)


def test_late_batch_replaces_the_summary_of_its_dates_on_request(spark, place):
    assert late_batches(spark, place, "replace_dates") == [
        (JAN15, "SMS", 1, Decimal("3.00")), (JAN15, "VOICE", 1, Decimal("2.00")), (JAN16, "VOICE", 1, Decimal("5.00"))
    ]


def test_late_batch_accumulates(spark, place):
    assert late_batches(spark, place, "accumulate") == [
        (JAN15, "SMS", 1, Decimal("3.00")), (JAN15, "VOICE", 2, Decimal("3.00")), (JAN16, "VOICE", 1, Decimal("5.00"))
    ]


def test_tables_do_not_depend_on_the_files_per_batch(spark, place, tmp_path):
    """Files of one date with records in common; of two versions of a record that of the older file stays."""
    folder, _, _ = place
    for number, change in ((1, 300), (2, 100), (3, 200)):
        name = f"frt_flexi_export_{number}.csv"
        flexi(folder, name, f"{number},1,2024-01-15,voice,{number},,", f"9,9,2024-01-15,voice,{10 * number},,", "8,8,junk,sms,1,,")
        os.utime(folder / name, (change, change))
    seen = []
    for files in (1, 2, 1000):
        store = TableStore(spark, str(tmp_path / f"tables{files}"))
        Manifest(store, S.DEFAULT_JOB).register(list_files(spark, str(folder)))
        assert len(run_all(spark, store, BatchOptions(files=files))) == {1: 3, 2: 2, 1000: 1}[files]
        fact = store.read(S.FACT_USAGE_DAILY).groupBy("usage_date", "call_type").agg(F.sum("event_count"), F.sum("total_used_duration"))
        staged = rows(store.read(S.STAGING_FLEXI), "charging_id", "record_opening_time", "duration", "year")
        seen.append((summary(store), rows(fact, *fact.columns), staged))
    assert seen[0] == seen[1] == seen[2]
    assert seen[0][0] == [(JAN15, "VOICE", 4, Decimal("26.00"))] and len(seen[0][2]) == 5


def test_oldest_files_are_claimed_first(spark, place):
    folder, _, manifest = place
    for number, change in ((1, 300), (2, 100), (3, 200)):
        flexi(folder, f"frt_flexi_export_{number}.csv", f"{number},1,2024-01-15,voice,1,,")
        os.utime(folder / f"frt_flexi_export_{number}.csv", (change, change))
    register(spark, place)
    order = [manifest.claim(f"b{n}", 1).first()["s3_path"][-5] for n in range(3)]
    assert order == ["2", "3", "1"]


def test_a_used_batch_id_is_refused_and_changes_nothing(spark, place):
    folder, store, manifest = place
    flexi(folder, "frt_flexi_export_1.csv", "1,1,2024-01-15,voice,1,,", "2,1,2024-01-15,voice,1,,")
    register(spark, place)
    run_batch(spark, store, batch_id="daily")
    before = [summary(store), store.read(S.STAGING_FLEXI).count(), store.read(S.FACT_USAGE_DAILY).count(), flags(manifest)]
    flexi(folder, "frt_flexi_export_2.csv", "3,1,2024-01-15,voice,1,,")
    register(spark, place)
    with pytest.raises(ValueError, match="has been used"):
        run_batch(spark, store, batch_id="daily")
    before[3].append(("frt_flexi_export_2.csv", 0))
    assert [summary(store), store.read(S.STAGING_FLEXI).count(), store.read(S.FACT_USAGE_DAILY).count(), flags(manifest)] == before


def test_failed_files_are_put_back_to_work_and_the_log_is_compacted(spark, place):
    folder, store, manifest = place
    flexi(folder, "frt_flexi_export_1.csv", f"1,1,2024-01-15,{'x' * 51},1,,", "2,1,2024-01-15,voice,1,,")
    register(spark, place)
    with pytest.raises(ValueError):
        run_batch(spark, store, batch_id="b1")
    assert store.read(S.STAGING_FLEXI).isEmpty() and store.read(S.FACT_USAGE_DAILY).isEmpty()
    flexi(folder, "frt_flexi_export_1.csv", "1,1,2024-01-15,sms,1,,", "2,1,2024-01-15,voice,1,,")
    manifest.requeue()
    assert flags(manifest) == [("frt_flexi_export_1.csv", 0)]
    with pytest.raises(ValueError, match="has been used"):
        run_batch(spark, store, batch_id="b1")
    run_batch(spark, store)
    assert [r[1:3] for r in summary(store)] == [("SMS", 1), ("VOICE", 1)]
    before, log = rows(manifest.state(), *S.MANIFEST_COLUMNS), manifest.log()
    assert log.where("error_message is not null").count() == 1 and log.count() == 6
    manifest.compact()
    assert rows(manifest.state(), *S.MANIFEST_COLUMNS) == before and manifest.log().count() == 0
    assert store.read(S.MANIFEST).count() == 1
    manifest.requeue()
    assert rows(manifest.state(), *S.MANIFEST_COLUMNS) == before


def test_inserts_carry_their_time_and_scratch_is_removed(spark, place):
    folder, store, _ = place
    flexi(folder, "frt_flexi_export_1.csv", "1,1,2024-01-15,voice,1,,")
    register(spark, place)
    begun = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(seconds=1)
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    left = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    run_batch(spark, store)
    for table in (S.DIM_DATE, S.DIM_CALL_TYPE, S.FACT_USAGE_DAILY, S.USAGE_SUMMARY_DAILY):
        times = [r[0] for r in store.read(table).select(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")).collect()]
        assert times and all(t >= str(begun) for t in times)
    assert set(os.listdir(shared)) <= left if os.path.isdir(shared) else True


def test_lost_run_is_continued_under_its_batch_id(spark, place):
    folder, store, manifest = place
    flexi(folder, "frt_flexi_export_1.csv", "1,1,2024-01-15,voice,1,,")
    register(spark, place)
    run_batch(spark, store, batch_id="b1")
    done = manifest.state()
    # The outcome of the first run is lost: the row is back at claimed.
    manifest.record(done.withColumn("processed_flag", F.lit(9).cast("smallint")))
    run_batch(spark, store, batch_id="b1")
    assert summary(store) == [(JAN15, "VOICE", 1, Decimal("1.00"))]
    assert [store.read(t).count() for t in (S.STAGING_FLEXI, S.FACT_USAGE_DAILY, S.DIM_DATE, S.DIM_CALL_TYPE)] == [1] * 4
    assert flags(manifest) == [("frt_flexi_export_1.csv", 1)]


def test_unknown_files_only_is_an_error_and_leaves_them_claimed(spark, place):
    folder, store, manifest = place
    write(folder, "other.csv", "a", "1")
    register(spark, place)
    with pytest.raises(RuntimeError, match="known dataset"):
        run_batch(spark, store)
    assert flags(manifest) == [("other.csv", 9)]


def test_broken_batch_is_marked_failed_with_its_error(spark, place):
    folder, store, manifest = place
    flexi(folder, "frt_flexi_export_1.csv", f"1,1,2024-01-15,{'x' * 51},1,,")
    register(spark, place)
    with pytest.raises(ValueError, match="call_type_code over 50"):
        run_batch(spark, store)
    row = manifest.state().first()
    assert row["processed_flag"] == S.FAILED
    assert "call_type_code over 50" in row["error_message"] and row["processed_time"] is not None
    assert store.read(S.USAGE_SUMMARY_DAILY).isEmpty()


def test_missing_file_fails_the_batch(spark, place):
    folder, store, manifest = place
    flexi(folder, "frt_flexi_export_1.csv", "1,1,2024-01-15,voice,1,,")
    register(spark, place)
    (folder / "frt_flexi_export_1.csv").unlink()
    with pytest.raises(Exception):
        run_batch(spark, store)
    assert flags(manifest) == [("frt_flexi_export_1.csv", 2)]


def test_records_of_earlier_batches_are_skipped_unless_asked_for(spark, place):
    folder, store, _ = place
    line = "1,1,2024-01-15,voice,1,,"
    for number, skip, staged in ((1, False, 1), (2, True, 2), (3, False, 3)):
        new = f"{10 + number},1,2024-01-16,voice,1,,"
        flexi(folder, f"frt_flexi_export_{number}.csv", *([line] if number != 2 else [line, new]))
        register(spark, place)
        run_batch(spark, store, BatchOptions(skip_staged=skip))
        assert store.read(S.STAGING_FLEXI).count() == staged


def test_command_registers_and_loads(spark, place, monkeypatch):
    folder, store, _ = place
    flexi(folder, "frt_flexi_export_1.csv", "1,1,2024-01-15,voice,1,,")
    monkeypatch.setattr(job, "build_session", lambda: spark)
    job.main(["--root", store.root, "--input", str(folder), "--all", "--salt-buckets", "4", "--processed-files", "2"])
    assert summary(store) == [(JAN15, "VOICE", 1, Decimal("1.00"))]
