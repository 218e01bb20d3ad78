"""Scans, sinks and the whole batch, on files Spark writes from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tollbook import schemas as S
from tollbook.catalog import inputs as I
from tollbook.catalog import query, table
from tollbook.plans.batch import BatchOptions, run_all, run_batch
from tollbook.plans.registry import Manifest
from tollbook.session import files_side_by_side, scratch_path
from tollbook.sinks.files import write_parquet
from tollbook.sinks.store import TableStore
from tollbook.sources.csv_files import read_csv_records
from tollbook.sources.files import list_files
from tollbook.sources.parquet import read_parquet


def _write_csv(df, path):
    # Outer spaces belong to the records, so the writer must not trim them.
    df.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


@query(
    "csv_to_schema",
    f"with {I.RAW_FLEXI} select charging_id, record_sequence_number, record_opening_time, "
    "nullif(record_type, '') as record_type, duration, "
    "case when ftp_filename = 'f1.csv' then served_msisdn end as served_msisdn, ftp_filename from raw_flexi",
)
def csv_to_schema(spark, folder):
    """Two kinds of header: one reordered, one lacking a column and holding another instead."""
    raw = I.raw_flexi(spark, folder)
    base = scratch_path(spark, "csv")
    first = raw.where("ftp_filename = 'f1.csv'")
    second = raw.where("ftp_filename = 'f2.csv'").withColumnRenamed("served_msisdn", "other")
    _write_csv(first.select(*reversed(first.columns)), f"{base}/a")
    _write_csv(second, f"{base}/b")
    return read_csv_records(spark, [f"{base}/a", f"{base}/b"], S.FLEXI_SCHEMA).select(*S.FLEXI_COLUMNS)


@query("parquet_scan", "select event_id, user_id, event_type, value, true as has_lineage from events")
def parquet_scan(spark, folder):
    scanned = read_parquet(spark, f"{folder}/events.parquet")
    lineage = F.col("_source_file").contains("events") & F.col("_ingested_at").isNotNull()
    return scanned.select("event_id", "user_id", "event_type", "value", lineage.alias("has_lineage"))


@query("parquet_roundtrip", "select event_id, user_id, event_type, value from events")
def parquet_roundtrip(spark, folder):
    path = scratch_path(spark, "roundtrip")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    write_parquet(events, path, partitions=4)
    return spark.read.parquet(path)


@query(
    "batch_partition_overwrite",
    f"with {I.RAW_FLEXI} select 'b1' as batch_id, charging_id, served_msisdn from raw_flexi where ftp_filename = 'f1.csv' "
    "union all select 'b2', charging_id, served_msisdn from raw_flexi",
)
def batch_partition_overwrite(spark, folder):
    store = TableStore(spark, scratch_path(spark, "store"))
    raw = I.raw_flexi(spark, folder).withColumns(
        {"_source_file": F.col("ftp_filename"), "_ingested_at": F.current_timestamp()}
    )
    for batch_id, rows in (("b1", raw), ("b2", raw), ("b1", raw.where("ftp_filename = 'f1.csv'"))):
        store.write_batch(rows, S.PROCESSED_FLEXI, batch_id)
    return store.read(S.PROCESSED_FLEXI).select("batch_id", "charging_id", "served_msisdn")


@query(
    "batch_end_to_end",
    f"with {I.DAILY_FLEXI} select d.usage_date, d.call_type_code, d.event_count, "
    "cast(round(coalesce(d.total_used_duration, 0), 2) as decimal(18,2)) as total_used_duration, "
    "(select count(*) from staging_flexi) as staged_flexi, "
    f"(select count(*) from (with {I.STAGING_ICC} select * from staging_icc)) as staged_icc from daily d",
)
def batch_end_to_end(spark, folder):
    """Files are written, found, claimed, loaded; the summary and the staging counts are read back."""
    base = scratch_path(spark, "batch")
    raw = I.raw_flexi(spark, folder)
    for number, name in ((1, "f1.csv"), (2, "f2.csv")):
        _write_csv(raw.where(F.col("ftp_filename") == name), f"{base}/in/FRT_FLEXI_EXPORT_{number}")
    _write_csv(I.raw_icc(spark, folder), f"{base}/in/frt_in_icc_1")
    store = TableStore(spark, f"{base}/tables")
    manifest = Manifest(store, S.DEFAULT_JOB)
    manifest.register(list_files(spark, f"{base}/in"))
    run_batch(spark, store, BatchOptions(files=manifest.state().count()))
    flexi = store.read(S.STAGING_FLEXI).agg(F.count("*")).scalar()
    icc = store.read(S.STAGING_ICC).agg(F.count("*")).scalar()
    return store.read(S.USAGE_SUMMARY_DAILY).select(
        "usage_date", "call_type_code", "event_count", "total_used_duration",
        flexi.alias("staged_flexi"), icc.alias("staged_icc"),
    )


# Records of one user go to one file of each kind, so every record is in two files that are claimed apart.
MANY_FILES = (
    f"{I.RAW_FLEXI}, numbered as (select *, case ftp_filename when 'f1.csv' then 1 else 4 end + cast(served_msisdn as int) % 3 as file_no "
    f"from raw_flexi), clean_flexi as ({I.clean_cte('numbered', S.FLEXI_COLUMNS, S.FLEXI_KEYS, first='file_no')})"
    + I.DAILY_FLEXI.removeprefix(I.CLEAN_FLEXI)
)


@query(
    "batch_many_claims",
    f"with {MANY_FILES} select usage_date, call_type_code, event_count, "
    "cast(round(coalesce(total_used_duration, 0), 2) as decimal(18,2)) as total_used_duration, "
    "(select count(*) from staging_flexi) as staged_flexi from daily",
)
def batch_many_claims(spark, folder):
    """Six files loaded in three claims give what one claim of all would."""
    base = scratch_path(spark, "batch")
    number = F.when(F.col("ftp_filename") == "f1.csv", 1).otherwise(4) + F.col("served_msisdn").cast("int") % 3
    numbered = I.raw_flexi(spark, folder).withColumn("file_no", number)
    writer = numbered.repartition(6, "file_no").write.partitionBy("file_no")
    with files_side_by_side(spark, 16):
        writer.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{base}/frt_flexi_export_in")
    found = list_files(spark, f"{base}/frt_flexi_export_in").withColumn(
        "modificationTime", F.timestamp_seconds(F.regexp_extract("s3_path", r"file_no=(\d+)", 1).cast("int"))
    )
    store = TableStore(spark, f"{base}/tables")
    Manifest(store, S.DEFAULT_JOB).register(found)
    run_all(spark, store, BatchOptions(files=2))
    staged = store.read(S.STAGING_FLEXI).agg(F.count("*")).scalar()
    return store.read(S.USAGE_SUMMARY_DAILY).select(
        "usage_date", "call_type_code", "event_count", "total_used_duration", staged.alias("staged_flexi")
    )


@query(
    "empty_source_union",
    f"with {I.RAW_ICC} select org_call_id, call_reference, call_sta_time, call_type from raw_icc",
)
def empty_source_union(spark, folder):
    """A source without files has the columns of one with files, and adds nothing."""
    names = S.ICC_COLUMNS[:-1]
    nothing = read_csv_records(spark, [], S.ICC_SCHEMA).select(*names)
    return I.raw_icc(spark, folder).select(*names).unionByName(nothing)
