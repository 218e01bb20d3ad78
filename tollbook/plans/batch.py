"""One batch: claimed files to staging, dimensions, fact and summary."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tollbook import schemas as S
from tollbook.functions.text import fixed_amount, object_store_path
from tollbook.operators import clean, dimensions, facts, staging, usage
from tollbook.operators.quality import empty_tables, enforce_keys
from tollbook.plans.registry import Manifest
from tollbook.session import kept, shuffles_sized_for
from tollbook.sinks.files import target_partitions
from tollbook.sinks.keys import KeyIndex
from tollbook.sinks.store import TableStore
from tollbook.sources.csv_files import read_csv_records
from tollbook.sources.files import total_bytes

logger = logging.getLogger(__name__)

SUMMARY_MODES = ("accumulate", "replace_dates")


@dataclass(frozen=True)
class BatchOptions:
    """Settings of a batch.

    ``summary_mode``: accumulate rebuilds the dates of a batch from all fact rows;
    replace_dates lets a late batch replace the summary of its dates.
    ``skip_staged`` drops records an earlier batch staged already. With both defaults
    the tables don't depend on how files are divided into batches.
    ``salt_buckets`` spreads all categories over so many groups first; with ``salt_above`` only
    those with more than that share of the rows, which a sketch finds, over 16 if not said otherwise.
    ``processed_files`` fixes the number of processed files per batch. Months of the fact that are in more than
    ``merge_versions`` versions are merged when a batch has ended.
    """

    job_name: str = S.DEFAULT_JOB
    files: int = S.DEFAULT_CLAIM_SIZE
    same_header: bool = False
    skip_staged: bool = True
    salt_buckets: int | None = None
    salt_above: float | None = None
    summary_mode: str = "accumulate"
    processed_files: int | None = None
    broadcast_rows: int = 200_000
    merge_versions: int = 32

    def __post_init__(self) -> None:
        if self.summary_mode not in SUMMARY_MODES:
            raise ValueError(f"summary_mode must be one of: {', '.join(SUMMARY_MODES)}")


@dataclass(frozen=True)
class BatchResult:
    batch_id: str
    flexi_files: int
    icc_files: int
    unknown_files: int


def new_batch_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")


def run_batch(
    spark: SparkSession, store: TableStore, options: BatchOptions = BatchOptions(), batch_id: str | None = None
) -> BatchResult | None:
    """Claim pending files and load them; None if nothing is pending.

    Passing the id of a batch whose run was lost continues it: every write
    replaces what that batch wrote before. An id that has ended is refused. On an
    error the files of the batch are marked failed, its rows are removed, so that the
    files can be put back to work, and the error is raised.
    """
    manifest = Manifest(store, options.job_name)
    claimed = manifest.resume(batch_id) if batch_id else None
    batch_id = batch_id or new_batch_id()
    if claimed is None:
        claimed = manifest.claim(batch_id, options.files)
    oldest = claimed.select("dataset", object_store_path("s3_path").alias("path"), "ingest_time", "id").collect()
    work = sorted(oldest, key=lambda row: (row["ingest_time"] is None, row["ingest_time"], row["id"]))
    if not work:
        logger.info("no pending files for job %s", options.job_name)
        return None
    paths = {name: [row["path"] for row in work if row["dataset"] == name] for name in (S.FLEXI, S.ICC, S.UNKNOWN)}
    try:
        known = paths[S.FLEXI] + paths[S.ICC]
        if not known:
            raise RuntimeError("no claimed file belongs to a known dataset; check paths and file names")
        with shuffles_sized_for(spark, total_bytes(spark, known)):
            load_source(spark, store, options, batch_id, FLEXI_SOURCE, paths[S.FLEXI])
            load_source(spark, store, options, batch_id, ICC_SOURCE, paths[S.ICC])
            load_warehouse(store, options, batch_id)
    except Exception as error:
        for table in (S.PROCESSED_FLEXI, S.PROCESSED_ICC, S.STAGING_FLEXI, S.STAGING_ICC, S.DAYS_FLEXI, S.DAYS_ICC, S.FACT_USAGE_DAILY):
            store.remove_batch(table, batch_id)
        KeyIndex(store, S.KEYS_ICC).remove_batch(batch_id)
        manifest.finish(claimed, batch_id, S.FAILED, str(error))
        raise
    manifest.finish(claimed, batch_id, S.SUCCESS)
    tidy(store, manifest, options)
    return BatchResult(batch_id, *[len(paths[name]) for name in (S.FLEXI, S.ICC, S.UNKNOWN)])


def tidy(store: TableStore, manifest: Manifest, options: BatchOptions = BatchOptions()) -> None:
    """Merge the keys and the months of the fact that have come to lie in many versions; rows of open batches stay apart."""
    keys = KeyIndex(store, S.KEYS_ICC)
    held = store.pointer(S.FACT_USAGE_DAILY).folders
    months = [month for month, versions in held.items() if len(versions) > options.merge_versions]
    days = [t for t in (S.DAYS_FLEXI, S.DAYS_ICC) if len(store.pointer(t).folders.get("", [])) > options.merge_versions]
    if not months and not days and len(keys.pointer().folders.get("", [])) < 4:
        return
    opened = manifest.open_batches()
    store.merge_partitions(S.FACT_USAGE_DAILY, months, opened)
    for table in days:
        store.merge_partitions(table, [""], opened)
    keys.merge(opened)


def merge_months(store: TableStore, manifest: Manifest, before: date) -> list[str]:
    """Bring each month of the fact before that of ``before`` into one version; repeating it changes nothing."""
    closed = before.replace(day=1).isoformat()
    months = [month for month in store.pointer(S.FACT_USAGE_DAILY).folders if month.partition("=")[2] < closed]
    return store.merge_partitions(S.FACT_USAGE_DAILY, months, manifest.open_batches())


def run_all(spark: SparkSession, store: TableStore, options: BatchOptions = BatchOptions()) -> list[BatchResult]:
    """Run batches until no file is pending."""
    done = []
    while result := run_batch(spark, store, options):
        done.append(result)
    return done


@dataclass(frozen=True)
class Source:
    schema: StructType
    keys: Sequence[str]
    processed: S.Table
    staging: S.Table
    stage: Callable[[DataFrame], DataFrame]
    days: S.Table
    #: Table of the known keys; without one the key holds the record's time, and months of the staging table serve.
    known: S.Table | None = None


FLEXI_SOURCE = Source(S.FLEXI_SCHEMA, S.FLEXI_KEYS, S.PROCESSED_FLEXI, S.STAGING_FLEXI, staging.stage_flexi, S.DAYS_FLEXI)
ICC_SOURCE = Source(S.ICC_SCHEMA, S.ICC_KEYS, S.PROCESSED_ICC, S.STAGING_ICC, staging.stage_icc, S.DAYS_ICC, S.KEYS_ICC)


def load_source(
    spark: SparkSession, store: TableStore, options: BatchOptions, batch_id: str, source: Source, paths: list[str]
) -> None:
    """Clean the files of one source into its processed and staging tables.

    Staging reads the processed Parquet back, so the de-duplicating shuffle runs
    once and later steps start from stored columns instead of CSV. Of records with one key
    that of the oldest file stays, within a batch as between batches. Where the key
    holds the record's time, only staged rows of the same months can have it; other
    keys are looked up in a table of known keys, which are neither moved nor read from staging.
    """
    if not paths:
        return
    raw = read_csv_records(spark, paths, source.schema, options.same_header)
    records = clean.clean_records(raw, source.schema.fieldNames(), source.keys, spark.createDataFrame(list(zip(paths, range(len(paths)))), "file string, place int"))
    store.write_batch(target_partitions(records, options.processed_files), source.processed, batch_id)
    staged = source.stage(store.read_batch(source.processed, batch_id))
    keys = known_keys(store, source, batch_id)
    if options.skip_staged:
        staged = keys.new_records(staged, source.keys, batch_id) if keys else new_by_month(store, staged, source, batch_id)
    store.write_batch(staged.hint("rebalance", "year", "month"), source.staging, batch_id)
    written = store.read_batch(source.staging, batch_id)
    store.put_batch(staging.rows_per_day(written), source.days, batch_id)
    if keys:
        keys.put_batch(written, source.keys, batch_id)


def known_keys(store: TableStore, source: Source, batch_id: str) -> KeyIndex | None:
    """The known keys of a source; made from its staging table where that is older than they are."""
    if source.known is None:
        return None
    keys = KeyIndex(store, source.known)
    if not keys.exists():
        keys.put_batch(store.read(source.staging).where(F.col("batch_id") != batch_id), source.keys, "earlier")
    return keys


def new_by_month(store: TableStore, staged: DataFrame, source: Source, batch_id: str) -> DataFrame:
    """Rows whose key no other batch has staged in their months."""
    found = staged.select("year", "month").distinct().collect()
    months = {name: {row[name] for row in found} or {None} for name in ("year", "month")}
    earlier = store.read(source.staging, months).where(F.col("batch_id") != batch_id)
    return clean.drop_known(staged, earlier, source.keys)


def load_warehouse(store: TableStore, options: BatchOptions, batch_id: str) -> None:
    """Aggregate the staged flexi records of a batch into dimensions, fact and summary."""
    prepared = usage.prepare_usage(store.read_batch(S.STAGING_FLEXI, batch_id))
    hot = None if options.salt_above is None else usage.hot_categories(prepared, options.salt_above)
    buckets = options.salt_buckets or (16 if hot else None)
    with kept(usage.daily_usage(prepared, buckets, hot)) as daily:
        add_dimension_members(store, daily, batch_id)
        dim = store.read(S.DIM_CALL_TYPE)
        fact = facts.fact_usage_daily(daily, dim, options.broadcast_rows)
        with kept(facts.curate_fact(fact)) as curated:
            stored = facts.stored_fact(curated)
            enforce_keys(stored, S.FACT_USAGE_DAILY, {"date_key": store.read(S.DIM_DATE), "call_type_key": dim})
            store.overwrite(curated, S.CURATED_FACT)
            # Bring each month together, so that it is written as few files.
            by_month = facts.with_month(stored).hint("rebalance", "usage_month")
            store.put_batch(by_month, S.FACT_USAGE_DAILY, batch_id, checked=True)
            replace_summary(store, options, curated)


def add_dimension_members(store: TableStore, daily: DataFrame, batch_id: str) -> None:
    """Append the dates and categories not seen before; stored members and keys never change."""
    dates = store.read(S.DIM_DATE)
    types = store.read(S.DIM_CALL_TYPE)
    new_dates = dimensions.new_members(dimensions.dim_date(daily), dates, "date_key")
    new_types = dimensions.assign_call_type_keys(
        dimensions.new_members(dimensions.dim_call_type(daily), types, "call_type_code"), types
    )
    stamp = {"created_at": F.current_timestamp(), "batch_id": F.lit(batch_id)}
    with kept(new_dates) as days, kept(new_types) as codes:
        found = ((S.DIM_DATE, days), (S.DIM_CALL_TYPE, codes))
        empty = {r["table_name"] for r in empty_tables({t.name: rows for t, rows in found}).where("is_empty").collect()}
        for table, rows in found:
            if table.name not in empty:
                store.append(enforce_keys(rows, table).withColumns(stamp), table, checked=True)


def replace_summary(store: TableStore, options: BatchOptions, curated: DataFrame) -> None:
    """Replace the summary of the dates in ``curated``; other dates of their months are written again."""
    months = {"usage_month": facts.months_of(curated)}
    if not months["usage_month"]:
        return
    if options.summary_mode == "accumulate":
        rows = facts.accumulate_dates(store.read(S.FACT_USAGE_DAILY, months), curated)
    else:
        rows = facts.usage_summary_daily(curated)
    amount = fixed_amount("total_used_duration")
    fresh = facts.with_month(rows).withColumns({"total_used_duration": amount, "created_at": F.current_timestamp()})
    with kept(fresh) as summary:
        enforce_keys(summary, S.USAGE_SUMMARY_DAILY)
        same_months = store.read(S.USAGE_SUMMARY_DAILY, months)
        fresh = facts.replace_dates(same_months, summary).hint("rebalance", "usage_month")
        store.replace(fresh, S.USAGE_SUMMARY_DAILY, checked=True)
