"""Work list queries; orders play the manifest rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tollbook.catalog import query, table
from tollbook.functions.text import object_store_path
from tollbook.operators import manifest as M
from tollbook.plans.registry import Manifest
from tollbook.schemas import DEFAULT_JOB
from tollbook.session import scratch_path
from tollbook.sinks.store import TableStore

# Valid in both engines.
JOB = "case o_custkey % 3 when 0 then 'other_job' else 'transform_usage_daily' end"
PATH = (
    "concat(case o_orderkey % 5 when 0 then 's3a' else 's3' end, '://lake/raw/', "
    "case o_orderkey % 4 when 0 then 'FRT_FLEXI_EXPORT_' when 1 then 'frt_in_icc_' when 2 then 'Frt_In_Ccc_' "
    "else 'other_' end, cast(o_orderkey as {text}), '.csv')"
)
FLAG = "case o_orderstatus when 'O' then 0 when 'F' then 1 else case o_custkey % 2 when 0 then 9 else 2 end end"
BATCH = "case o_orderstatus when 'O' then null else concat('b', cast(o_custkey % 7 as {text})) end"
ERROR = "case when o_orderstatus = 'P' and o_custkey % 2 = 1 then 'unreadable' end"

STATE = (
    f"state as (select o_orderkey as id, {JOB} as job_name, {PATH.format(text='varchar')} as s3_path, "
    f"o_orderdate as ingest_time, cast({FLAG} as smallint) as processed_flag, "
    f"{BATCH.format(text='varchar')} as batch_id, {ERROR} as error_message from orders)"
)
SHOWN = "id, job_name, s3_path, cast(ingest_time as date) as ingested, processed_flag, batch_id, error_message"


def state(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.expr(JOB).alias("job_name"),
        F.expr(PATH.format(text="string")).alias("s3_path"),
        F.col("o_orderdate").cast("timestamp").alias("ingest_time"),
        F.expr(FLAG).cast("smallint").alias("processed_flag"),
        F.when(F.expr(FLAG).isin(1, 2), F.current_timestamp()).alias("processed_time"),
        F.expr(BATCH.format(text="string")).alias("batch_id"),
        F.expr(ERROR).alias("error_message"),
    )


def shown(df):
    return df.select(
        "id", "job_name", "s3_path", F.to_date("ingest_time").alias("ingested"), "processed_flag", "batch_id", "error_message"
    )


@query("manifest_current", f"with {STATE} select {SHOWN} from state")
def manifest_current(spark, folder):
    """Log of three changes per row, the last one being the state."""
    last = state(spark, folder)
    pending = last.withColumns({"processed_flag": F.lit(0).cast("smallint"), "batch_id": F.lit(None).cast("string")})
    claimed = last.withColumns({"processed_flag": F.lit(9).cast("smallint"), "error_message": F.lit(None).cast("string")})
    log = [df.withColumn("change_no", F.lit(n)) for n, df in enumerate((pending, claimed, last), 1)]
    return shown(M.current_state(log[2].unionByName(log[0]).unionByName(log[1])))


@query(
    "manifest_claim",
    f"with {STATE} select id, job_name, s3_path, cast(ingest_time as date) as ingested, cast(9 as smallint) as processed_flag, "
    "'new' as batch_id, cast(null as varchar) as error_message from state "
    f"where job_name = '{DEFAULT_JOB}' and processed_flag = 0 order by ingest_time, id limit 40",
)
def manifest_claim(spark, folder):
    return shown(M.claim_oldest(state(spark, folder), DEFAULT_JOB, "new", 40))


@query(
    "manifest_claimed",
    f"with {STATE} select id, s3_path from state "
    f"where job_name = '{DEFAULT_JOB}' and processed_flag = 9 and batch_id = 'b4'",
)
def manifest_claimed(spark, folder):
    return M.claimed_rows(state(spark, folder), DEFAULT_JOB, "b4")


@query(
    "manifest_update",
    f"with {STATE}, ids as (select o_orderkey as id from orders where o_totalprice > 100000) "
    "select s.id, cast(case when u then 2 else s.processed_flag end as smallint) as processed_flag, "
    "s.batch_id, case when u then repeat('x', 1900) else s.error_message end as error_message "
    "from (select *, coalesce(batch_id = 'b3', false) and id in (select id from ids) as u from state) s",
)
def manifest_update(spark, folder):
    current = state(spark, folder)
    ids = table(spark, folder, "orders").where("o_totalprice > 100000").select(F.col("o_orderkey").alias("id"))
    changes = M.status_changes(current, ids, "b3", 2, "x" * 2500)
    return M.apply_changes(current, changes).select("id", "processed_flag", "batch_id", "error_message")


@query(
    "manifest_status_counts",
    f"with {STATE} select processed_flag, count(*) as rows from state where job_name = '{DEFAULT_JOB}' "
    "group by processed_flag",
)
def manifest_status_counts(spark, folder):
    return M.status_counts(state(spark, folder), DEFAULT_JOB)


DATASET = (
    "case when contains(lower(s3_path), 'frt_flexi_export_') then 'flexi' "
    "when contains(lower(s3_path), 'frt_in_ccc_') or contains(lower(s3_path), 'frt_in_icc_') then 'icc' else 'unknown' end"
)


@query("manifest_route", f"with {STATE} select id, s3_path, {DATASET} as dataset from state")
def manifest_route(spark, folder):
    return M.with_dataset(state(spark, folder).select("id", "s3_path"))


@query(
    "manifest_outcome",
    f"with {STATE} select id, {DATASET} as dataset, "
    f"cast(case when {DATASET} = 'unknown' then 9 else 1 end as smallint) as processed_flag from state",
)
def manifest_outcome(spark, folder):
    """What ending a batch leaves, for every row as if it were claimed; the job ends its batches by the same changes."""
    claimed = state(spark, folder).withColumn("batch_id", F.lit("now"))
    ended = M.outcome_changes(claimed, "now", 1)
    still = claimed.withColumn("processed_flag", F.lit(9).cast("smallint"))
    return M.with_dataset(M.apply_changes(still, ended)).select("id", "dataset", "processed_flag")


REQUEUED = f"job_name = '{DEFAULT_JOB}' and processed_flag = 2"


@query(
    "manifest_requeue",
    f"with {STATE} select id, job_name, s3_path, cast(ingest_time as date) as ingested, "
    f"cast(case when {REQUEUED} then 0 else processed_flag end as smallint) as processed_flag, "
    f"case when {REQUEUED} then null else batch_id end as batch_id, "
    f"case when {REQUEUED} then null else error_message end as error_message from state",
)
def manifest_requeue(spark, folder):
    """Failed files are pending again."""
    current = state(spark, folder)
    return shown(M.apply_changes(current, M.requeue_failed(current, DEFAULT_JOB)))


@query("manifest_compacted", f"with {STATE} select {SHOWN} from state")
def manifest_compacted(spark, folder):
    """The same state from a log that was compacted where it is stored."""
    last = state(spark, folder)
    pending = last.withColumns({"processed_flag": F.lit(0).cast("smallint"), "batch_id": F.lit(None).cast("string")})
    manifest = Manifest(TableStore(spark, scratch_path(spark, "store")), DEFAULT_JOB)
    for changes in (pending, last):
        manifest.record(changes)
    manifest.compact()
    return shown(manifest.state())


@query("manifest_folded", f"with {STATE} select {SHOWN} from state")
def manifest_folded(spark, folder):
    """The same state from a snapshot and the changes after it: two changes of each row are folded, the last one is not."""
    last = state(spark, folder)
    pending = last.withColumns({"processed_flag": F.lit(0).cast("smallint"), "batch_id": F.lit(None).cast("string")})
    manifest = Manifest(TableStore(spark, scratch_path(spark, "store")), DEFAULT_JOB, fold_after=2)
    half = F.col("id") % 2 == 0
    for changes in (pending, last.where(half), last.where(~half)):
        manifest.record(changes)
    return shown(manifest.state())


@query(
    "manifest_claims_of_a_store",
    f"with {STATE} select id, s3_path, cast((row_number() over (order by ingest_time, id) - 1) // 40 as integer) as claim from state "
    f"where job_name = '{DEFAULT_JOB}' and processed_flag = 0 order by ingest_time, id limit 120",
)
def manifest_claims_of_a_store(spark, folder):
    """Three claims in a row, each from the open files of the snapshot and the changes after it."""
    manifest = Manifest(TableStore(spark, scratch_path(spark, "store")), DEFAULT_JOB, fold_after=2)
    manifest.record(state(spark, folder))
    manifest.fold()
    claims = [manifest.claim(f"new{n}", 40).select("id", "s3_path", F.lit(n).alias("claim")) for n in range(3)]
    return claims[0].unionByName(claims[1]).unionByName(claims[2])


@query(
    "path_rewrite",
    f"with {STATE} select id, regexp_replace(s3_path, '^s3://', 's3a://') as path from state",
)
def path_rewrite(spark, folder):
    return state(spark, folder).select("id", object_store_path("s3_path").alias("path"))


@query(
    "manifest_register",
    f"with {STATE}, known as (select * from state where ingest_time < timestamp '1998-01-01'), "
    "fresh as (select s3_path, min(ingest_time) as ingest_time from state where s3_path not in "
    f"(select s3_path from known where job_name = '{DEFAULT_JOB}') group by s3_path) "
    "select (select max(id) from known) + row_number() over (order by substr(md5(s3_path), 1, 3), s3_path) as id, "
    f"'{DEFAULT_JOB}' as job_name, s3_path, cast(ingest_time as date) as ingested, cast(0 as smallint) as processed_flag from fresh",
)
def manifest_register(spark, folder):
    listed = state(spark, folder)
    known = listed.where("ingest_time < timestamp_ntz '1998-01-01'")
    files = listed.select("s3_path", F.col("ingest_time").alias("modificationTime"))
    added = M.register_files(files.unionByName(files), known, DEFAULT_JOB)
    return added.select("id", "job_name", "s3_path", F.to_date("ingest_time").alias("ingested"), "processed_flag")
