"""Work list of files: append-only changes, the latest one of a row is its state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollbook.functions.text import object_store_path
from tollbook.operators.clean import dedup_by_keys
from tollbook.operators.numbering import next_after, number_rows
from tollbook.schemas import (
    CLAIMED,
    ERROR_TEXT_LENGTH,
    FAILED,
    FLEXI,
    ICC,
    MANIFEST_COLUMNS,
    PENDING,
    UNKNOWN,
)

# File name parts of each dataset, lower case.
FLEXI_MARKS = ("frt_flexi_export_",)
ICC_MARKS = ("frt_in_ccc_", "frt_in_icc_")


def _flag(value: int | Column) -> Column:
    return (F.lit(value) if isinstance(value, int) else value).cast("smallint")


def current_state(log: DataFrame) -> DataFrame:
    """Latest change of each manifest row."""
    return latest_changes(log).select(*MANIFEST_COLUMNS)


def register_files(found: DataFrame, current: DataFrame, job_name: str, at: Column | datetime | None = None) -> DataFrame:
    """Pending rows for the paths in ``found`` the job has not seen, numbered after the rows there are.

    A file's time is ``at`` if given, else its ``modificationTime`` if ``found`` has one, else
    now; it decides which files are oldest. ``current`` may be the state or the whole log.
    """
    known = current.where(F.col("job_name") == job_name).select("s3_path")
    changed = F.min("modificationTime") if "modificationTime" in found.columns else F.lit(None)
    listed = found.groupBy("s3_path").agg(changed.cast("timestamp").alias("_changed"))
    fresh = listed.join(known, "s3_path", "left_anti")
    when = F.coalesce("_changed", F.current_timestamp()) if at is None else at if isinstance(at, Column) else F.lit(at)
    numbered = number_rows(fresh, "s3_path", "id", next_after(current, "id"))
    return numbered.select(
        "id",
        F.lit(job_name).alias("job_name"),
        "s3_path",
        when.cast("timestamp").alias("ingest_time"),
        _flag(PENDING).alias("processed_flag"),
        F.lit(None).cast("timestamp").alias("processed_time"),
        F.lit(None).cast("string").alias("batch_id"),
        F.lit(None).cast("string").alias("error_message"),
    )


def claim_oldest(current: DataFrame, job_name: str, batch_id: str, files: int) -> DataFrame:
    """The oldest pending rows of a job, at most ``files``, changed to claimed."""
    pending = current.where((F.col("job_name") == job_name) & (F.col("processed_flag") == PENDING))
    return (
        pending.orderBy(F.col("ingest_time").asc_nulls_last(), "id")
        .limit(files)
        .withColumns(
            {
                "processed_flag": _flag(CLAIMED),
                "batch_id": F.lit(batch_id),
                "error_message": F.lit(None).cast("string"),
            }
        )
    )


def claimed_rows(current: DataFrame, job_name: str, batch_id: str) -> DataFrame:
    """Claimed rows of a batch, oldest first."""
    mine = (
        (F.col("job_name") == job_name) & (F.col("processed_flag") == CLAIMED) & (F.col("batch_id") == batch_id)
    )
    return current.where(mine).orderBy(F.col("ingest_time").asc_nulls_last(), "id").select("id", "s3_path")


def status_changes(
    current: DataFrame, ids: DataFrame, batch_id: str, status: int, error: str | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Rows of ``ids`` that belong to the batch, with their new status, time and error."""
    # An empty error counts as none.
    text = F.substring(F.lit(error), 1, ERROR_TEXT_LENGTH) if error else F.lit(None)
    mine = current.where(F.col("batch_id") == batch_id).join(ids.select("id").distinct(), "id", "left_semi")
    return mine.withColumns(
        {
            "processed_flag": _flag(status),
            "processed_time": F.current_timestamp() if at is None else at,
            "error_message": text.cast("string"),
        }
    ).select(*MANIFEST_COLUMNS)


def apply_changes(current: DataFrame, changes: DataFrame) -> DataFrame:
    """State after ``changes``: unchanged rows plus the changed ones."""
    return current.join(changes.select("id"), "id", "left_anti").unionByName(changes)


def with_dataset(df: DataFrame, path: str = "s3_path") -> DataFrame:
    """Add the dataset a path belongs to, decided by parts of its lower-case form."""
    low = F.lower(object_store_path(path))
    dataset = F.when(low.rlike("|".join(FLEXI_MARKS)), FLEXI).when(low.rlike("|".join(ICC_MARKS)), ICC)
    return df.withColumn("dataset", dataset.otherwise(UNKNOWN))


def batch_outcome(claimed: DataFrame, status: int) -> DataFrame:
    """Final flag of each claimed row; files of no known dataset stay claimed."""
    routed = with_dataset(claimed)
    return routed.withColumn(
        "processed_flag", _flag(F.when(F.col("dataset") == UNKNOWN, CLAIMED).otherwise(status))
    )


def outcome_changes(claimed: DataFrame, batch_id: str, status: int, error: str | None = None) -> DataFrame:
    """Changes that end a batch: the claimed rows with the status, except those that stay claimed."""
    ended = batch_outcome(claimed, status).where(F.col("processed_flag") != CLAIMED)
    return status_changes(claimed, ended, batch_id, status, error)


def requeue_failed(current: DataFrame, job_name: str) -> DataFrame:
    """Failed rows of a job changed back to pending. The log keeps their errors and batches."""
    failed = current.where((F.col("job_name") == job_name) & (F.col("processed_flag") == FAILED))
    return failed.withColumns(
        {
            "processed_flag": _flag(PENDING),
            "processed_time": F.lit(None).cast("timestamp"),
            "batch_id": F.lit(None).cast("string"),
            "error_message": F.lit(None).cast("string"),
        }
    )


def latest_changes(log: DataFrame) -> DataFrame:
    """The log with the latest change of each row only; the state stays the same."""
    return dedup_by_keys(log, ["id"], [F.col("change_no").desc()])


def status_counts(current: DataFrame, job_name: str) -> DataFrame:
    """Rows per status of a job."""
    rows = current.where(F.col("job_name") == job_name)
    return rows.groupBy("processed_flag").agg(F.count("*").alias("rows")).orderBy("processed_flag")
