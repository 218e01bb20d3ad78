"""Files registered and loaded as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tollbook.plans.batch import BatchOptions, run_all
from tollbook.plans.registry import Manifest
from tollbook.sinks.store import TableStore

# Columns of Spark's binary file source.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Stream of the paths and change times of files that arrive in a folder; contents are not read."""
    found = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .options(recursiveFileLookup=True, pathGlobFilter=pattern)
        .load(folder)
    )
    return found.select(F.col("path").alias("s3_path"), "modificationTime")


def _start(found: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return found.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def register_arrivals(
    spark: SparkSession,
    manifest: Manifest,
    folder: str,
    checkpoint: str,
    pattern: str = "*.csv",
    interval: str | None = None,
) -> StreamingQuery:
    """Add files arriving in ``folder`` to the manifest as pending.

    Without ``interval`` the query handles what is there and ends. A repeated
    micro-batch adds nothing, because known paths are left out.
    """
    return _start(arrivals(spark, folder, pattern), lambda found, _: manifest.register(found), checkpoint, interval)


def load_arrivals(
    spark: SparkSession,
    store: TableStore,
    folder: str,
    checkpoint: str,
    options: BatchOptions = BatchOptions(),
    pattern: str = "*.csv",
    interval: str | None = None,
    same_file_within: str = "7 days",
) -> StreamingQuery:
    """Register arriving files and load them, batch by batch, until nothing is pending.

    A path that arrives again within ``same_file_within`` of its change time is dropped by the stream's state, and later than that
    by the manifest. A stream that is stopped or lost goes on from its checkpoint: files whose micro-batch is
    repeated are known, and those that were registered but not loaded are loaded. A batch that fails ends the stream
    with its error; its files are marked, as in any run.
    """
    manifest = Manifest(store, options.job_name)
    fresh = arrivals(spark, folder, pattern).withWatermark("modificationTime", same_file_within).dropDuplicatesWithinWatermark(["s3_path"])

    def load(found: DataFrame, _: int) -> None:
        manifest.register(found)
        run_all(spark, store, options)

    return _start(fresh, load, checkpoint, interval)
