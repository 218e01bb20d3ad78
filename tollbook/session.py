"""Spark session and the settings that follow the size of a job."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.parquet.compression.codec": "snappy",
}

SHUFFLE_BYTES_PER_PARTITION = 128 * 1024 * 1024
MANY_PARTITIONS = 8192


def build_session(app_name: str = "tollbook", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULT_CONF | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the checkpoint folder the cluster names; what is written there goes when the program ends.

    Only a local master may fall back to a temporary folder of this machine,
    because executors on other hosts could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="tollbook-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    # The file system removes the folder when the JVM ends, whether or not the session was stopped before.
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return f"{place.toString()}/data"


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of a schema, in a form the optimizer recognises and drops from joins and unions."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).where(F.lit(False)).select(*nothing)


def shuffle_partitions_for(input_bytes: int, at_least: int) -> int:
    """Partitions near 128 MB each; past ``MANY_PARTITIONS`` both number and size grow with the root of the input.

    Every map task writes a block per partition, so a number that follows the input
    makes blocks by its square.
    """
    wanted = -(-input_bytes // SHUFFLE_BYTES_PER_PARTITION)
    if wanted > MANY_PARTITIONS:
        wanted = math.isqrt(wanted * MANY_PARTITIONS)
    return max(at_least, wanted)


@contextmanager
def shuffles_sized_for(spark: SparkSession, input_bytes: int):
    """Raise ``spark.sql.shuffle.partitions`` for a large input; AQE merges what is too small."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(shuffle_partitions_for(input_bytes, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def files_side_by_side(spark: SparkSession, most: int):
    """Let a task that writes folders by partition hold up to ``most`` files open, each row going straight to its own.

    Spark would sort all rows of a task by folder first, in memory that grows with them, and still does so beyond ``most``.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written_once(df: DataFrame, label: str, *folders: str) -> DataFrame:
    """The frame read back from the shared folder, so that several uses compute it once; removed when the program ends."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*folders).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate or replaced data, if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def broadcast_within(df: DataFrame, max_rows: int, counted: DataFrame | None = None) -> DataFrame:
    """Hint a broadcast when ``df`` has at most ``max_rows`` rows, else leave the join to Spark.

    The check stops reading at ``max_rows + 1`` rows. Use it on stored tables
    of narrow rows; on computed frames adaptive execution measures the size itself.
    ``counted`` is a stored table with at least as many rows, for frames that must be computed first.
    """
    fits = (df if counted is None else counted).limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if fits else df


@contextmanager
def kept(df: DataFrame):
    """Keep a frame while several actions use it; lost blocks are computed again from stored tables."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
