"""Keys of the records that are known, laid out so that a batch can be compared without moving them.

A key is 16 bytes of a digest. Versions of keys are bucketed and sorted by it, so a join shuffles the records of the batch
to the buckets and reads the keys in place. Versions of batches that have ended are merged as they grow, each key a few
times at most, and into more buckets when there are many.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollbook.schemas import Table
from tollbook.session import empty_frame, remove_folder
from tollbook.sinks import pointer
from tollbook.sinks.pointer import Pointer, label_of, new_version
from tollbook.sinks.store import TableStore

#: Keys of a bucket: a table begins with so few buckets, and gets four times as many beyond so many keys a bucket.
FEWEST_BUCKETS, BUCKET_KEYS = 8, 8_000_000


def record_key(columns: Sequence[str]) -> Column:
    """16 bytes that stand for the values of the columns; a missing value is a value of its own."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


class KeyIndex:
    """The known keys of one table; ``table`` gives name and the one column."""

    def __init__(self, store: TableStore, table: Table, bucket_keys: int = BUCKET_KEYS) -> None:
        self.store, self.table, self.spark = store, table, store.spark
        self.root, self.bucket_keys = store.path(table), bucket_keys

    def pointer(self) -> Pointer:
        return pointer.current(self.spark, self.root)

    def exists(self) -> bool:
        """Whether keys were ever stored, were it none."""
        return self.pointer().number > 0

    @contextmanager
    def _bucketed(self, buckets: int):
        """Name of a table over all versions. Spark knows buckets of tables in its catalog only; frames stay good when the name is gone."""
        name, listed = f"tollbook_keys_{uuid.uuid4().hex}", "spark.sql.hive.manageFilesourcePartitions"
        before = self.spark.conf.get(listed)
        self.spark.conf.set(listed, "false")
        place = self.root.replace("'", "\\'")
        try:
            self.spark.sql(
                f"create table {name} (record_key binary, version string) using parquet partitioned by (version) "
                f"clustered by (record_key) sorted by (record_key) into {buckets} buckets location '{place}'"
            )
            try:
                yield name
            finally:
                self.spark.sql(f"drop table {name}")
        finally:
            self.spark.conf.set(listed, before)

    def _read(self, versions: Collection[str], buckets: int) -> DataFrame:
        if not versions:
            return empty_frame(self.spark, self.table.schema)
        with self._bucketed(buckets) as name:
            return self.spark.table(name).where(F.col("version").isin([v.partition("=")[2] for v in versions])).select("record_key")

    def known(self, without_batch: str | None = None) -> DataFrame:
        """``record_key`` of all valid versions, but for those of a batch; keys of several batches may repeat."""
        now = self.pointer()
        held = now.folders.get("", [])
        if without_batch is not None:
            held = self.store._without_batch(now, without_batch).get("", [])
        return self._read(held, int(now.note.get("buckets", FEWEST_BUCKETS)))

    def new_records(self, df: DataFrame, columns: Sequence[str], batch_id: str) -> DataFrame:
        """Rows of ``df`` whose key no other batch has stored; NULL values count as equal."""
        keyed = df.withColumn("record_key", record_key(columns))
        return keyed.join(self.known(batch_id), "record_key", "left_anti").drop("record_key")

    def _write(self, keys: DataFrame, version: str, buckets: int) -> None:
        path = f"{self.root}/{version}"
        rows = keys.select("record_key").repartition(buckets, "record_key")
        try:
            with self._bucketed(buckets) as name:
                rows.withColumn("version", F.lit(version.partition("=")[2])).write.insertInto(name)
        except Exception:
            remove_folder(self.spark, path)
            raise

    def put_batch(self, df: DataFrame, columns: Sequence[str], batch_id: str) -> None:
        """Store the keys of a batch's rows, in place of those it stored before."""
        now = self.pointer()
        buckets = int(now.note.get("buckets", FEWEST_BUCKETS))
        version = new_version(batch_id)
        self._write(df.select(record_key(columns).alias("record_key")).distinct(), version, buckets)
        held = [v for v in self.store._without_batch(now, batch_id).get("", [])]
        written = pointer.Files(self.spark).names(f"{self.root}/{version}")
        pointer.advance(self.spark, self.root, now, {"": [*held, version] if written else held}, now.note | {"buckets": str(buckets)})

    def remove_batch(self, batch_id: str) -> None:
        """Forget the keys of a batch that failed."""
        now = self.pointer()
        left = self.store._without_batch(now, batch_id)
        if left != now.folders:
            pointer.advance(self.spark, self.root, now, left, now.note)

    def merge(self, open_batches: Collection[str] = ()) -> None:
        """Merge the latest versions that together are as large as the one before them; those of open batches stay."""
        now = self.pointer()
        opened = tuple(map(label_of, open_batches))
        held = now.folders.get("", [])
        stay, ended = [v for v in held if v.startswith(opened)], [v for v in held if not v.startswith(opened)]
        if len(ended) < 2:
            return
        buckets = int(now.note.get("buckets", FEWEST_BUCKETS))
        sizes = self._sizes(ended, buckets)
        first, total = len(ended) - 1, sizes[-1]
        while first and sizes[first - 1] < 2 * total:
            first -= 1
            total += sizes[first]
        wanted = buckets
        while sum(sizes) > wanted * self.bucket_keys:
            wanted *= 4
        if wanted != buckets and not stay:
            first = 0
        else:
            wanted = buckets
        if first == len(ended) - 1:
            return
        version = new_version()
        self._write(self._read(ended[first:], buckets).distinct(), version, wanted)
        pointer.advance(self.spark, self.root, now, {"": [*ended[:first], version, *stay]}, now.note | {"buckets": str(wanted)})

    def _sizes(self, versions: Sequence[str], buckets: int) -> list[int]:
        """Keys of each version; a row per version."""
        with self._bucketed(buckets) as name:
            found = dict(self.spark.table(name).groupBy("version").agg(F.count("*").alias("n")).collect())
        return [found.get(v.partition("=")[2], 0) for v in versions]
