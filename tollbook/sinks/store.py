"""Tables as Parquet folders below one root.

Plain tables are their partition folders. Versioned tables (``Table.versioned``) keep each write in a version folder of its own,
and a pointer names the versions that hold each partition: every change of such a table, of however many partitions, is seen
whole or not at all, rows that are replaced can be read while they are, and a second writer is refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tollbook.operators.quality import Rules
from tollbook.schemas import Table
from tollbook.session import empty_frame, remove_folder
from tollbook.sinks import pointer
from tollbook.sinks.pointer import Files, Pointer, label_of, new_version

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class TableStore:
    """Reads and writes the stored tables. One writer at a time; versioned tables refuse a second."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def read(self, table: Table, folders: Mapping[str, Iterable] | None = None) -> DataFrame:
        """All rows, or those in the folders with the given values; empty before the first write.

        ``folders`` names values of partition columns. Only these folders are listed and
        read; columns left out match any value.
        """
        if table.versioned:
            return self.read_versions(table, self._chosen(self.pointer(table), table, folders))
        root, path = self.path(table), self.path(table)
        for name in table.partitioned_by if folders else ():
            path += f"/{name}=" + self._folder(folders.get(name))
        place, files = Files(self.spark).place(path)
        if not files.globStatus(place):
            return empty_frame(self.spark, table.schema)
        return self.spark.read.schema(table.schema).option("basePath", root).parquet(path)

    def pointer(self, table: Table) -> Pointer:
        """What is valid of a versioned table now."""
        return pointer.current(self.spark, self.path(table))

    def read_versions(self, table: Table, folders: Mapping[str, list[str]]) -> DataFrame:
        """The rows of the given versions by partition, and no others, whatever is written meanwhile."""
        root = self.path(table)
        found = [f"{root}/{version}" + (f"/{name}" if name else "") for name, held in folders.items() for version in held]
        if not found:
            return empty_frame(self.spark, table.schema)
        rows = self.spark.read.schema(table.schema).option("basePath", root)
        return rows.parquet(*[re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in found]).select(*table.schema.fieldNames())

    def _chosen(self, now: Pointer, table: Table, folders: Mapping[str, Iterable] | None) -> dict[str, list[str]]:
        """Partitions of a pointer with the given values."""
        wanted = {name: {f"{name}={self._escaped(v)}" for v in values} for name, values in (folders or {}).items() if values is not None}
        places = [(table.partitioned_by.index(name), values) for name, values in wanted.items()]
        return {part: held for part, held in now.folders.items() if all(part.split("/")[i] in values for i, values in places)}

    def _escaped(self, value) -> str:
        escape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return NULL_FOLDER if value is None else escape(str(value))

    def _folder(self, values: Iterable | None) -> str:
        """Glob for partition folders of these values."""
        if values is None:
            return "*"
        names = [re.sub(r"([{},\\])", r"\\\1", self._escaped(v)) for v in values]
        return names[0] if len(names) == 1 else "{" + ",".join(sorted(names)) + "}"

    def read_batch(self, table: Table, batch_id: str) -> DataFrame:
        """Rows one batch wrote; only its folders are listed."""
        return self.read(table, {"batch_id": [batch_id]})

    def remove_batch(self, table: Table, batch_id: str) -> None:
        """Delete what a batch has written."""
        if table.versioned:
            now = self.pointer(table)
            left = self._without_batch(now, batch_id)
            if left != now.folders:
                self._advance(table, now, left)
            return
        pattern = self.path(table) + "".join(
            f"/{name}=" + self._folder([batch_id] if name == "batch_id" else None) for name in table.partitioned_by
        )
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
        found = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
        for folder in found or []:
            remove_folder(self.spark, folder.getPath().toString())

    def _shaped(self, df: DataFrame, table: Table) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType) for f in table.schema])

    def _writer(self, df: DataFrame, table: Table) -> DataFrameWriter:
        """Writes folders by partition; files hold rows in order of the columns they are looked up by, with Bloom filters."""
        if table.lookups:
            # Inside a folder, so that no other order is needed to write it.
            df = df.sortWithinPartitions(*table.partitioned_by, *table.lookups)
        bloom = {f"parquet.bloom.filter.enabled#{name}": "true" for name in table.lookups}
        return df.write.partitionBy(*table.partitioned_by).options(**bloom)

    # Versioned tables.

    def write_version(self, df: DataFrame, table: Table, label: str = "", checked: bool = False) -> tuple[str, list[str]]:
        """Rows in a version folder that no pointer names yet, and the partitions they are in.

        With ``checked`` the not-null and width rules of the table are counted while the rows are written. If one is
        broken, the folder goes again, and the error is that of ``enforce``.
        """
        version = new_version(label)
        path = f"{self.path(table)}/{version}"
        rules = Rules(table) if checked else None
        try:
            rows = self._shaped(df, table)
            rows = rules.watch(rows) if rules else rows
            self._writer(rows, table).parquet(path)
            if rules:
                rules.check()
        except Exception:
            remove_folder(self.spark, path)
            raise
        parts = [""]
        for name in table.partitioned_by:
            inside = [(part, found) for part in parts for found in Files(self.spark).names(f"{path}/{part}")]
            parts = [f"{part}/{found}".lstrip("/") for part, found in inside if found.startswith(f"{name}=")]
        if not parts:
            remove_folder(self.spark, path)
        return version, parts

    def _advance(self, table: Table, now: Pointer, folders: Mapping[str, list[str]], note: dict[str, str] | None = None) -> None:
        pointer.advance(self.spark, self.path(table), now, dict(folders), note)

    @staticmethod
    def _without_batch(now: Pointer, batch_id: str) -> dict[str, list[str]]:
        mine = label_of(batch_id)
        return {part: [v for v in held if not v.startswith(mine)] for part, held in now.folders.items()}

    def put_batch(self, df: DataFrame, table: Table, batch_id: str, checked: bool = False) -> None:
        """Add rows of a batch to a versioned table in one step, in place of what it wrote before."""
        now = self.pointer(table)
        stamped = df.withColumns({"created_at": F.current_timestamp(), "batch_id": F.lit(batch_id)})
        version, parts = self.write_version(stamped, table, batch_id, checked)
        folders = self._without_batch(now, batch_id)
        for part in parts:
            folders[part] = [*folders.get(part, []), version]
        self._advance(table, now, folders)

    def replace(self, df: DataFrame, table: Table, checked: bool = False) -> None:
        """Replace the partitions that occur in ``df``, which may read them, all in one step."""
        now = self.pointer(table)
        version, parts = self.write_version(df, table, "", checked)
        self._advance(table, now, now.folders | {part: [version] for part in parts})

    def merge_partitions(self, table: Table, parts: Iterable[str], stay: Iterable[str] = ()) -> list[str]:
        """Bring the versions of each of these partitions together in one; rows stay the same.

        Versions of the batches in ``stay`` are left as they are. Partitions that are in one version already are left too,
        so repeating it changes nothing. Returns the partitions that were merged.
        """
        now = self.pointer(table)
        kept = tuple(map(label_of, stay))
        old = {part: [v for v in now.folders.get(part, []) if not v.startswith(kept)] for part in parts}
        old = {part: held for part, held in old.items() if len(held) > 1}
        if not old:
            return []
        rows = self.read_versions(table, old)
        version, written = self.write_version(rows.hint("rebalance", *table.partitioned_by), table)
        folders = dict(now.folders)
        for part, held in old.items():
            folders[part] = [v for v in folders[part] if v not in held] + ([version] if part in written else [])
        self._advance(table, now, folders)
        return sorted(old)

    # Plain tables; of versioned ones, the same in one step.

    def append(self, df: DataFrame, table: Table, checked: bool = False) -> None:
        """Add rows; ``checked`` as for ``write_version``."""
        if table.versioned:
            now = self.pointer(table)
            version, parts = self.write_version(df, table, "", checked)
            self._advance(table, now, now.folders | {part: [*now.folders.get(part, []), version] for part in parts})
            return
        self._writer(self._shaped(df, table), table).mode("append").parquet(self.path(table))

    def overwrite(self, df: DataFrame, table: Table) -> None:
        """Replace the whole table."""
        if table.versioned:
            now = self.pointer(table)
            version, parts = self.write_version(df, table)
            self._advance(table, now, {part: [version] for part in parts})
            return
        self._shaped(df, table).write.mode("overwrite").parquet(self.path(table))

    def replace_partitions(self, df: DataFrame, table: Table) -> None:
        """Replace exactly the partitions that occur in ``df``; repeating it changes nothing.

        ``df`` must not read the partitions it replaces, unless the table is versioned.
        """
        if table.versioned:
            self.replace(df, table)
            return
        writer = self._writer(self._shaped(df, table), table).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path(table))

    def write_batch(self, df: DataFrame, table: Table, batch_id: str) -> None:
        """Write the rows of a batch, replacing what it wrote before."""
        self.replace_partitions(df.withColumn("batch_id", F.lit(batch_id)), table)
