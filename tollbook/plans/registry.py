"""The manifest as kept in the table store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.operators.manifest import (
    claim_oldest,
    claimed_rows,
    current_state,
    latest_changes,
    outcome_changes,
    register_files,
    requeue_failed,
    with_dataset,
)
from tollbook.operators.quality import enforce_keys
from tollbook.schemas import CLAIMED, MANIFEST, SUCCESS, UNKNOWN
from tollbook.session import kept
from tollbook.sinks.pointer import ConcurrentWrite, Pointer
from tollbook.sinks.store import TableStore

#: Changes after which the state is written anew.
FOLD_AFTER = 16
#: Writers that change the manifest at once: each tries again so often.
TRIES = 20


class Manifest:
    """Claims and outcomes of one job.

    Every change is a version of its own, the tail. Once there are ``fold_after`` of them, the state is written as a snapshot, with
    files whose work has ended apart from the others, and the changes move to the history. A claim reads the open files
    of the snapshot and the tail. The pointer of the table refuses a writer whose state is no longer the latest, so two
    jobs that claim at once get different files.
    """

    def __init__(self, store: TableStore, job_name: str, fold_after: int = FOLD_AFTER) -> None:
        self.store, self.job_name, self.fold_after = store, job_name, fold_after

    def _rows(self, parts: list[str], now: Pointer | None = None) -> DataFrame:
        now = now or self.store.pointer(MANIFEST)
        return self.store.read_versions(MANIFEST, {f"part={p}": now.folders[f"part={p}"] for p in parts if f"part={p}" in now.folders})

    def state(self, now: Pointer | None = None) -> DataFrame:
        """Latest state of every file."""
        return current_state(self._rows(["open", "settled", "log"], now))

    def open_state(self, now: Pointer | None = None) -> DataFrame:
        """Latest state of the files that have not ended with success, and perhaps of some that have since the last fold."""
        return current_state(self._rows(["open", "log"], now))

    def log(self) -> DataFrame:
        """Every change since the last compaction."""
        return self._rows(["history", "log"])

    def _change(self, make: Callable[[Pointer], DataFrame], checked: bool = False) -> DataFrame:
        """Record the changes that ``make`` finds in the state of a pointer; again if another writer was faster."""
        for attempt in range(TRIES):
            now = self.store.pointer(MANIFEST)
            number = int(now.note.get("last_change", 0)) + 1
            changes = make(now)
            with kept(changes):
                if checked:
                    enforce_keys(changes, MANIFEST)
                rows = changes.select(*changes.columns, F.lit(number).alias("change_no"), F.lit("log").alias("part"))
                version, parts = self.store.write_version(rows, MANIFEST, checked=checked)
            if not parts:
                return changes
            tail = [*now.folders.get("part=log", []), version]
            try:
                self.store._advance(MANIFEST, now, now.folders | {"part=log": tail}, now.note | {"last_change": str(number)})
            except ConcurrentWrite:
                if attempt + 1 == TRIES:
                    raise
                continue
            if len(tail) >= self.fold_after:
                self.fold()
            return changes
        raise AssertionError("unreachable")

    def record(self, changes: DataFrame) -> None:
        """Add changes of rows: ``MANIFEST_COLUMNS``."""
        self._change(lambda now: changes)

    def fold(self, forget: bool = False) -> None:
        """Write the state as a snapshot; the changes join the history, or go with ``forget``."""
        now = self.store.pointer(MANIFEST)
        rows = self._rows(["open", "settled", "log"], now)
        ended = F.col("processed_flag") == SUCCESS
        state = latest_changes(rows).withColumn("part", F.when(ended, "settled").otherwise("open"))
        moved = self._rows([] if forget else ["log"], now).withColumn("part", F.lit("history"))
        version, parts = self.store.write_version(state.unionByName(moved).hint("rebalance", "part"), MANIFEST)
        folders = {f"part={p}": [version] if f"part={p}" in parts else [] for p in ("open", "settled")}
        older = [] if forget else now.folders.get("part=history", [])
        folders |= {"part=log": [], "part=history": [*older, *([version] if "part=history" in parts else [])]}
        try:
            self.store._advance(MANIFEST, now, folders, now.note)
        except ConcurrentWrite:
            pass  # the other writer goes on from the old snapshot, and a later change folds

    def register(self, found: DataFrame) -> None:
        """Add the paths of ``found`` (column s3_path) that the job has not seen as pending."""
        # Snapshot and tail name every known path and id, so the latest state is not needed.
        self._change(lambda now: register_files(found, self._rows(["open", "settled", "log"], now), self.job_name), checked=True)

    def claim(self, batch_id: str, files: int) -> DataFrame:
        """Claim the oldest pending files of the job for a batch: their rows and dataset."""
        claimed = self._change(lambda now: self._local(claim_oldest(self.open_state(now), self.job_name, batch_id, files)))
        return with_dataset(claimed)

    def resume(self, batch_id: str) -> DataFrame | None:
        """The claimed files of a batch that was lost; None if no file ever belonged to the id.

        An id that has ended, even in part, is refused: its rows would replace those of the first run.
        """
        log = self._rows(["open", "settled", "log", "history"]).where(F.col("job_name") == self.job_name)
        mine = log.where(F.col("batch_id") == batch_id).select("id").distinct()
        now = self._local(current_state(log.join(mine, "id", "left_semi")))
        rows = now.collect()
        if not rows:
            return None
        if any(r["batch_id"] != batch_id or r["processed_flag"] != CLAIMED for r in rows):
            raise ValueError(f"batch id {batch_id} has been used; a new batch needs a new id")
        return with_dataset(now)

    def _local(self, rows: DataFrame) -> DataFrame:
        """The rows of one batch, at most as many as it claims files, without what they were computed from."""
        return self.store.spark.createDataFrame(rows.collect(), rows.schema)

    def claimed(self, batch_id: str) -> DataFrame:
        """Claimed files of a batch with their dataset."""
        return with_dataset(claimed_rows(self.open_state(), self.job_name, batch_id))

    def open_batches(self) -> set[str]:
        """Batches with claimed files of a known dataset: their runs go on, or were lost and may be continued."""
        waiting = with_dataset(self.open_state().where(F.col("processed_flag") == CLAIMED))
        return {r[0] for r in waiting.where(F.col("dataset") != UNKNOWN).select("batch_id").distinct().collect()}

    def finish(self, claimed: DataFrame, batch_id: str, status: int, error: str | None = None) -> None:
        """Set the status of the batch's files; files of no known dataset stay claimed."""
        self.record(outcome_changes(claimed, batch_id, status, error))

    def requeue(self) -> None:
        """Put the failed files of the job back to work."""
        self._change(lambda now: requeue_failed(self.open_state(now), self.job_name))

    def compact(self) -> None:
        """Keep the latest change of each file only."""
        self.fold(forget=True)
