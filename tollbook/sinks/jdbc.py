"""Database output."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tollbook.sinks.files import target_partitions

logger = logging.getLogger(__name__)


def with_retries(action: Callable[[], None], attempts: int = 3, wait_seconds: float = 5.0) -> None:
    """Run ``action`` until it succeeds, at most ``attempts`` times; the last error is raised."""
    most = max(attempts, 1)
    for attempt in range(1, most + 1):
        try:
            return action()
        except Exception as error:
            if attempt == most:
                raise
            logger.warning("attempt %d of %d failed: %s", attempt, most, error)
            time.sleep(max(wait_seconds, 0.0))


def jdbc_write_options(connection: Mapping[str, str], batch_rows: int, timeout_seconds: int = 0) -> dict[str, str]:
    """Writer options: batched inserts outside a transaction, overwrite recreates the table.

    The driver joins the rows of a batch into one insert; a statement ends after ``timeout_seconds`` (0: never).
    """
    return {
        "reWriteBatchedInserts": "true",
        "queryTimeout": str(timeout_seconds),
        "batchsize": str(batch_rows),
        "isolationLevel": "NONE",
        "truncate": "false",
        **connection,
    }


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    connection: Mapping[str, str],
    mode: str = "append",
    batch_rows: int = 20_000,
    partitions: int | None = None,
    timeout_seconds: int = 0,
    attempts: int = 3,
    wait_seconds: float = 5.0,
) -> None:
    """Write a frame to a table, one connection per partition of its plan or, merged, at most ``partitions``.

    A repeated append can leave rows of the failed attempt behind. Where that
    matters keep the rows in the table store, which replaces them per batch.
    """
    writer = target_partitions(df, partitions, shrink=True).write.format("jdbc").mode(mode)
    writer = writer.options(url=url, dbtable=table, **jdbc_write_options(connection, batch_rows, timeout_seconds))
    with_retries(writer.save, attempts, wait_seconds)
