"""Parquet output."""

from __future__ import annotations

from pyspark.sql import DataFrame


def target_partitions(df: DataFrame, partitions: int | None, shrink: bool = False) -> DataFrame:
    """Set the number of write tasks.

    None keeps the plan, whose last shuffle adaptive execution sizes. ``shrink``
    merges partitions without a shuffle; use it only where the frame has more
    than ``partitions`` and the work before it is light, as it runs in as few tasks.
    """
    if partitions is None:
        return df
    wanted = max(partitions, 1)
    return df.coalesce(wanted) if shrink else df.repartition(wanted)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partitions: int | None = None, shrink: bool = False
) -> None:
    """Write snappy Parquet."""
    target_partitions(df, partitions, shrink).write.mode(mode).option("compression", "snappy").parquet(path)
