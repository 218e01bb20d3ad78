"""Helpers that several operators share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.session import written_once

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it back: computed once, and short lineage. It goes when the program ends."""
    return written_once(df, label)


def cut(df: DataFrame) -> DataFrame:
    """The same for a step of a loop; a checkpoint would compute the frame twice."""
    return written_once(df, "step")


def sample(df: DataFrame, limit: int, *keys: str) -> DataFrame:
    """At most ``limit`` rows, those with the smallest hashes of ``keys``.

    A bound on the hash, from the number of rows, lets little more than these leave the tasks.
    """
    place, count = F.xxhash64(*keys), df.count()
    if count > 2 * limit:
        share = (1.2 * limit + 500) / count
        df = df.where(place <= int(-(1 << 63) + min(1.0, share) * ((1 << 64) - 1025)))
    return df.orderBy(place, *keys).limit(limit)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def text_of(column: str = "text") -> Column:
    """Null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def held(name: str):
    """A namespace that lives as long as the Python worker, for what tasks may share."""
    return sys.modules.setdefault(f"_tollbook_held_{name}", types.ModuleType(name)).__dict__
