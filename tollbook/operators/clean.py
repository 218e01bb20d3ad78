"""Normalising, dropping and de-duplicating raw records."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollbook.functions.text import without_null_tokens
from tollbook.operators.shape import business_columns, select_present
from tollbook.session import broadcast_within

#: Files of a batch whose order is sent to every executor; the order of more is joined.
MOST_FILES = 100_000


def normalize_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Apply :func:`~tollbook.functions.text.clean_text` to the string columns among ``columns`` (default: all)."""
    chosen = set(df.columns if columns is None else columns)
    texts = [name for name, kind in df.dtypes if kind == "string" and name in chosen]
    # Two steps, so that each text is trimmed once and not per use.
    trimmed = df.withColumns({name: F.trim(name) for name in texts})
    return trimmed.withColumns({name: without_null_tokens(name) for name in texts})


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop rows that hold nothing but lineage."""
    names = business_columns(df)
    return df.dropna(how="all", subset=names) if names else df


def dedup_by_keys(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key by ``order``; NULL keys count as equal.

    Spark limits each group before the shuffle as well (WindowGroupLimit), so a
    key with very many copies sends one row per task, not all of them.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def deduplicate(df: DataFrame, candidate_keys: Iterable[str], first_by: str | None = None) -> DataFrame:
    """One row per key, the same row however the input is partitioned.

    Keys are the candidates the frame has; without any, whole business rows are
    compared. The winner is the smallest by source file and remaining columns, or
    by the column ``first_by`` before these, which is then dropped.
    """
    if first_by:
        keys = [name for name in candidate_keys if name in df.columns]
        keys = keys or business_columns(df.drop(first_by))
        rest = sorted((name for name in df.columns if name not in [*keys, first_by]), key=lambda name: name != "_source_file")
        order = [F.col(first_by).asc_nulls_last(), *[F.col(name).asc_nulls_first() for name in rest]]
        return dedup_by_keys(df, keys, order).drop(first_by) if keys else df.drop(first_by)
    keys = [name for name in candidate_keys if name in df.columns] or business_columns(df)
    if not keys:
        return df
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order = sorted(rest, key=lambda name: name != "_source_file")
    return dedup_by_keys(df, keys, [F.col(name).asc_nulls_first() for name in order])


def drop_known(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``existing``; NULL keys count as equal."""
    # distinct() merges copies map-side, so a hot key reaches the join once.
    known = existing.select(*[F.col(name).alias(f"_known_{name}") for name in keys]).distinct()
    match = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_known_{name}")) for name in keys])
    return df.join(known, match, "left_anti")


def clean_records(
    df: DataFrame, columns: Sequence[str], candidate_keys: Sequence[str], files: DataFrame | None = None
) -> DataFrame:
    """Whole cleaning step of one source: select, normalise, drop empty, de-duplicate.

    With ``files`` (file, place), of rows with one key that of the first file stays, before anything else decides.
    """
    chosen = drop_all_null(normalize_strings(select_present(df, columns), columns))
    if files is None:
        return deduplicate(chosen, candidate_keys)
    # One row per claimed file, and two short texts in it.
    places = broadcast_within(files.select(plain_path("file").alias("_file"), F.col("place").alias("_first")), MOST_FILES, files)
    placed = chosen.join(places, plain_path("_source_file") == F.col("_file"), "left").drop("_file")
    return deduplicate(placed, candidate_keys, "_first")


def plain_path(column: str) -> Column:
    """A file's path in one spelling: escapes resolved, one slash after the scheme."""
    whole = F.try_url_decode(F.replace(column, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(F.coalesce(whole, F.col(column)), "^([a-z0-9]+):/+", "$1:/")
