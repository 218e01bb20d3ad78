"""Key, reference and column rules, and backfills of missing keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tollbook.functions.dates import date_key
from tollbook.operators.dimensions import unique_keys
from tollbook.schemas import Table


class ConstraintError(ValueError):
    """Rows that break a rule of the table they are meant for."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; keys with NULL parts are exempt."""
    counts = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("rows"))
    return counts.where("rows > 1")


def broken_rules(required: Sequence[str] = (), widths: Mapping[str, int] | None = None) -> dict[str, Column]:
    """Not-null and text-width rules by their names: true for rows that break them."""
    broken = {f"{name} is null": F.col(name).isNull() for name in required}
    return broken | {f"{name} over {n}": F.length(name) > n for name, n in (widths or {}).items()}


def rule_violations(df: DataFrame, required: Sequence[str] = (), widths: Mapping[str, int] | None = None) -> DataFrame:
    """Number of rows breaking each not-null and text-width rule, found in one pass."""
    broken = broken_rules(required, widths)
    counts = df.agg(*[F.count_if(test).alias(rule) for rule, test in broken.items()])
    return counts.unpivot([], list(broken), "rule", "violations")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key, if any, the parent lacks."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def violations(df: DataFrame, table: Table, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rules of ``table`` the rows of ``df`` break, with the number of breaches."""
    counts = [rule_violations(df, table.required, table.widths)] if table.required or table.widths else []
    found = {f"duplicate {', '.join(keys)}": duplicate_keys(df, keys) for keys in table.unique}
    found |= {f"{key} without its dimension row": orphans(df, parent, key) for key, parent in (parents or {}).items()}
    counts += [rows.agg(F.lit(rule).alias("rule"), F.count("*").alias("violations")) for rule, rows in found.items()]
    if not counts:
        return df.sparkSession.createDataFrame([], "rule string, violations bigint")
    return reduce(DataFrame.unionByName, counts).where("violations > 0")


def enforce(df: DataFrame, table: Table, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The frame itself, or ConstraintError if its rows break a rule of ``table``."""
    _refuse(table, {row["rule"]: row["violations"] for row in violations(df, table, parents).collect()})
    return df


def enforce_keys(df: DataFrame, table: Table, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The same for the rules between rows only, uniqueness and references; :class:`Rules` sees to the others."""
    between = replace(table, required=(), widths={})
    return enforce(df, between, parents) if table.unique or parents else df


def _refuse(table: Table, counts: Mapping[str, int]) -> None:
    found = [f"{rule} ({n})" for rule, n in counts.items() if n]
    if found:
        raise ConstraintError(f"{table.name}: {'; '.join(found)}")


class Rules:
    """The not-null and width rules of a table, counted by Spark while an action goes over the rows anyway."""

    def __init__(self, table: Table) -> None:
        self.table, self.seen = table, Observation()
        self.broken = broken_rules(table.required, table.widths)

    def watch(self, df: DataFrame) -> DataFrame:
        """The same rows; an action over them, and over them once, fills the counts."""
        counts = [F.count_if(test).alias(rule) for rule, test in self.broken.items()]
        return df.observe(self.seen, *counts) if counts else df

    def check(self) -> None:
        """ConstraintError if the rows of the ended action break a rule."""
        if self.broken:
            _refuse(self.table, self.seen.get)


def backfill_date_key(fact: DataFrame) -> DataFrame:
    """Missing date keys computed from the date."""
    return fact.withColumn("date_key", F.coalesce("date_key", date_key("usage_date")))


def backfill_call_type_key(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Missing category keys looked up by the category text."""
    lookup = unique_keys(dim).select(F.col("call_type_code").alias("_code"), F.col("call_type_key").alias("_key"))
    found = fact.join(lookup, F.upper(F.trim("call_type")) == F.col("_code"), "left")
    filled = found.withColumn("call_type_key", F.coalesce("call_type_key", "_key"))
    return filled.select(*fact.columns)


def empty_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Whether each table has no rows; a task stops at the first one it finds."""
    tests = [df.limit(1).agg(F.lit(name).alias("table_name"), (F.count("*") == 0).alias("is_empty")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, tests)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
