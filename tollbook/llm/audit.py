"""How text filters act together: every order of them, and what each filter adds at its place.

Rows are first counted by the set of filters they fail, a mask. A recursive query then extends each prefix of an
order by every letter not in it, joins the mask cells of the part, carries the bits applied so far, and emits
the counts of that step. So texts are read once, and the orders work on at most 32 cells a part.
"""

from __future__ import annotations

import re
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tollbook.llm.common import stored, text_of

FILTERS = "ABCDE"
#: Thresholds of the filters: words; distinct words, capitals, both in a hundred.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
MARKS = re.compile(rb"[#$%&*|]")
CAPITALS, CONTINUED = bytes(range(65, 91)), bytes(range(128, 192))
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failed_text_filters(text: bytes) -> int:
    """Bits of the filters A to D that a text fails; words stand between ASCII white space."""
    words = text.split()
    size, distinct = len(words), len(set(words))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text.translate(None, CONTINUED))
    return (
        (size < LEAST_WORDS)
        | (100 * distinct < LEAST_DISTINCT * size) << 1
        | (100 * capitals > MOST_CAPITALS * points) << 2
        | (MARKS.search(text) is not None) << 3
    )


@F.arrow_udf(IntegerType())
def text_failures(texts: pa.Array) -> pa.Array:
    return pa.array([failed_text_filters(t) for t in texts.cast(pa.binary()).to_pylist()], pa.int32())


def mask_cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: rows of ``documents(doc_id, text, source)`` by part and failed filters.

    Equal texts are found by their SHA-256. The smallest id of each text is looked up by text and id together,
    so that a text with a third of all rows is spread like any other. Labels of one id count once, if any of them says so.
    """
    narrow = documents.select(
        "doc_id", F.coalesce("source", F.lit("")).cast("string").alias("part"),
        F.unhex(F.sha2(text_of(), 256)).alias("digest"), text_failures(text_of()).alias("failed"),
    )
    narrow = stored(narrow, "audit-documents")
    # One row per text; a row is a copy unless it has this id. Rows without an id are nobody's copies.
    first = narrow.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    copy = F.col("is_first").isNull() & F.col("doc_id").isNotNull()
    rows = narrow.join(first, ["doc_id", "digest"], "left").join(marks, "doc_id", "left").select(
        "part", F.col("failed").bitwiseOR(F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"), "good", "toxic"
    )
    return rows.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if(F.col("good") == 1).alias("good"), F.count_if(F.col("toxic") == 1).alias("toxic")
    )


def _total(field: str, test: str) -> str:
    """SQL: sum of a field over the cells that fit."""
    return f"aggregate(filter(c.cells, x -> {test}), cast(0 as bigint), (t, x) -> t + x.{field})"


_HIT, _BEFORE = "x.mask & s.f.bit <> 0", "x.mask & s.applied"
_REMOVED = f"{_HIT} and {_BEFORE} = 0"
_LETTERS = ", ".join(f"named_struct('letter', '{letter}', 'bit', {1 << i})" for i, letter in enumerate(FILTERS))
#: Prefixes of all orders, level by level, with the counts of the step that the last letter makes.
ENUMERATION = f"""
with recursive steps (part, prefix, step, applied, {', '.join(COUNTS)}) as (
  select part, '', 0, 0, {', '.join(['cast(0 as bigint)'] * len(COUNTS))} from {{cells}}
  union all
  select s.part, concat(s.prefix, s.f.letter), s.step + 1, s.applied | s.f.bit,
    {_total('n', 'x.mask & (s.applied | s.f.bit) = 0')},
    {_total('n', _REMOVED)},
    {_total('n', f'{_HIT} and {_BEFORE} <> 0')},
    {_total('n', 'x.mask = s.f.bit')},
    {_total('good', _REMOVED)},
    {_total('toxic', _REMOVED)}
  from (select part, prefix, step, applied, explode(filter(array({_LETTERS}), f -> applied & f.bit = 0)) as f from steps) s
  join {{cells}} c on c.part = s.part)
select * from steps where step > 0
"""


@contextmanager
def _rows_of_recursion(spark: SparkSession):
    """A recursion gives 326 rows a part, however many parts there are; Spark's own limit is a million."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def filter_steps(cells: DataFrame) -> DataFrame:
    """Counts of ``cells(part, mask, n, good, toxic)`` at the last filter of every prefix of an order: 325 rows a part."""
    held = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    held = stored(held, "audit-cells")
    with _rows_of_recursion(cells.sparkSession):
        return stored(cells.sparkSession.sql(ENUMERATION, cells=held), "audit-steps")


def audit_filters(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step``, the counts of the step and ``shapley``: 600 rows a part.

    A null text counts as empty, a null source as the part of the empty name. A row without an id copies
    nobody and is copied by nobody; rows of one id and text are no copies of each other. Repeated rows count each. Other columns are
    ignored; no documents give no rows, and documents without labels lose nothing good or toxic.
    """
    steps = filter_steps(mask_cells(documents, labels))
    width = len(FILTERS)
    orders = steps.where(F.col("step") == width).select(
        "part", F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(width))).alias("step")
    )
    orders = orders.withColumn("prefix", F.substring("filter_order", F.lit(1), F.col("step")))
    placed = orders.join(steps.drop("step", "applied"), ["part", "prefix"])
    of_filter = Window.partitionBy("part", F.substring("prefix", -1, 1))
    return placed.select("part", "filter_order", "step", *COUNTS, F.sum("removed").over(of_filter).alias("shapley"))
