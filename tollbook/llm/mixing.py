"""Mixing sources to target weights by hierarchical budgets.

A token budget flows down a tree of domains, languages and sources by weight. A child never gets more than the
tokens its documents hold over the allowed epochs; what it can't use goes to its siblings, and only what a whole
subtree can't use goes to the siblings above. Each leaf then takes whole epochs and a prefix of one more, in a
seeded order. Everything is built-in Spark expressions, and whole numbers make the result exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollbook.llm.common import stored, text_of

LEVELS = ("domain", "lang", "source")


def count_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Place of a document in a seeded epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string")))


def _shares(children: DataFrame, above: list[str], budget: str) -> DataFrame:
    """Adds ``share``: the budget of ``above`` by ``weight``, at most ``room`` each, the rest to the others by weight.

    In order of room per weight, a child is full if its part of what the smaller ones leave is at least its room.
    """
    family = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(1))
    order = family.orderBy(F.col("room").cast("double") / F.col("weight").cast("double"), *LEVELS)
    wide = "decimal(38,0)"
    placed = children.select(
        "*",
        F.coalesce(F.sum("room").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("_heavier"),
    )
    full = F.col("room").cast(wide) * F.col("_heavier") <= F.col("weight").cast(wide) * (F.col(budget) - F.col("_before"))
    marked = placed.withColumn("_full", full)
    rest = marked.select(
        "*",
        F.coalesce(F.sum(F.when(F.col("_full"), F.col("room"))).over(family), F.lit(0)).alias("_used"),
        F.sum(F.when(~F.col("_full"), F.col("weight"))).over(family).alias("_open"),
    )
    part = F.expr(f"cast(weight as {wide}) * ({budget} - _used) div _open")
    return rest.withColumn("share", F.when(F.col("_full"), F.col("room")).otherwise(part)).drop(
        "_before", "_heavier", "_full", "_used", "_open"
    )


def leaf_budgets(leaves: DataFrame, budget: Column, max_epochs: int, weights: dict[str, Column]) -> DataFrame:
    """Budgets for ``leaves(domain, lang, source, supply)``: adds ``epochs`` (whole ones) and ``rest`` (tokens of one more).

    ``budget`` is an aggregate over the supply. Weights are whole numbers; one missing or below 1 counts as 1. A leaf without tokens costs nothing and gets one epoch.
    """
    tree = leaves.withColumn("room", F.col("supply") * F.lit(max_epochs))
    total = leaves.agg(budget.cast("bigint")).first()[0] or 0  # one number
    for depth, level in enumerate(LEVELS):
        names = list(LEVELS[: depth + 1])
        here = tree.groupBy(*names).agg(F.sum("room").alias("room")).withColumn(
            "weight", F.greatest(F.coalesce(weights[level].cast("bigint"), F.lit(1)), F.lit(1))
        )
        for missing in LEVELS[depth + 1 :]:
            here = here.withColumn(missing, F.lit(""))
        here = here.withColumn("_budget", F.lit(total).cast("bigint")) if depth == 0 else here.join(above, names[:-1])
        above = _shares(here, names[:-1], "_budget").select(*names, F.col("share").alias("_budget"))
    epochs = F.when(F.col("supply") == 0, F.lit(1).cast("bigint")).otherwise(F.expr("_budget div supply"))
    rest = F.when(F.col("supply") == 0, F.lit(0).cast("bigint")).otherwise(F.col("_budget") % F.col("supply"))
    return leaves.join(above, list(LEVELS)).select(*LEVELS, "supply", epochs.alias("epochs"), rest.alias("rest"))


def slice_digits(rows: int) -> int:
    """Hexadecimal digits of the order key that name a slice of a leaf: about as many slices as rows in each."""
    return max(1, math.ceil(math.log(max(1, rows), 16) / 2))


def leaf_cutoffs(docs: DataFrame, budgets: DataFrame, seed: int, digits: int) -> DataFrame:
    """The last order key that each leaf's prefix reaches, and the tokens before it: ``..., cutoff, before``.

    Sums over slices of the keys, by their first ``digits``, find the slice that holds the end, and only its rows are put in
    order, so of a leaf with a third of all rows a task sorts about the root of their number.
    """
    leaf = list(LEVELS)
    keyed = docs.join(budgets, leaf).where("rest > 0").select(
        *leaf, "rest", "tokens", order_key(seed, F.col("epochs"), F.col("doc_id")).alias("key")
    ).withColumn("slice", F.substring("key", 1, digits))
    slices = keyed.groupBy(*leaf, "rest", "slice").agg(F.sum("tokens").alias("tokens"))
    by_slice = Window.partitionBy(*leaf).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = slices.withColumn("before", F.coalesce(F.sum("tokens").over(by_slice), F.lit(0))).where(
        "before < rest and before + tokens >= rest"
    )
    inside = keyed.join(ends.select(*leaf, "slice", "before"), [*leaf, "slice"])
    keys = inside.groupBy(*leaf, "rest", "before", "key").agg(F.sum("tokens").alias("tokens"))
    by_key = Window.partitionBy(*leaf).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    reached = keys.withColumn("before", F.col("before") + F.coalesce(F.sum("tokens").over(by_key), F.lit(0))).where("before < rest")
    return reached.groupBy(*leaf).agg(F.max("key").alias("cutoff"), F.max_by("before", "key").alias("before"))


def plan_mix(
    documents: DataFrame,
    domain: Column,
    weights: dict[str, Column],
    budget: Column,
    max_epochs: int = 4,
    seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """The leaves with their ``epochs, rest, cutoff, before``, and the narrow rows they were counted from.

    ``domain`` is computed from the documents' columns; each of ``weights`` from the columns of its level and
    those above. Documents are read once; what follows works on five narrow columns.
    """
    narrow = stored(
        documents.select(
            "doc_id", F.coalesce(domain, F.lit("")).alias("domain"), text_of("lang").alias("lang"),
            text_of("source").alias("source"), count_tokens(text_of()).alias("tokens"),
        ),
        "mix-documents",
    )
    leaves = stored(narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("supply"), F.count("*").alias("documents")), "mix-leaves")
    largest = leaves.agg(F.coalesce(F.max("documents"), F.lit(0))).first()[0]
    budgets = stored(leaf_budgets(leaves, budget, max_epochs, weights), "mix-budgets")
    plan = budgets.join(leaf_cutoffs(narrow, budgets, seed, slice_digits(largest)), list(LEVELS), "left")
    return stored(plan, "mix-plan"), narrow


def _taken(seed: int) -> Column:
    """Tokens of a document inside the prefix of its leaf's last epoch."""
    inside = order_key(seed, F.col("epochs"), F.col("doc_id"))
    end = F.least("tokens", F.col("rest") - F.col("before"))
    return F.when(inside < F.col("cutoff"), F.col("tokens")).when(inside == F.col("cutoff"), end).otherwise(F.lit(0))


def select_tokens(
    documents: DataFrame, domain: Column, weights: dict[str, Column], budget: Column, max_epochs: int = 4, seed: int = 7
) -> DataFrame:
    """``doc_id, domain, lang, source, tokens, epochs, prefix_tokens`` of every document that is used.

    A document counts in ``epochs`` whole epochs and with its first ``prefix_tokens`` tokens in one more; the last
    document of a prefix is cut. Null domains, languages, sources and texts count as empty; a null id has its own
    place in the order. A document without tokens shows in whole epochs only. Rows of one id share their place, so repeated
    rows are taken together. Shares are rounded down to whole tokens. Other columns are ignored; no rows give none.
    """
    plan, narrow = plan_mix(documents, domain, weights, budget, max_epochs, seed)
    used = narrow.join(plan, list(LEVELS)).withColumn("prefix_tokens", _taken(seed).cast("bigint"))
    return used.select("doc_id", *LEVELS, "tokens", "epochs", "prefix_tokens").where("epochs > 0 or prefix_tokens > 0")


def mix_documents(
    documents: DataFrame, domain: Column, weights: dict[str, Column], budget: Column, max_epochs: int = 1, seed: int = 7
) -> DataFrame:
    """The documents themselves, once for each epoch that uses them, whole even where the prefix ends inside.

    The same cases as in ``select_tokens``. All columns stay, whatever their names.
    """
    plan, _ = plan_mix(documents, domain, weights, budget, max_epochs, seed)
    # Positions instead of names: documents may hold columns of the same names.
    names = [f"_mix_{i}" for i in range(len(documents.columns))]
    place = {name: names[i] for i, name in reversed(list(enumerate(documents.columns)))}
    leaf = {"domain": F.coalesce(domain, F.lit("")), "lang": text_of("lang"), "source": text_of("source")}
    keyed = documents.select("*", *[leaf[x].alias(f"_mix_{x}") for x in LEVELS]).toDF(*names, *[f"_mix_{x}" for x in LEVELS])
    plan = plan.select(*[F.col(x).alias(f"_mix_{x}") for x in LEVELS], "epochs", "rest", "cutoff")
    joined = keyed.join(plan, [f"_mix_{x}" for x in LEVELS])
    prefix = order_key(seed, F.col("epochs"), F.col(place["doc_id"])) <= F.col("cutoff")
    times = F.col("epochs") + F.when(prefix, 1).otherwise(0)
    if max_epochs == 1:
        kept = joined.where(times > 0)
    else:
        kept = joined.where(times > 0).withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), times.cast("int"))))
    return kept.select(*[F.col(names[i]).alias(name) for i, name in enumerate(documents.columns)])
