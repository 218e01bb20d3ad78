"""Connected components of a graph that never leaves the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every greater neighbour of a node on the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("m").alias("a"), "b").where("a < b")
    return moved.union(least.select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)`` other than its component's smallest node, the root.

    Alternates the two star steps until nothing changes; each leaves a forest of fewer levels. Minima are taken
    before rows meet, and the joins can be split, so a node with many edges burdens no task.
    """
    pairs = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    now, seen = cut(pairs), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        seen = mark
        now = cut(_small_star(_large_star(now)))
