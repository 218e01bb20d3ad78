"""Exact top-k inner products by ball-tree branch and bound.

Rows are grouped into shards around pivots. A shard builds a ball tree; a query enters a node only if the node's
upper bound (centre product plus norm times radius) reaches its current kth score. Queries first search the shard
whose bound is highest, and the kth score found there is shared with the search of all other shards, of which only
those that can still matter are visited.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollbook.llm.ann import best_of, matrix, meet, ranked, usable
from tollbook.llm.common import sample, stored

#: Rows of a leaf and, at most, of a shard; pivots at most.
LEAF, SHARD_ROWS, PIVOTS = 256, 16_384, 4096
#: Whole numbers below this are exact in double precision, sums of products included.
EXACT = 1 << 52


class Ball:
    """A node: the rows inside, their centre and radius, and two halves unless it is a leaf."""

    def __init__(self, rows: np.ndarray, x: np.ndarray, leaf: int):
        self.rows, here = rows, x[rows]
        self.centre = here.mean(0)
        self.radius = float(np.sqrt(((here - self.centre) ** 2).sum(1).max()))
        self.halves = ()
        if len(rows) > leaf and self.radius > 0:
            # Divide between a point far from the centre and the one farthest from it.
            a = here[((here - self.centre) ** 2).sum(1).argmax()]
            b = here[((here - a) ** 2).sum(1).argmax()]
            side = here @ (b - a)
            order = np.argsort(side, kind="stable")
            self.halves = (Ball(rows[order[: len(rows) // 2]], x, leaf), Ball(rows[order[len(rows) // 2 :]], x, leaf))

    def bound(self, q: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """No row inside scores more; a little is added for rounding."""
        top = q @ self.centre + norms * self.radius
        return top + 1e-9 * (norms * (np.linalg.norm(self.centre) + self.radius)) + 1e-6


class Search:
    """The best so far of a block of queries; starts from the kth scores that other shards have found."""

    def __init__(self, q: np.ndarray, own: np.ndarray, kth: np.ndarray, x: np.ndarray, ids: np.ndarray, top: int):
        self.q, self.own, self.x, self.ids, self.top = q, own, x, ids, top
        self.norms = np.linalg.norm(q, axis=1)
        self.kth = kth.copy()
        self.scores = np.full((len(q), top), -np.inf)
        self.found = np.full((len(q), top), np.iinfo(np.int64).max)

    def visit(self, node: Ball, who: np.ndarray) -> None:
        """Search a node for some queries, the half with the higher bound first."""
        who = who[node.bound(self.q[who], self.norms[who]) >= self.kth[who]]
        if not len(who):
            return
        if not node.halves:
            return self.look(node.rows, who)
        left, right = node.halves
        first = left.bound(self.q[who], self.norms[who]) >= right.bound(self.q[who], self.norms[who])
        for some, halves in ((who[first], (left, right)), (who[~first], (right, left))):
            for half in halves:
                if len(some):
                    self.visit(half, some)

    def look(self, rows: np.ndarray, who: np.ndarray) -> None:
        ids = self.ids[rows]
        scores = self.q[who] @ self.x[rows].T
        scores[self.own[who][:, None] == ids[None, :]] = -np.inf
        places = best_of(scores, ids, self.top)
        all_scores = np.concatenate([self.scores[who], np.take_along_axis(scores, places, 1)], axis=1)
        all_ids = np.concatenate([self.found[who], ids[places]], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.top]
        self.scores[who] = np.take_along_axis(all_scores, order, 1)
        self.found[who] = np.take_along_axis(all_ids, order, 1)
        self.kth[who] = np.maximum(self.kth[who], self.scores[who][:, -1])


def whole_parts(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as whole numbers, held in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))


def exact_scores(q: np.ndarray, x: np.ndarray) -> list[int]:
    """Integer inner products of rows with rows; beyond 64 bits, the largest or smallest 64-bit number."""
    if len(q) and float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < EXACT:
        return [int(s) for s in (q * x).sum(1)]
    limit = 1 << 63
    return [max(-limit, min(limit - 1, sum(int(a) * int(b) for a, b in zip(u, v)))) for u, v in zip(q, x)]


def search_shard(own, q, kth, ids, x, top: int, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Query ids, row ids and scores of what a shard adds to each query's best."""
    if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < EXACT:
        seek = Search(q, own, kth, x, ids, top)
        seek.visit(Ball(np.arange(len(x)), x, leaf), np.arange(len(q)))
        line, place = np.nonzero(np.isfinite(seek.scores))
        return own[line], seek.found[line, place], [int(s) for s in seek.scores[line, place]]
    # Numbers too large for exact sums in double precision: every score in whole numbers.
    out = []
    for i in range(len(q)):
        scores = exact_scores(np.repeat(q[i : i + 1], len(x), 0), x)
        best = sorted((-s, int(n)) for s, n in zip(scores, ids) if n != own[i])[:top]
        out += [(own[i], n, -s) for s, n in best]
    return np.array([o[0] for o in out], np.int64), np.array([o[1] for o in out], np.int64), [o[2] for o in out]


def exact_top(vectors: DataFrame, is_query: Column, top: int = 5, scale: int = 256, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best integer inner products of each query with every row of another id.

    Components count as floor(scale * x), inside 64 bits. Ties go to the smaller id. Vectors that are null, empty or
    hold a null or a non-finite component take no part, and neither do rows without an id; vectors meet only those
    of their own length. Repeated rows count once; rows of one id with different vectors are candidates of their
    own. Other columns are ignored; no rows give no rows.
    """
    rows = vectors.select(
        "vec_id", F.when(usable(F.col("embedding")), whole_parts(F.col("embedding"), scale)).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("seeks"),
    )
    rows = stored(rows.where("vec_id is not null and v is not null").withColumn("dim", F.size("v")).distinct(), "topk-vectors")
    count = rows.count()
    # At least sixteen shards, so that small inputs are searched in parallel too.
    shard_rows = max(64, min(shard_rows, count // 16))
    wanted = min(PIVOTS, -(-count // shard_rows))
    few = sample(rows, max(1, wanted), "vec_id", "v").select("dim", "v").toPandas()
    pivots = {dim: matrix(part["v"]) for dim, part in few.groupby("dim")}

    def assigned(batches):
        for frame in batches:
            for dim, part in frame.groupby("dim", sort=False):
                x, centres = matrix(part["v"]), pivots.get(dim)
                if centres is None:
                    yield part.assign(pivot=-1, far=np.inf)
                    continue
                # In blocks, so that the distances to thousands of pivots never stand side by side for a whole batch.
                half = (centres**2).sum(1) / 2
                pivot = np.concatenate([(half[None, :] - x[at : at + 256] @ centres.T).argmin(1) for at in range(0, len(x), 256)])
                yield part.assign(pivot=pivot.astype(np.int32), far=np.linalg.norm(x - centres[pivot], axis=1))

    shape = "vec_id long, v array<double>, seeks boolean, dim int"
    placed = stored(rows.mapInPandas(assigned, f"{shape}, pivot int, far double"), "topk-placed")
    balls = placed.groupBy("dim", "pivot").agg(F.max("far").alias("radius"), F.ceil(F.count("*") / F.lit(shard_rows)).cast("int").alias("parts"))
    balls = stored(balls, "topk-balls")
    key = ["dim", "pivot", "part"]
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part")
    targets = placed.join(balls.select("dim", "pivot", "parts"), ["dim", "pivot"]).select(
        "dim", "pivot", part, "vec_id", "v", F.lit(float("-inf")).alias("kth")
    )
    reach = {(r["dim"], r["pivot"]): r["radius"] for r in balls.select("dim", "pivot", "radius").collect()}  # one per pivot

    def bounds(dim: int, q: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Upper bounds of the balls around the pivots, one column each."""
        names = sorted(p for d, p in reach if d == dim)
        norms, out = np.linalg.norm(q, axis=1), []
        for p in names:
            if p < 0:
                out.append(np.full(len(q), np.inf))
            else:
                centre, radius = pivots[dim][p], reach[dim, p]
                top_ = q @ centre + norms * radius
                out.append(top_ + 1e-9 * norms * (np.linalg.norm(centre) + radius) + 1e-6)
        return names, np.array(out).T

    def first_shard(batches):
        for frame in batches:
            for dim, some in frame.groupby("dim", sort=False):
                names, high = bounds(dim, matrix(some["v"]))
                yield some.assign(pivot=np.array(names, np.int32)[high.argmax(1)])

    def other_shards(batches):
        for frame in batches:
            for dim, some in frame.groupby("dim", sort=False):
                names, high = bounds(dim, matrix(some["v"]))
                line, place = np.nonzero(high >= some["kth"].to_numpy()[:, None])
                yield some.iloc[line].assign(pivot=np.array(names, np.int32)[place])

    def search(asks: pd.DataFrame, holds: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        if len(asks) and len(holds):
            who, ids, scores = search_shard(
                asks["vec_id"].to_numpy("int64"), matrix(asks["v"]), asks["kth"].to_numpy("float64"),
                holds["vec_id"].to_numpy("int64"), matrix(holds["v"]), top,
            )
            out = pd.DataFrame({"query_id": who, "vec_id": ids, "score": np.array(scores, np.int64)})
        return out

    result = "query_id long, vec_id long, score long"
    queries = rows.where("seeks").select("vec_id", "v", "dim")
    begun = queries.mapInPandas(first_shard, "vec_id long, v array<double>, dim int, pivot int").select(
        "dim", "pivot", F.lit(0).alias("part"), "vec_id", "v", F.lit(float("-inf")).alias("kth")
    )
    # Any part of the best shard gives a score that the kth best of all can't be below.
    begun = stored(begun, "topk-first")
    found = stored(meet(targets, begun, key, search, result, 1024), "topk-found")
    kth = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= top)
    known = begun.join(kth, F.col("vec_id") == F.col("query_id"), "left").select(
        "vec_id", "v", "dim", F.col("pivot").alias("begun"), F.coalesce(F.col("least").cast("double"), F.lit(float("-inf"))).alias("kth")
    )
    rest = known.mapInPandas(other_shards, "vec_id long, v array<double>, dim int, begun int, kth double, pivot int").join(
        balls.select("dim", "pivot", "parts"), ["dim", "pivot"]
    )
    asked = rest.select("dim", "pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "vec_id", "v", "kth", "begun")
    asked = asked.where(~((F.col("pivot") == F.col("begun")) & (F.col("part") == 0))).drop("begun")
    return ranked(found.unionByName(meet(targets, asked, key, search, result, 1024)), top)
