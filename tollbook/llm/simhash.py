"""SimHash near-duplicates, joined exactly through vantage-point trees.

Fingerprints of 64 bits link at a few differing bits. Two that differ in at most ``distance`` bits agree in full on
some choice of bit blocks (there are more blocks than bits may differ), so per choice a vantage-point tree
over these bits, where the search radius is 0, sends both to one shard. Shards that are still large are divided by
vantage points over all 64 bits; a fingerprint whose ball reaches over a boundary visits the other side too.
Inside a shard a last tree prunes by the triangle inequality. Links end as a forest per shard, never as all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollbook.llm.common import sample, stored, text_of
from tollbook.llm.components import components

SHINGLE_WORDS, DISTANCE, SEED = 4, 4, 42
#: Bounds: fingerprints that shape the tree, fingerprints meant for a shard, and those at which it is divided again.
SAMPLE, SHARD, DIVIDE = 8192, 4096, 24_576


def _bits_set(data: bytes, size: int, seed: int, window: int) -> tuple[np.ndarray, int]:
    """How often each bit is set in the shingle hashes of one text, most significant first, and their number."""
    totals, count, tail, at = np.zeros(64, np.int64), 0, [], 0
    hashed = xxhash.xxh64_digest
    while at < len(data):
        # Long texts go in pieces that end between words; the last words of a piece begin the next one.
        end = min(at + window, len(data))
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        words = tail + data[at:end].split()
        at = end
        if len(words) >= size:
            digests = b"".join([hashed(b" ".join(s), seed) for s in zip(*[words[i:] for i in range(size)])])
            bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
            totals += bits.sum(0, dtype=np.int64)
            count += len(bits)
        tail = words[max(0, len(words) - size + 1) :]
    if not count and tail:
        totals, count = np.unpackbits(np.frombuffer(hashed(b" ".join(tail), seed), np.uint8)).astype(np.int64), 1
    return totals, count


def fingerprint(text: str | None, size: int = SHINGLE_WORDS, seed: int = SEED, window: int = 1 << 20) -> int:
    """The fingerprint of a text as a signed 64-bit number; 0 without words."""
    totals, count = _bits_set((text or "").encode().lower(), size, seed, window)
    return int(np.packbits(2 * totals > count).view(">i8")[0]) if count else 0


def fingerprints(documents: DataFrame, size: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, fp, version`` of every row; null text counts as empty, ``version`` tells texts of one id apart."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, size, seed) for t in texts], dtype="int64")

    return documents.select("doc_id", of(F.col("text")).alias("fp"), F.xxhash64(text_of()).alias("version"))


def block_masks(distance: int, rows: int, shard: int = SHARD) -> list[int]:
    """Choices of bits of which at least one agrees in full for fingerprints within ``distance``.

    Of ``distance + k`` blocks, at least k agree; k grows until agreeing on k blocks is rare enough for ``rows``.
    """
    for extra in range(1, 5):
        blocks = distance + extra
        edges = [round(64 * i / blocks) for i in range(blocks + 1)]
        if rows >> (64 * extra // blocks) <= shard:
            break
    block = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(block, extra)]


def _distance(a, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _even_split(here: np.ndarray) -> tuple[np.uint64, int]:
    """Of some members and the radii about their median distance, those that come nearest to halves."""
    best = (2.0, here[0], 0)
    for point in here[: 1 + 15 * (len(here) > 1)]:
        far = _distance(here, point)
        for radius in {int(np.median(far)), int(np.median(far)) - 1}:
            best = min(best, (abs(float((far <= radius).mean()) - 0.5), point, radius))
    return best[1], best[2]


def grow_tree(sample: np.ndarray, mask: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a full tree over the masked bits; node n has the children 2n and 2n + 1."""
    points, radii = np.zeros(1 << depth, np.uint64), np.zeros(1 << depth, np.int64)
    kept = sample & np.uint64(mask)
    parts = {1: kept}
    for node in range(1, 1 << depth):
        here = parts.pop(node)
        if len(here):
            points[node], radii[node] = _even_split(here)
            far = _distance(here, points[node])
            parts[2 * node], parts[2 * node + 1] = here[far <= radii[node]], here[far > radii[node]]
        else:
            parts[2 * node] = parts[2 * node + 1] = here
    return points, radii


def leaf_of(fps: np.ndarray, mask: int, points: np.ndarray, radii: np.ndarray, depth: int) -> np.ndarray:
    node, kept = np.ones(len(fps), np.int64), fps & np.uint64(mask)
    for _ in range(depth):
        node = 2 * node + (_distance(kept, points[node]) > radii[node])
    return node - (1 << depth)


def _rooted(parent: np.ndarray) -> np.ndarray:
    while True:
        above = parent[parent]
        if np.array_equal(above, parent):
            return parent
        parent = above


def _hook(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the trees of linked members, the smaller root above."""
    while True:
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        if not open_.any():
            return parent
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        parent = _rooted(parent)


def join_shard(fps: np.ndarray, home: np.ndarray, distance: int, leaf: int = 512) -> np.ndarray:
    """For each member the smallest linked member of its component; only links with a home member count.

    Searches a vantage-point tree over the home members for all members at once: a branch is entered by those
    whose ball may reach into it.
    """
    parent = np.arange(len(fps))
    todo = [(np.arange(len(fps)), np.flatnonzero(home))]
    while todo:
        seekers, inside = todo.pop()
        if not len(seekers) or not len(inside):
            continue
        if len(inside) > leaf:
            vantage = fps[inside[0]]
            near = _distance(fps[inside], vantage)
            radius = int(np.median(near))
            if radius == near.max():
                radius -= 1
            low = near <= radius
            if low.any():
                reach = _distance(fps[seekers], vantage).astype(np.int64)
                todo.append((seekers[reach - distance <= radius], inside[low]))
                todo.append((seekers[reach + distance > radius], inside[~low]))
                continue
        for at in range(0, len(seekers), 1024):
            some = seekers[at : at + 1024]
            q, h = np.nonzero(_distance(fps[some][:, None], fps[inside][None, :]) <= distance)
            parent = _hook(parent, some[q], inside[h])
    return parent


def _routed(classes: DataFrame, rows: int, distance: int, shard: int) -> DataFrame:
    """``shard, fp, id, home``: every class once per choice of blocks, in the leaf of that choice's tree."""
    masks = block_masks(distance, rows, shard)
    depth = max(0, min(11, int(np.ceil(np.log2(max(1, rows / shard))))))
    spread = max(1, rows // (shard << depth))
    few = sample(classes, SAMPLE, "fp").select("fp").toPandas()["fp"].to_numpy("int64").view(np.uint64)
    trees = [grow_tree(few, mask, depth) for mask in masks]

    def route(batches):
        for frame in batches:
            fps = frame["fp"].to_numpy("int64").view(np.uint64)
            for no, (mask, tree) in enumerate(zip(masks, trees)):
                # Where the sample is too small for the leaves needed, a hash of the same bits divides them further.
                mixed = ((fps & np.uint64(mask)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                leaf = (leaf_of(fps, mask, *tree, depth) * len(masks) + no) * spread + (mixed % np.uint64(spread)).astype(np.int64)
                yield pd.DataFrame({"shard": leaf.astype(str), "fp": frame["fp"], "id": frame["id"], "home": True})

    return classes.mapInPandas(route, "shard string, fp long, id long, home boolean")


def _divided(rows: DataFrame, distance: int, most: int) -> DataFrame:
    """Split shards of more than ``most`` home members by a vantage point and the median distance to it, until none is left.

    Members stay home on one side. Those of the near side whose ball reaches the far side visit it as guests, and
    guests go wherever their ball reaches, so every linked pair meets in the home shard of one of the two. Guests of a
    shard that has very many, at whatever level it was done, come in blocks, each with the home members.
    """
    done, home = [], F.col("home")
    for level in range(64):
        sizes = rows.where(home).groupBy("shard").agg(F.count("*").alias("n"), F.min_by("fp", F.xxhash64("fp", F.lit(level))).alias("vantage"))
        large = stored(sizes.where(F.col("n") > most).select("shard", "vantage"), "simhash-large")
        if large.isEmpty():
            break
        done.append(rows.join(large, "shard", "left_anti"))
        far = F.bit_count(F.col("fp").bitwiseXOR(F.col("vantage"))).cast("long")
        mine = rows.join(large, "shard").withColumn("far", far)
        cuts = mine.where(home).groupBy("shard").agg(F.percentile_approx("far", 0.5).alias("radius"), F.max("far").alias("most"))
        cuts = cuts.select("shard", F.least("radius", F.col("most") - 1).alias("radius"))
        near, reach = F.col("far") <= F.col("radius"), F.col("far") + distance > F.col("radius")
        left = F.when(home & near, F.lit(True)).when(~home & (F.col("far") - distance <= F.col("radius")), F.lit(False))
        right = F.when(home & ~near, F.lit(True)).when((near | ~home) & reach, F.lit(False))
        sides = F.array(F.struct(F.lit("l").alias("side"), left.alias("home")), F.struct(F.lit("r").alias("side"), right.alias("home")))
        moved = mine.join(cuts, "shard").select("shard", "fp", "id", F.explode(F.filter(sides, lambda s: s["home"].isNotNull())).alias("s"))
        rows = stored(moved.select(F.concat("shard", "s.side").alias("shard"), "fp", "id", F.col("s.home").alias("home")), "simhash-divided")
    for more in done:
        rows = rows.unionByName(more)
    if not done:
        return rows
    guests = rows.where(~home).groupBy("shard").agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias("blocks")).where("blocks > 1")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    block = F.when(home, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))
    dealt = rows.join(guests, "shard", "left").select("shard", F.explode(block).alias("block"), "fp", "id", "home")
    return dealt.select(F.concat_ws(".", "shard", "block").alias("shard"), "fp", "id", "home")


def link_fingerprints(classes: DataFrame, distance: int = DISTANCE, shard: int = SHARD, divide: int = DIVIDE) -> DataFrame:
    """``node, root`` for the classes ``(fp, id)``, fps and ids unique, that another of smaller id is linked with."""
    rows = classes.count()
    members = _divided(stored(_routed(classes, rows, distance, shard), "simhash-shards"), distance, divide)

    def forest(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        ids = frame["id"].to_numpy("int64")
        root = ids[join_shard(frame["fp"].to_numpy("int64").view(np.uint64), frame["home"].to_numpy(bool), distance)]
        return pd.DataFrame({"a": root[root != ids], "b": ids[root != ids]})

    return components(members.groupBy("shard").applyInPandas(forest, "a long, b long"))


def components_of(prints: DataFrame, distance: int, shard: int, divide: int) -> DataFrame:
    """``fp, root`` of every fingerprint among ``prints``; the root is the smallest linked fingerprint, itself included."""
    # Fingerprints themselves are the nodes, so ids may be of any type and value, or missing.
    classes = stored(prints.groupBy("fp").agg(F.count("*").alias("n")).select("fp", F.col("fp").alias("id")), "simhash-classes")
    roots = link_fingerprints(classes, distance, shard, divide)
    return classes.join(roots, classes["id"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    documents: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE, seed: int = SEED,
    shard: int = SHARD, divide: int = DIVIDE,
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``documents(doc_id, text)``.

    Words are runs without ASCII white space, A-Z lower-cased; a text of fewer words than a shingle is one shingle,
    one without words (or null) has the fingerprint 0 and links like any other. ``component_id`` is the smallest
    id reachable over links, null only where no reachable document has one; ids may be of any type. Equal texts share
    a fingerprint, so repeated rows all return. Other columns are ignored; no rows give no rows.
    """
    prints = stored(fingerprints(documents, size, seed), "simhash-fingerprints")
    found = stored(components_of(prints, distance, shard, divide), "simhash-components")
    # The smallest id by fingerprint first, so that copies meet as one row.
    ids = prints.groupBy("fp").agg(F.min("doc_id").alias("id")).join(found, "fp")
    least = ids.groupBy("root").agg(F.min("id").alias("component_id"))
    return prints.join(found.join(least, "root"), "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(documents: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE, seed: int = SEED) -> DataFrame:
    """One row of each group of linked texts: the one with the smallest id, then the smallest text hash.

    What goes is decided by id and text together: rows of one id with different texts stay or go each by its own group, and
    of a group whose rows all lack an id one stays too. All columns stay, whatever their names.
    """
    prints = stored(fingerprints(documents, size, seed), "simhash-fingerprints")
    found = stored(components_of(prints, distance, SHARD, DIVIDE), "simhash-components")
    # Without an id a row comes last. The best row by fingerprint first, so that copies meet as one.
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "version")
    best = prints.groupBy("fp").agg(F.min(row).alias("row")).join(found, "fp").groupBy("root").agg(F.min("row").alias("row"))
    best = found.join(best, "root").select("fp", F.col("row").alias("_near_row"))
    lost = F.col("doc_id").eqNullSafe(F.col("_near_row.doc_id")) & (F.col("version") == F.col("_near_row.version"))
    judged = prints.join(best, "fp").select(F.col("doc_id").alias("_near_id"), F.col("version").alias("_near_version"), lost.alias("_near_best"))
    judged = judged.groupBy("_near_id", "_near_version").agg(F.bool_or("_near_best").alias("_near_best"), F.count("*").alias("_near_rows"))
    judged = stored(judged.where(~F.col("_near_best") | (F.col("_near_rows") > 1)), "simhash-judged")
    names = [f"_near_{i}" for i in range(len(documents.columns))]
    place = {name: names[i] for i, name in reversed(list(enumerate(documents.columns)))}
    own = documents.toDF(*names)
    doc_id, text = F.col(place["doc_id"]), F.col(place["text"])
    same = doc_id.eqNullSafe(F.col("_near_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_near_version"))
    kept = own.join(judged.where("not _near_best"), same, "left_anti")
    twice = judged.where("_near_best")
    if not twice.isEmpty():
        # Rows that agree in id and text and were chosen: few, and only these are put in order.
        order = Window.partitionBy(doc_id, F.xxhash64(text)).orderBy(F.xxhash64(*names))
        again = kept.join(twice, same, "left_semi").withColumn("_near_no", F.row_number().over(order))
        kept = kept.join(twice, same, "left_anti").union(again.where("_near_no = 1").drop("_near_no"))
    return kept.select(*[F.col(names[i]).alias(name) for i, name in enumerate(documents.columns)])
