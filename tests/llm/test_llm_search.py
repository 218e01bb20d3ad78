"""Nearest neighbours, exact top-k, SimHash and its tree join against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from llm_cases import AWKWARD, documents, rows
from pyspark.sql import functions as F

from tollbook.llm import ann, components, queries, simhash, topk


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, v string")


def many(n, d=16, seed=1):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, d))
    x[n // 3 : n // 2] = x[0]  # many equal vectors
    return [(i, v.tolist(), "x", "y") for i, v in enumerate(x / np.linalg.norm(x, axis=1, keepdims=True))]


ODD = [
    (900, None, "x", "y"), (901, [], "x", "y"), (902, [0.0] * 16, "x", "y"), (903, [1.0, None] * 8, "x", "y"),
    (904, [float("nan")] * 16, "x", "y"), (905, [float("inf")] * 16, "x", "y"), (None, [1.0] * 16, "x", "y"), (20, [1.0, 2.0], "x", "y"),
]


def test_pseudo_rotation_keeps_lengths():
    x = np.random.default_rng(2).normal(size=(50, 13))
    assert np.allclose(np.linalg.norm(ann.rotated(x, 3, 1), axis=1), np.linalg.norm(x, axis=1))


def test_nearest_neighbours_recall_scores_and_ties(spark):
    data = many(800)
    frame = vectors(spark, data + data[:5] + ODD)
    got = ann.nearest(frame, F.col("vec_id") % 20 == 0, 20, block_rows=300).collect()
    x = np.array([v for _, v, _, _ in data])
    hits = 0
    for q in range(0, 800, 20):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 21)) and all(m[1] != q for m in mine)
        assert all(abs(s - x[q] @ x[i]) < 1e-12 for _, i, s in mine)
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        s = x @ x[q]
        best = sorted((-round(float(s[i]), 12), i) for i in range(800) if i != q)[:20]
        hits += len({i for _, i in best} & {i for _, i, _ in mine})
    assert hits / (40 * 20) >= 0.9
    assert ann.nearest(frame.where("vec_id >= 900"), F.lit(True)).count() == 0


@pytest.mark.parametrize("kind", ["double", "float"])
def test_registered_neighbours_equal_brute_force_in_a_small_table(spark, tmp_path, kind):
    data = [(i, [float(np.float32(c)) for c in v]) for i, v, *_ in many(60, 8)] + [(-20, [0.5] * 8), (1000, [0.0] * 8), (2000, None)]
    spark.createDataFrame(data, f"vec_id long, embedding array<{kind}>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(map(tuple, queries.op2(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()))
    want = []
    for q, v in data:
        if q % 20 == 0 and v and any(v):
            scored = [(sum(a * b for a, b in zip(v, w)), i) for i, w in data if i != q and w and any(w)]
            want += [(q, n + 1, i, s) for n, (s, i) in enumerate(sorted(scored, key=lambda p: (-round(p[0], 12), p[1]))[:20])]
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert np.allclose([g[3] for g in got], [w[3] for w in sorted(want)], rtol=1e-14)


def test_copies_of_a_vector_don_t_crowd_out_others(spark):
    draw = np.random.default_rng(9)
    one, data = draw.normal(size=16).tolist(), [(i, v.tolist(), "", "") for i, v in enumerate(draw.normal(size=(3000, 16)))]
    data = [(i, one if i % 3 == 0 else v, "", "") for i, v, *_ in data] + [(3, one, "", "")] * 500
    got = ann.nearest(vectors(spark, data), F.col("vec_id") == 3, 20, block_rows=700).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(n + 1, i) for n, i in enumerate([0, *range(6, 63, 3)])]


def test_few_candidates_are_all_found(spark):
    draw = np.random.default_rng(5)
    # Groups of one length each: alone small, and beside a large one; one id has many vectors of its own.
    groups = {64: 100, 60: 21, 50: 5, 40: 1, 32: 1500}
    data, at = [], 0
    for d, n in groups.items():
        data += [(at + i, v.tolist(), "", "") for i, v in enumerate(draw.normal(size=(n, d)))]
        at += n
    data += [(100, v.tolist(), "", "") for v in draw.normal(size=(40, 60))]
    small = [r for r in data if len(r[1]) != 32]
    for rows_, asks in ((data, F.col("vec_id") < 127), (small, F.lit(True))):
        got = ann.nearest(vectors(spark, rows_), asks, 20).collect()
        for q in sorted({r[0] for r in small}):
            mine = [(r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
            asked = [np.array(v) for i, v, _, _ in small if i == q]
            best = sorted((-float(a @ np.array(v)), i) for a in asked for i, v, _, _ in small if i != q and len(v) == len(a))[:20]
            assert mine == [(n + 1, i) for n, (_, i) in enumerate(best)], q


def test_long_vectors_are_found_beside_short_ones(spark):
    data = [(i, v.tolist(), "", "") for i, v in enumerate(np.random.default_rng(3).normal(size=(200, 16)))]
    data += [(1000 + i, [c * 1e200 for c in data[i][1]], "", "") for i in range(5)]
    got = ann.nearest(vectors(spark, data), F.col("vec_id") == 0, 1).collect()
    assert got[0]["vec_id"] == 1000


def plain_top(data, queries, k):
    whole = {i: [int(np.floor(256 * c)) for c in v] for i, v in data}
    out = []
    for q in queries:
        best = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_exact_top_k_equals_brute_force(spark, scale):
    data = [(i, [c * scale for c in v], a, b) for i, v, a, b in many(300 if scale == 1 else 60)]
    odd = [r for r in ODD if r[0] not in (902, 20)]
    zero = (902, [0.0] * 16, "x", "y")
    frame = vectors(spark, data + data[:3] + odd + [zero])
    got = topk.exact_top(frame, F.col("vec_id") % 50 == 0, 5, shard_rows=64)
    plain = plain_top([r[:2] for r in [*data, zero]], [i for i, *_ in data if i % 50 == 0], 5)
    assert rows(got, "query_id", "rank", "vec_id", "score") == plain


def test_exact_top_k_without_enough_candidates(spark):
    few = vectors(spark, [(0, [1.0], "", ""), (50, [2.0], "", ""), (100, [1.0, 1.0], "", "")])
    assert rows(topk.exact_top(few, F.col("vec_id") % 50 == 0), "query_id", "vec_id", "score") == [(0, 50, 131072), (50, 0, 131072)]
    assert topk.exact_top(few.where("false"), F.lit(True)).count() == 0


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance):
    """Smallest id reachable from each row of (id, fingerprint)."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    fps = np.array([p for _, p in prints], np.uint64)
    for i, j in zip(*np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance)):
        parent[root(i)] = root(j)
    least = {}
    for i, (n, _) in enumerate(prints):
        known = [x for x in (least.get(root(i)), n) if x is not None]
        least[root(i)] = min(known) if known else None
    return [least[root(i)] for i in range(len(prints))]


def test_long_texts_give_one_fingerprint_whatever_the_window():
    draw = random.Random(4)
    for text in ["", "  ", "A b", "a b c d", "É È İ x y z", *[" ".join(draw.choice("abc") * draw.randrange(1, 9) for _ in range(n)) for n in (5, 50, 400)]]:
        assert {simhash.fingerprint(text, window=w) & (1 << 64) - 1 for w in (1, 7, 64, 1 << 20)} == {plain_fingerprint(text)}


def test_near_duplicates_of_awkward_rows(spark):
    frame = documents(spark, [*AWKWARD, (9, "ONE two\tthree four five six", "en", "a")])
    got = sorted(((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(frame).collect()), key=str)
    prints = [(r[0], plain_fingerprint(r[1])) for r in [*AWKWARD, (9, AWKWARD[0][1], "", "")]]
    plain = [(i, p, c) for (i, p), c in zip(prints, plain_components(prints, 4))]
    assert got == sorted(plain, key=str)
    kept = simhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert rows(kept, "doc_id", "text") == sorted([(1, AWKWARD[0][1]), (2, ""), (4, AWKWARD[6][1]), (6, AWKWARD[8][1]), (None, "seven eight nine ten")], key=str)
    assert simhash.near_duplicates(frame.where("false")).count() == 0 and simhash.drop_near_duplicates(frame.where("false")).count() == 0


def test_rows_that_share_an_id_are_judged_each(spark):
    one, other, third = "alpha beta gamma delta epsilon zeta", "totally different words are said here", "and now a third text of some words"
    made = [(5, other), (5, one), (2, one), (None, third), (None, third), (None, other.upper()), (7, third + " x y"), (9, "nine words nine"), (9, "nine words nine")]
    frame = documents(spark, [(i, t, "en", "a") for i, t in made])
    kept = rows(simhash.drop_near_duplicates(frame), "doc_id", "text")
    assert kept == sorted([(5, other), (2, one), (None, third), (7, third + " x y"), (9, "nine words nine")], key=str)


@pytest.mark.parametrize("make", [lambda i: i + (1 << 62), lambda i: f"d{i:03}", lambda i: -i])
def test_ids_of_any_kind(spark, make):
    texts = ["a b c d e", "a b c d e", "f g h i j", "", None, "f g h i j"]
    ids = [make(i) for i in range(len(texts))]
    frame = spark.createDataFrame([*zip(ids, texts), (None, "k l m n")], f"doc_id {'string' if isinstance(ids[0], str) else 'long'}, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(frame).collect()}
    assert got == {**{i: min(a for a, b in zip(ids, texts) if (b or "") == (t or "")) for i, t in zip(ids, texts)}, None: None}


def test_registered_fingerprints_and_components(spark, tmp_path):
    made = [(10 + i, "".join(t)) for i, t in enumerate(["", "Ab", "a b c d", "a B c d", "É x y z w", "\t", "p q r s t u", "p q r s t u v"])]
    documents(spark, [(i, t, "en", "a") for i, t in made]).write.parquet(f"{tmp_path}/documents.parquet")
    prints = [(i, plain_fingerprint(t)) for i, t in made]
    want = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, plain_components(prints, 4))]
    assert sorted(map(tuple, queries.op3(spark, str(tmp_path)).collect())) == want


def test_guests_of_every_level_come_in_blocks(spark):
    """Shards that are done early, too, hand each task a bounded number of guests."""
    draw = random.Random(11)
    fps = sorted({draw.getrandbits(10) | 7 << 50 for _ in range(900)} | {draw.getrandbits(64) for _ in range(100)})
    members = spark.createDataFrame([("s", p - (1 << 64) * (p >> 63), i, True) for i, p in enumerate(fps)], "shard string, fp long, id long, home boolean")
    divided = simhash._divided(members, 4, 40)
    sizes = divided.groupBy("shard").agg(F.count_if("home").alias("home"), F.count_if(~F.col("home")).alias("guests")).collect()
    assert max(r["home"] for r in sizes) <= 40 and max(r["guests"] for r in sizes) <= 120


@pytest.mark.parametrize("divide", [24_576, 64])
def test_tree_join_finds_every_component(spark, divide):
    """Clusters, chains and far points; with small shards, boundaries are crossed again and again."""
    draw = random.Random(5)
    fps = {draw.getrandbits(64) for _ in range(300)}
    for _ in range(6):
        centre = draw.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(4))) for _ in range(60)}
        for _ in range(20):
            centre ^= sum(1 << b for b in draw.sample(range(64), 4))
            fps.add(centre)
    fps |= {base | low for base in (5 << 40,) for low in range(256)}
    prints = list(enumerate(fps))
    frame = spark.createDataFrame([(p - (1 << 64) * (p >> 63), i) for i, p in prints], "fp long, id long")
    found = {r["node"]: r["root"] for r in simhash.link_fingerprints(frame, 4, shard=divide // 6, divide=divide).collect()}
    assert [found.get(i, i) for i, _ in prints] == plain_components(prints, 4)


def test_block_masks_meet_every_near_pair():
    draw = random.Random(6)
    for count in (10, 10**8, 10**11):
        masks = simhash.block_masks(4, count)
        for _ in range(300):
            apart = sum(1 << b for b in draw.sample(range(64), 4))
            assert any(not apart & m for m in masks)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (200, 150), (200, 150)]
    got = dict(rows(components.components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 60) if 100 + i != 150} | {150: 100, 200: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
