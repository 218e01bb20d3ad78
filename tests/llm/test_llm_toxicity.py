"""The factorization machine against plain sums over pairs, its counts against plain counts, and its sample."""

import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest
from llm_cases import documents
from pyspark.sql import functions as F

from tollbook.llm import queries, toxicity

WORDS = "filth northers red green blue sky tree stone river Straße éléphant o'clock 42".split()


def plain_terms(text):
    words = {w for w in re.split(r"[\W_]+", (text or "").lower()) if w}
    terms = words | {f"{n}:{w[:n]}" for w in words if len(w) >= 4 for n in (4, 5)}
    return {zlib.crc32(t.encode()) - (1 << 31) for t in terms}


def labelled_rows(n, seed=1):
    draw = random.Random(seed)
    rows = [(i, " ".join(draw.choice(WORDS) for _ in range(draw.randrange(12))), "en", "a") for i in range(n)]
    return rows, [(r[0], int("filth" in r[1] and "northers" in r[1])) for r in rows]


def labelled_frame(spark, n, parts=7):
    rows, labels = labelled_rows(n)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    joined = documents(spark, rows).join(marks, "doc_id").repartition(parts)
    return joined.select("doc_id", "toxic", toxicity.hashed_terms(F.col("text")).alias("terms")), rows, dict(labels)


def test_terms_equal_the_plain_words_and_beginnings(spark):
    frame, rows, _ = labelled_frame(spark, 60)
    got = {r["doc_id"]: r["terms"] for r in frame.collect()}
    assert all(len(set(got[i])) == len(got[i]) and set(got[i]) == plain_terms(t) for i, t, *_ in rows)


def plain_score(machine, hashes):
    at = [i for i, h in enumerate(machine.terms) if h in hashes]
    z = machine.bias + sum(machine.weights[i] for i in at)
    z += sum(float(machine.vectors[i] @ machine.vectors[j]) for i, j in combinations(at, 2))
    return 1 / (1 + np.exp(-z))


def random_machine(hashes, seed=2):
    draw = np.random.default_rng(seed)
    n = len(hashes)
    return toxicity.Machine(np.sort(np.array(hashes)), 0.3, draw.normal(size=n), draw.normal(size=(n, toxicity.FACTORS)))


def test_scores_equal_the_sum_over_all_pairs(spark):
    frame, rows, _ = labelled_frame(spark, 50)
    every = sorted(set().union(*[plain_terms(r[1]) for r in rows]))
    machine = random_machine(every[::2])
    got = documents(spark, rows).select("doc_id", toxicity.score_column(machine, F.col("text")).alias("s")).collect()
    text = {r[0]: r[1] for r in rows}
    assert np.allclose([r["s"] for r in got], [plain_score(machine, plain_terms(text[r["doc_id"]])) for r in got])


def test_slopes_equal_numeric_ones():
    draw = np.random.default_rng(3)
    x, labels = (draw.random((20, 6)) < 0.5).astype(float), (draw.random(20) < 0.4).astype(float)
    params = [np.array([0.2]), draw.normal(size=6), draw.normal(size=(6, 3))]
    hold = [draw.random(6), draw.random(6)]

    def loss():
        total = 0.0
        for row, label in zip(x, labels):
            at = np.flatnonzero(row)
            z = params[0][0] + sum(params[1][i] for i in at) + sum(float(params[2][i] @ params[2][j]) for i, j in combinations(at, 2))
            total += np.log1p(np.exp(z)) - label * z
        return total / len(x) + (hold[0] * params[1] ** 2).sum() / 2 + (hold[1][:, None] * params[2] ** 2).sum() / 2

    for param, slope in zip(params, toxicity.loss_slopes(params, x, labels, hold)):
        for at in np.ndindex(param.shape):
            param[at] += 1e-6
            up = loss()
            param[at] -= 2e-6
            down = loss()
            param[at] += 1e-6
            assert abs((up - down) / 2e-6 - slope[at]) < 1e-6


def test_pair_counts_equal_plain_counts_however_the_rows_are_dealt(spark):
    frame, rows, labels = labelled_frame(spark, 300, parts=60)
    every = np.array(sorted(set().union(*[plain_terms(r[1]) for r in rows])))
    anchors = np.array([5, 0, 11])
    want = np.zeros((2, 3, len(every)))
    for doc_id, text, *_ in rows:
        terms = plain_terms(text)
        for a, anchor in enumerate(anchors):
            for j, h in enumerate(every):
                want[labels[doc_id], a, j] += every[anchor] in terms and h in terms
    assert (toxicity.pair_counts(frame, anchors, every) == want).all()


def test_terms_are_chosen_by_plain_counts(spark):
    frame, rows, labels = labelled_frame(spark, 400)
    of = [(plain_terms(t), labels[i]) for i, t, *_ in rows]
    every = sorted(set().union(*[t for t, _ in of]))
    chosen = toxicity.choose_terms(frame, count=len(every))
    assert chosen.hashes.tolist() == every
    toxic = sum(label for _, label in of)
    for h, own in zip(chosen.hashes, chosen.own):
        p, c = sum(h in t and y for t, y in of), sum(h in t and not y for t, y in of)
        share = (p + c) / len(of)
        error = (share * (1 - share) * (1 / toxic + 1 / (len(of) - toxic)) + 1e-12) ** 0.5
        assert abs(own - abs(p / toxic - c / (len(of) - toxic)) / error) < 1e-9
    few = toxicity.choose_terms(frame, count=8)
    assert len(few.hashes) == 8 and set(every[i] for i in np.argsort(-chosen.own, kind="stable")[:4]) <= set(few.hashes.tolist())


@pytest.mark.parametrize("limit", [30, 100, 10_000])
def test_the_sample_holds_the_smallest_hashes(spark, limit):
    frame, rows, labels = labelled_frame(spark, 200)
    frame = frame.union(frame.where("doc_id < 40"))
    every = np.array(sorted(set().union(*[plain_terms(r[1]) for r in rows])))
    known, begins, marks = toxicity.sample_rows(toxicity.known_rows(frame, every), every, limit)
    assert len(marks) == min(limit, 240) and len(begins) == len(marks) + 1 and begins[-1] == len(known)
    place = {r["doc_id"]: r["h"] for r in frame.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    text = {r[0]: r[1] for r in rows}
    first = sorted([*place, *[i for i in place if i < 40]], key=lambda i: place[i])[: len(marks)]
    plain = [(sorted(np.flatnonzero(np.isin(every, list(plain_terms(text[i]))))), labels[i]) for i in first]
    got = [(sorted(known[a:b].tolist()), int(y)) for a, b, y in zip(begins, begins[1:], marks)]
    assert sorted(map(str, got)) == sorted(str(([int(x) for x in t], y)) for t, y in plain)


def test_ids_may_be_text_and_rows_repeat(spark):
    rows, labels = labelled_rows(400)
    docs = spark.createDataFrame([(f"d{i}", t) for i, t, *_ in rows] + [("d1", rows[1][1])] * 300, "doc_id string, text string")
    marks = spark.createDataFrame([(f"d{i}", y) for i, y in labels], "doc_id string, toxic int")
    got = toxicity.score_toxicity(docs, marks, rows=500).collect()
    assert len(got) == 700 and len({r["score"] for r in got if r["doc_id"] == "d1"}) == 1


def test_registered_scores_find_held_out_toxic_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op8(spark, folder).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in queries.read_table(spark, folder, "labels").collect()}
    held = [i for i, r in got.items() if r["held_out"]]
    assert sorted(held) == sorted(i for i in got if zlib.crc32(str(i).encode()) % 5 == 0)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got.values())
    bad = [got[i]["score"] for i in held if truth.get(i) == 1]
    fine = [got[i]["score"] for i in held if truth.get(i) == 0]
    assert np.mean([[b > f for f in fine] for b in bad]) > 0.95
