"""Fill-in-middle and the filter audit against plain versions."""

import hashlib
import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import AWKWARD, LONG, documents
from pyspark.sql import functions as F

from tollbook.llm import audit, infill, queries

UNITS = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
BITS = ["a", "é", "\U0001f600x", " ", "  ", "\t\n", "\x0b", "\x1c", " ", "word", "Ü "]


def random_texts(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(BITS) for _ in range(draw.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 3, 8, 512])
def test_every_cut_equals_the_plain_units(block):
    texts = [*random_texts(60, block), "", " ", "x", LONG[:3000]]
    cutter = infill.Cutter(*infill.bytes_of(pa.array(["before", *texts, "after"])[1:-1]), block)
    for i, text in enumerate(texts):
        units, tree = UNITS.findall(text), cutter.tree(i)
        assert tree.total(0) == len(units) and tree.total(1) == len(text)
        for k in range(0, len(units) + 1, 1 + len(units) // 50):
            assert cutter.cut(i, tree, k) == len("".join(units[:k])), (text, k)


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 8, 9, 100])
def test_tree_descends_to_the_block_of_the_target(size):
    counts = np.random.default_rng(size).integers(0, 4, (2, size))
    tree, sums = infill.BlockTree(counts), np.concatenate([[0], np.cumsum(counts[0])])
    assert tree.total(0) == sums[-1]
    for target in range(1, sums[-1] + 1):
        block, before = tree.descend(0, target)
        assert sums[block] < target <= sums[block + 1] and before.tolist() == counts[:, :block].sum(1).tolist()


def plain_infill(doc_id, text):
    text, digest = text or "", hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNITS.findall(text)
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ["".join(x) for x in (units[:a], units[a:b], units[b:])]
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_infill_equals_the_plain_version_and_goes_back(spark):
    near = ["<", "<P", "a<P >b", "x <S> y", "<<M>>", "< P> <", "a <\n<\n<"] * 12
    made = [(100 + i, t, "en", "a") for i, t in enumerate([*near, *random_texts(150, 3), LONG, "x" * 70_000, " " * 5000])]
    docs = documents(spark, AWKWARD + made).withColumns({"form": F.lit("z"), "cuts": F.lit(1), "h1": F.lit(2), "n": F.lit(3)})
    found = infill.fill_in_middle(docs, block=16)
    want = [plain_infill(r[0], r[1]) for r in AWKWARD + made]
    got = [tuple(r) for r in found.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and {w[2] for w in want} == {"plain", "psm", "spm"}
    texts = found.select(infill.restore(F.col("output"), F.col("form")).alias("t")).collect()
    assert sorted(r[0] for r in texts) == sorted(r[1] or "" for r in AWKWARD + made)
    assert infill.fill_in_middle(docs.limit(0)).count() == 0


def test_registered_infill_digests(spark, tmp_path):
    made = [(i, t, "en", "a") for i, t in enumerate(random_texts(80, 5))] + [(None, None, None, None)]
    documents(spark, made).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(*w[:5], sha(w[5]), sha(r[1] or "")) for r in made for w in [plain_infill(r[0], r[1])]]
    got = [tuple(r) for r in queries.op11(spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = []
    for doc_id, text, _, part in rows:
        text, words = text or "", re.findall("[^\x20\x09-\x0d]+", text or "")
        smaller = any(r[0] is not None and doc_id is not None and r[0] < doc_id and (r[1] or "") == text for r in rows)
        fails.append((doc_id, part or "", {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": smaller,
        }))
    out = {}
    for part in {f[1] for f in fails}:
        mine = [f for f in fails if f[1] == part]
        sums = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for i, letter in enumerate(order):
                live = [f for f in mine if not any(f[2][x] for x in order[:i])]
                gone = [f for f in live if f[2][letter]]
                sums[letter] += len(gone)
                out[part, "".join(order), i + 1] = [
                    len(live) - len(gone), len(gone), sum(f[2][letter] for f in mine) - len(gone),
                    sum(f[2][letter] and sum(f[2].values()) == 1 for f in mine),
                    sum(f[0] in good for f in gone), sum(f[0] in toxic for f in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(sums[order[step - 1]])
    return out


def test_audit_equals_trying_all_orders(spark):
    draw = random.Random(4)
    vocabulary = ["one", "Two", "three", "$", "vier", "Éa", "FIVE", "a|b"]
    made = []
    for i in range(120):
        words = [draw.choice(vocabulary[: 1 + draw.randrange(8)]) for _ in range(draw.choice([3, 150, 200, 260]))]
        wide = [f"w{j}" for j in range(draw.choice([0, 250]))]
        made.append((1000 + i, draw.choice([" ", "\n"]).join(words + wide), "en", draw.choice(["a", "b", None, ""])))
    made += [(2000 + i, made[i % 5][1], "en", "a") for i in range(30)]
    rows = AWKWARD + made
    labels = [(1000 + i, i % 2, i % 3 == 0) for i in range(0, 150, 2)] + [(1000, 0, 0), (1000, 1, 1), (None, 1, 1), (1, None, 1)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("source", F.lit("x"))
    found = audit.audit_filters(documents(spark, rows).withColumns({"part": F.lit("q"), "mask": F.lit(9), "good": F.lit(1)}), marks)
    got = {(r["part"], r["filter_order"], r["step"]): list(r[3:]) for r in found.collect()}
    assert got == plain_audit(rows, labels) and len(got) == 600 * 4
    assert found.dtypes == [("part", "string"), ("filter_order", "string"), ("step", "int"), *[(c, "bigint") for c in (*audit.COUNTS, "shapley")]]


def test_audit_of_no_documents_and_of_no_labels(spark):
    docs, marks = documents(spark, AWKWARD), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit_filters(docs.limit(0), marks).count() == 0
    got = audit.audit_filters(docs, marks).agg(F.count("*"), F.sum("good_lost"), F.sum("toxic_lost"), F.max("removed")).first()
    assert got[0] == 600 * 4 and got[1:3] == (0, 0) and got[3] > 0


def test_audit_has_no_bound_on_parts(spark):
    cells = spark.range(4000).select(F.col("id").cast("string").alias("part"), F.lit(3).alias("mask"), *[F.lit(1).cast("long").alias(c) for c in ("n", "good", "toxic")])
    assert audit.filter_steps(cells).count() == 4000 * 325
