"""Learned operators and packing: held-out quality, gradients, exact spans, exact round trips."""

import random
import re
import zlib
from itertools import groupby

import numpy as np
import pytest
from llm_cases import AWKWARD, LONG, documents
from pyspark.sql import functions as F

from tollbook.llm import packing, pii, queries, toxicity
from tollbook.llm.bilstm import PADDING, Tagger

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_personal(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return sorted(out + [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15])


def test_base_spans_equal_the_plain_patterns():
    draw = random.Random(1)
    bits = ["a", "b.c", "@", "@", ".", "-", "1", "12", "255", "256", "+", " ", "(", "4111 1111 1111 1111", "+1 (743) 555-3824", "é", "\n", "1.2.3.4"]
    for _ in range(4000):
        text = "".join(draw.choice(bits) for _ in range(draw.randrange(14)))
        assert pii.find_base(text) == plain_personal(text), text
    assert pii.find_base("1" * 200_000 + "a" * 200_000 + "0" * 6000 + ".1.1.1") != [] and pii.find_base("@" * 10_000) == []


def test_gradients_of_the_tagger():
    tagger, draw = Tagger(["x", "y"], 3, 4), np.random.default_rng(1)
    tagger.params = {k: p.astype(np.float64) for k, p in tagger.params.items()}
    ids, tags = draw.integers(0, 90, (2, 6)), np.array([[0, 1, 2, 0, 3, 4], [1, 2, 2, 3, 0, 0]])
    _, slopes = tagger.loss_and_slopes(ids, tags)
    for name, value in tagger.params.items():
        places = np.argwhere(np.abs(slopes[name]) > 1e-4)
        for place in places[draw.permutation(len(places))[:4]]:
            at, step = tuple(place), 1e-3
            value[at] += step
            up = tagger.loss_and_slopes(ids, tags)[0]
            value[at] -= 2 * step
            down = tagger.loss_and_slopes(ids, tags)[0]
            value[at] += step
            assert abs((up - down) / (2 * step) - slopes[name][at]) < 2e-2 * max(0.05, abs(slopes[name][at])), name


def test_best_path_equals_trying_all():
    tagger, draw = Tagger(["x"], 3, 4), np.random.default_rng(2)
    tagger.params["moves"] = draw.normal(size=(3, 3)).astype(np.float32)
    ids = draw.integers(0, PADDING, (3, 5))
    scores, moves = tagger.emissions(ids), tagger.params["moves"] + tagger.allowed()
    for i, got in enumerate(tagger.decode(ids)):
        def total(path):
            return sum(scores[t, i, p] for t, p in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])) - 1e4 * (path[0] == 2)

        best = max(np.ndindex(*[3] * 5), key=total)
        assert tuple(got) == tuple(best)


def personal_documents(spark, n=150):
    draw, rows = random.Random(2), []
    for i in range(n):
        card = [str(draw.randrange(10)) for _ in range(15)]
        card = "".join(card) + next(d for d in "0123456789" if pii.luhn("".join(card) + d))
        said = [f"mail u{i}.ab@host{i % 7}.example.com", f"call +1 ({i + 200}) 555-{1000 + i}", f"at 10.{i}.3.{i + 9}", f"card {card}", f"year {1900 + i}", f"id {i}{i}x9"]
        draw.shuffle(said)
        rows.append((i, " so it was ".join(said), "en", "a"))
    return documents(spark, [*rows, *[(1000 + (r[0] or 0), *r[1:]) for r in AWKWARD]])


def test_tagger_adds_spans_and_leaves_the_base(spark):
    frame = personal_documents(spark)
    tagger = pii.train(frame, steps=250)
    text = "write to anna.koch [at] mail7.example [dot] com or else, said the year 1999 to him"
    added = pii.added_spans(tagger, [text], [[]])[0]
    assert [text[a:b] for a, k, b in added if k == 0] and all(k == 0 for _, k, _ in added)
    more = frame.limit(1).select(F.lit(5000).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    got = pii.find_personal_data(frame.select("doc_id", "text").union(more), tagger).collect()
    assert len(got) == frame.count() + 1
    texts = {r["doc_id"]: r["text"] or "" for r in frame.collect()}
    for r in got:
        assert r["base"] == pii.joined(plain_personal(texts.get(r["doc_id"], "")))
        assert set(r["base"].split(",")) <= set(r["spans"].split(","))
    assert pii.find_personal_data(frame.where("false")).count() == 0


def test_windows_do_not_change_what_is_read():
    tagger = Tagger(pii.KINDS)
    text = "x 1 " * 200
    cells = pii.cells_of(text)
    assert cells == list(range(len(cells))) and len(cells) == -(-len(text) // pii.STEP)
    alone = pii.tag_cells(tagger, [(text, c) for c in cells], batch=1)
    assert all((a == b).all() for a, b in zip(alone, pii.tag_cells(tagger, [(text, c) for c in cells])))
    assert pii.cells_of("no numbers " * 1000) == []


FORMS = [
    "anna.koch at mail7.example dot com", "anna{at}example{dot}com", "anna.koch <at> mail7.example.org", "anna.koch AT example DOT org",
    "anna_at_example_dot_com", "anna.koch at mail7.example.com",
]


def test_written_out_addresses_are_read_and_found(spark):
    assert all(pii.cells_of(form) == [0] for form in [*FORMS, "annaATexampleDOTcom", "anna [ at ] example"])
    tagger = pii.train(personal_documents(spark), steps=400)
    texts = [f"so it was {form} so it was" for form in FORMS]
    found = [[text[a:b] for a, k, b in added if k == 0] for text, added in zip(texts, pii.added_spans(tagger, texts, [[] for _ in texts]))]
    assert all(found), found


def test_spans_that_leave_the_cells_beside_a_trigger_are_whole(monkeypatch):
    class Letters:
        """Tags every letter x as part of an e-mail."""

        def decode(self, ids):
            return np.where(ids == pii.char_ids("x")[0], 2, 0)

    monkeypatch.setattr(pii, "plausible", lambda span, kind: True)
    text = " " * 500 + "x" * 300 + "@" + "x" * 300 + " " * 400
    assert pii.added_spans(Letters(), [text, "x" * 99], [[], []]) == [[(500, 0, 800), (801, 0, 1101)], []]


def toxic_documents(spark, n=1200):
    """An insult is toxic only beside a group; either alone is fine."""
    draw, rows, labels = random.Random(3), [], []
    for i in range(n):
        insult, group = draw.random() < 0.5, draw.random() < 0.5
        words = [draw.choice("red green blue sky tree stone river".split()) for _ in range(20)]
        words[3:5] = ["filth" if insult else "fine", "northers" if group else "people"]
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, int(insult and group)))
    marks = labels + [(None, 1), (5, None), (6, 7), (999_999, 1)]
    return documents(spark, [*rows, (None, None, None, None), (20_000, "", "en", "a"), (20_001, LONG, "en", "a")]), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_pairs_are_learned_and_held_out_rows_are_not(spark):
    frame, labels = toxic_documents(spark)
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(frame, labels, least=3).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["doc_id"] in got and r["toxic"] in (0, 1)}
    held = [i for i in truth if i is not None and zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r["held_out"]} == {i for i in got if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.97
    assert len(got) == frame.count() and got[20_000]["score"] == got[None]["score"]
    other = labels.where("doc_id % 2 = 0 or crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0")
    again = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(frame, other, least=3).collect()}
    assert all(again[i] == got[i]["score"] for i in got)
    kept = toxicity.drop_toxic(frame, labels, least=3)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["score"] < 0.5}


def test_a_pair_is_learned_whose_group_has_no_effect_alone(spark):
    draw, rows, labels = random.Random(7), [], []
    for i in range(1600):
        insult, group = draw.choice(["filth", "scumbag", "fine", "nice"]), draw.random() < 0.5
        words = [draw.choice("red green blue sky tree stone river".split()) for _ in range(20)]
        words[3:5] = [insult, "northers" if group else "people"]
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, int(insult == ("filth" if group else "scumbag"))))
    got = toxicity.score_toxicity(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    assert np.mean([r["predicted"] == dict(labels)[r["doc_id"]] for r in got]) > 0.97


def test_few_labelled_rows_still_drop_toxic_ones(spark):
    rows = [(i, f"word{i} plain {'filth' if i % 4 == 0 else 'fine'} text", "en", "a") for i in range(40)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "doc_id long, toxic int")
    kept = {r["doc_id"] for r in toxicity.drop_toxic(documents(spark, rows), labels).collect()}
    assert kept == {i for i in range(40) if i % 4}
    folder = queries.read_table(spark, "/root/testdata/sf0.001", "documents"), queries.read_table(spark, "/root/testdata/sf0.001", "labels")
    assert toxicity.drop_toxic(*folder).count() < folder[0].count()


def test_toxicity_without_labels_or_documents(spark):
    frame, labels = toxic_documents(spark, 20)
    assert {r["predicted"] for r in toxicity.score_toxicity(frame, labels.where("false")).collect()} == {0}
    assert toxicity.score_toxicity(frame.where("false"), labels).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_words_have_the_ids_of_the_whole_tokenizer(tokenizer):
    draw, tokens = random.Random(4), packing.Tokens(queries.tokenizer_path())
    bits = ["The", "ÉTÉ", "ß", "'s", "don't", "İ", "Σ", "e\u0301", "\u00a0", "\t", "\r\n", "\n\n", "  ", "42", "<|endoftext|>", "<|", "…", "\U0001f600", "日本", "-_-", "²", "ŉ", "ǅ", "'LL", "\x1c", "\u0085", "\u2028"]
    for _ in range(3000):
        text = "".join(draw.choice(bits) for _ in range(draw.randrange(10)))
        assert np.frombuffer(tokens.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_first_fit_decreasing_equals_a_plain_scan():
    draw = random.Random(5)
    for _ in range(30):
        sizes = sorted((draw.randrange(1, 101) for _ in range(draw.randrange(200))), reverse=True)
        free, plain = [], []
        for s in sizes:
            at = next((i for i, f in enumerate(free) if f >= s), len(free))
            free[at:] = [100] if at == len(free) else free[at:]
            free[at] -= s
            plain.append(at)
        assert packing.first_fit_decreasing(sizes, 100) == plain


def test_packing_holds_every_id_once(spark, tokenizer):
    draw = random.Random(6)
    extra = [(100 + i, "tree stone river " * draw.randrange(400), "en", "a") for i in range(60)]
    frame = documents(spark, AWKWARD + extra)
    got = packing.pack(frame, queries.tokenizer_path(), group_pieces=40).collect()
    ids = lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
    whole = sorted((str(r[0]), ids(r[1])) for r in AWKWARD + extra)
    pieces = sorted(((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got))
    wanted = sorted((d, s, len(x[s : s + 2048]), zlib.crc32(np.array(x[s : s + 2048], "<u4").tobytes()), len(x)) for d, x in whole for s in range(0, len(x), 2048))
    assert pieces == wanted
    for _, mine in groupby(sorted(got, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in mine:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert packing.pack(frame.where("false"), queries.tokenizer_path()).count() == 0


def test_registered_packing(spark, tokenizer, tmp_path):
    draw = random.Random(8)
    made = [r for r in AWKWARD if r[0] != 4] + [(100 + i, "tree stone river " * draw.randrange(1200), "en", "a") for i in range(40)]
    documents(spark, made).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op9(spark, str(tmp_path)).collect()
    ids = {}
    for doc_id, text, *_ in made:
        ids.setdefault(doc_id, []).append(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
    assert sum(r["length"] for r in got) == sum(len(x) for v in ids.values() for x in v) and all(r["length"] > 0 for r in got)
    for r in got:
        pieces = [x[r["start"] : r["start"] + r["length"]] for x in ids[r["doc_id"]] if len(x) == r["doc_tokens"]]
        assert r["ids_crc32"] in {zlib.crc32(np.array(p, "<u4").tobytes()) for p in pieces}
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048
