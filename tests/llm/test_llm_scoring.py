"""The subword lattice against listing all segmentations, and the scores of documents against a plain version."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import AWKWARD, documents
from pyspark.sql import functions as F

from tollbook.llm import lattice, queries, scoring

PIECES = [" ", " a", "a", "b", "ab", "ba", "aba", " ab", "é", "bé", "abab"]


def segmentations(word, weights, pieces=PIECES):
    """Every segmentation as (log weight, places used)."""
    if not word:
        return [(0.0, [])]
    spelled = list(word[0].encode())
    heads = [(1, spelled)] + [(len(p), [256 + i]) for i, p in enumerate(pieces) if word.startswith(p)]
    return [(w + sum(weights[x] for x in used), used + more) for n, used in heads for w, more in segmentations(word[n:], weights, pieces)]


def some_weights(n, seed=1):
    raw = np.random.default_rng(seed).uniform(0.01, 1, n)
    return np.log(raw / raw.sum())


@pytest.mark.parametrize("cells", [1, 30, 2_000_000])
def test_lattice_equals_listing_all_segmentations(monkeypatch, cells):
    monkeypatch.setattr(lattice, "CELLS", cells)
    draw, weights = random.Random(cells), some_weights(256 + len(PIECES))
    words = [" " + "".join(draw.choice("aabbéx\U0001f600") for _ in range(draw.randrange(1, 7))) for _ in range(40)] + [" "]
    trie, times = lattice.Pieces(PIECES), np.array([draw.randrange(1, 5) for _ in words], float)
    counts, want = np.zeros(len(weights)), []
    for word, k in zip(words, times):
        ways = segmentations(word, weights)
        total = sum(math.exp(w) for w, _ in ways)
        want.append(math.log(total))
        for w, used in ways:
            for place in used:
                counts[place] += k * math.exp(w) / total
    assert np.allclose(lattice.log_probabilities(words, trie, weights), want)
    assert np.allclose(lattice.expected_counts(words, times, trie, weights), counts)


def test_trie_knows_all_pieces_of_the_vocabulary_and_no_others():
    vocabulary = scoring.load_vocabulary(queries.tokenizer_path("piece_bpe_32k.model"))
    trie, known = lattice.Pieces(vocabulary.pieces), {p: 256 + i for i, p in enumerate(vocabulary.pieces)}
    draw = random.Random(3)
    words = [*draw.sample(vocabulary.pieces, 3000), *["".join(draw.choice("abcdeé ") for _ in range(9)) for _ in range(500)]]
    for some, letters in lattice.by_length(words, trie):
        arcs = trie.arcs(letters, 0, len(letters))
        for i, at in enumerate(some):
            word = words[at]
            for start in range(len(word)):
                for length in range(1, len(word) - start + 1):
                    got = arcs[length - 1, start, i] if length <= len(arcs) else -1
                    assert got == known.get(word[start : start + length], -1)
    assert len(vocabulary.guess) == 257 + len(vocabulary.pieces) and not any("A" <= c <= "Z" for p in vocabulary.pieces for c in p)
    assert np.isclose(vocabulary.guess[vocabulary.begins].sum(), 1) and np.isclose(vocabulary.guess[~vocabulary.begins].sum(), 1)


def test_a_word_of_any_length_has_a_finite_probability():
    weights = some_weights(256 + len(PIECES))
    found = lattice.log_probabilities([" " + "ab" * 40_000, " " + "ab" * 2], lattice.Pieces(PIECES), weights)
    assert np.isfinite(found).all() and found[0] < -1000 < found[1]


WORDS = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_scores(rows, vocabulary, rounds):
    mine = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 != 2]
    train = Counter(w for r in mine for w in tokens(r[1]))
    ends, n_words = len(mine), sum(train.values())
    total, types = n_words + ends, len(train) + (ends > 0)
    trie, counts = lattice.Pieces(vocabulary.pieces), scoring.PRIOR * vocabulary.guess
    weights = vocabulary.weights(counts)
    for _ in range(rounds):
        seen = [" " + w for w in train]
        counts = scoring.PRIOR * vocabulary.guess
        counts[:-1] += lattice.expected_counts(seen, np.ones(len(seen)), trie, weights[:-1])
        counts[-1] += len(seen)
        weights = vocabulary.weights(counts)
    once, twice = sum(c == 1 for c in train.values()), sum(c == 2 for c in train.values())
    discount = once / (once + 2 * twice) if once and twice else 0.5

    def chance(word):
        spelled = math.exp(lattice.log_probabilities([" " + word], trie, weights[:-1])[0] + weights[-1])
        return (max(train[word] - discount, 0) + (discount * len(train) + 1) * spelled) / (total + 2)

    out = []
    for doc_id, text, *_ in rows:
        said = tokens(text)
        base = sum(math.log10((train[w] + 1) / (total + types + 1)) for w in said) + math.log10((ends + 1) / (total + types + 1))
        score = sum(math.log10(chance(w)) for w in said) + math.log10((ends + 1) / (total + 2))
        held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2
        out.append((doc_id, held, len(said) + 1, sum(w in train for w in said) + (ends > 0), total, base, score))
    return out


def made(n, seed):
    draw = random.Random(seed)
    bits = ["the", "Of", "th", "er", "on", "é", "\U0001f600", "Ü", "\x1c", "ing", "İ", "▁", "▁▁a", "<s>"]
    word = lambda: "".join(draw.choice(bits) for _ in range(draw.choice([1, 1, 2, 3])))
    return [(100 + i, draw.choice([" ", "\n", " \t "]).join(word() for _ in range(draw.randrange(40))), "en", "a") for i in range(n)]


@pytest.mark.parametrize("common", [0, 7, 1000])
def test_scores_equal_the_plain_version(spark, common):
    long_word = "ab" * 300
    rows = [r for r in AWKWARD if r[0] != 4] + made(60, 2) + [(500 + i, f"{long_word} x{i} {long_word}", "en", "a") for i in range(12)]
    docs = documents(spark, rows).withColumns({name: F.lit("q") for name in ("word", "train", "n", "rare", "row_no", "learned")})
    vocabulary = scoring.load_vocabulary(queries.tokenizer_path("piece_bpe_32k.model"))
    found = scoring.score_documents(docs, queries.tokenizer_path("piece_bpe_32k.model"), common=common)
    got, want = [sorted(map(tuple, x), key=lambda r: (str(r[:5]), r[5])) for x in (found.collect(), plain_scores(rows, vocabulary, scoring.ROUNDS))]
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"),
                            ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double")]


def test_no_documents_and_none_to_learn_from(spark):
    path = queries.tokenizer_path("piece_bpe_32k.model")
    docs = documents(spark, AWKWARD)
    assert scoring.score_documents(docs.limit(0), path).count() == 0
    for r in scoring.score_documents(docs.where("doc_id is null"), path).collect():
        assert r["base_score"] == 0 and not r["held_out"] and r["train_tokens"] == 0 and r["n_known"] == 0
        assert math.isfinite(r["score"]) and r["score"] < 0


def test_probabilities_of_words_add_up_to_one():
    """A closed world of one-letter pieces: words of every length by generation; longer ones hold the rest."""
    pieces = [" ", "a", "b"]
    guess = np.concatenate([np.full(256, 1e-12), [1.0, 0.3, 0.2], [0.5]])
    begins = np.zeros(len(guess), bool)
    begins[[32, 256]] = True
    vocabulary = scoring.Vocabulary(pieces, guess, begins)
    weights, trie = vocabulary.weights(guess), lattice.Pieces(pieces)
    level, words = [""], [" "]
    for _ in range(8):
        level = [w + c for w in level for c in "ab"]
        words += [" " + w for w in level]
    spelled = lattice.log_probabilities(words, trie, weights[:-1]) + weights[-1]
    assert abs(np.exp(spelled).sum() - (1 - 0.5**9)) < 1e-6
    # Words with counts, all spellings, and the end share what there is.
    totals = scoring.Totals(ends=3, words=11, distinct=3, discount=0.4)
    counts = np.array([6, 4, 1] + [0] * (len(words) - 3))
    mass = (10.0 ** totals.score(counts, spelled)).sum() + 10 ** totals.end_score()
    assert abs(mass - 1) < 0.01


def test_fitting_helps_held_out_texts(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    path = queries.tokenizer_path("piece_bpe_32k.model")
    by = [scoring.score_documents(docs, path, rounds=r).where("held_out").agg(F.sum("score")).first()[0] for r in (0, 2)]
    assert by[0] < by[1] < 0
