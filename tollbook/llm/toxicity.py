"""Toxicity by a factorization machine over hashed terms.

Each term has a weight and a short vector; a pair of terms counts by the product of their vectors. So a pair such
as insult and group mention can weigh more, or less, than its two terms, which additive weights can't express. Counts over
all labelled rows, of terms and of pairs with the strongest terms, choose the terms; the machine is fitted to a bounded
sample of labelled rows. No term is refused for a weak effect: the less evidence, the stronger it is held at zero.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import stored, text_of
from tollbook.session import broadcast_within

#: Bounds of the model and of its training sample: terms, labelled rows; a term must occur in so many labelled rows.
TERMS, ROWS, LEAST = 2048, 40_000, 5
#: Pairs are counted between so many strongest terms and so many frequent ones.
ANCHORS, CANDIDATES = 32, 8192
#: Terms of so many standard errors are held by the plain penalty, weaker ones by the fourth power of what they lack.
ERRORS, PENALTY = 5.0, 0.2
FACTORS, STEPS, BATCH, SEED = 8, 1000, 256, 1
#: Counts of pairs that a task hands on at once, and rows that it works on at once.
CELLS, BLOCK_ROWS = 50_000, 1024
#: Labels, two numbers each, are sent to every executor up to so many rows; more are joined by shuffle.
BROADCAST_ROWS = 500_000


#: A word also counts by its beginnings of these lengths, so that other endings of an insult are known too.
BEGINNINGS = (4, 5)


def hashed_terms(text: Column) -> Column:
    """Distinct 32-bit hashes of a text's lower-cased words and their beginnings; an empty text has none."""
    words = F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    hashed = lambda w: (F.crc32(w.cast("binary")) - F.lit(1 << 31)).cast("int")
    long = F.filter(words, lambda w: F.length(w) >= BEGINNINGS[0])
    begun = [F.transform(long, lambda w: hashed(F.concat(F.lit(f"{n}:"), F.substring(w, 1, n)))) for n in BEGINNINGS]
    return F.array_distinct(F.concat(F.transform(words, hashed), *begun))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


@dataclass
class Machine:
    """bias + sum of weights + sum over pairs of the products of their vectors, as a probability."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def score(self, known: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """``known`` holds places of terms row after row, the last of row i before ``begins[i + 1]``."""
        rows = len(begins) - 1
        row = np.repeat(np.arange(rows), np.diff(begins))
        linear = np.bincount(row, self.weights[known], rows)
        v = self.vectors[known]
        pairs = np.zeros(rows)
        for f in range(v.shape[1]):
            pairs += np.bincount(row, v[:, f], rows) ** 2 - np.bincount(row, v[:, f] ** 2, rows)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pairs / 2, -60, 60)))


def known_terms(lists: pa.ListArray, terms: np.ndarray):
    """Blocks of rows: where a block begins, the places of its hashes among the sorted ``terms``, and where each row's begin.

    A block is small, so that a task's memory does not follow the size of Spark's batches.
    """
    offsets, flat = lists.offsets.to_numpy(), lists.values
    for at in range(0, len(lists), BLOCK_ROWS):
        edges = offsets[at : at + BLOCK_ROWS + 1]
        hashes = flat.slice(edges[0], edges[-1] - edges[0]).to_numpy().astype(np.int64)
        place = np.minimum(np.searchsorted(terms, hashes), max(0, len(terms) - 1))
        known = terms[place] == hashes if len(terms) else np.zeros(len(hashes), bool)
        yield at, place[known], np.concatenate([[0], np.cumsum(known)])[edges - edges[0]]


@dataclass
class Terms:
    """Chosen terms, sorted, with the standard errors of their own effect and of the greater of own and in pairs."""

    hashes: np.ndarray
    own: np.ndarray
    paired: np.ndarray


def errors_of(p, c, toxic, clean):
    """Standard errors between the shares of ``p`` of ``toxic`` and ``c`` of ``clean`` rows."""
    share = (p + c) / np.maximum(toxic + clean, 1)
    spread = np.sqrt(share * (1 - share) * (1 / np.maximum(toxic, 1) + 1 / np.maximum(clean, 1)) + 1e-12)
    return np.abs(p / np.maximum(toxic, 1) - c / np.maximum(clean, 1)) / spread


def pair_counts(labelled: DataFrame, anchors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """``counts[label, anchor, term]`` over all labelled rows, summed in the tasks first; ``anchors`` are places of ``terms``."""
    which = np.full(len(terms), -1)
    which[anchors] = np.arange(len(anchors))

    shape = (2, len(anchors), len(terms))

    def count(batches):
        sums = np.zeros(shape, np.int64)
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            for at, place, begins in known_terms(batch.column("terms"), terms):
                for label, a, b in zip(toxic[at:], begins, begins[1:]):
                    some = place[a:b]
                    held = which[some]
                    sums[label][np.ix_(held[held >= 0], some)] += 1
        cells = np.flatnonzero(sums)
        for at in range(0, len(cells), CELLS):
            some = cells[at : at + CELLS]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums.ravel()[some])], ["cell", "n"])

    # Cells that occur are summed by Spark, each by itself, so no group grows with the tasks.
    summed = labelled.select("toxic", "terms").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(shape)
    out.ravel()[summed["cell"].to_numpy()] = summed["n"].to_numpy()
    return out


def choose_terms(labelled: DataFrame, count: int = TERMS, least: int = LEAST) -> Terms | None:
    """Half of the terms by their own effect, a quarter by their effect beside a strongest term, the rest by frequency.

    Terms in fewer than ``least`` rows count only if there are no others. None without both labels.
    """
    rows = labelled.groupBy("toxic").count().collect()  # one row per label
    n = {r["toxic"]: r["count"] for r in rows}
    if len(n) < 2:
        return None
    seen = labelled.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum(F.col("toxic").cast("double")).alias("p"), F.count("*").cast("double").alias("all")
    )
    seen = stored(seen, "toxicity-counts")
    often = seen.where(F.col("all") >= least)
    if not often.head(1):
        often = seen
    share = F.col("all") / (n[0] + n[1])
    spread = F.sqrt(share * (1 - share) * (1 / n[1] + 1 / n[0]) + F.lit(1e-12))
    z = F.abs(F.col("p") / n[1] - (F.col("all") - F.col("p")) / n[0]) / spread
    best = lambda by, most, label: stored(often.orderBy(F.desc(by), "term").limit(most), label)
    # A term of every row says nothing, and neither does one of none: the variance ranks frequencies.
    some = best(z, count, "toxicity-strong").union(best(share * (1 - share), max(count, CANDIDATES), "toxicity-frequent"))
    some = some.distinct().toArrow().sort_by("term")
    terms, p = some["term"].to_numpy().astype(np.int64), some["p"].to_numpy()
    c = some["all"].to_numpy() - p
    own = errors_of(p, c, n[1], n[0])
    anchors = np.argsort(-own, kind="stable")[:ANCHORS]
    clean, toxic = pair_counts(labelled, anchors, terms)
    lines = np.arange(len(anchors))
    beside = errors_of(toxic, clean, toxic[lines, anchors][:, None], clean[lines, anchors][:, None])
    beside[lines, anchors] = 0
    # The greatest of many chance effects is no small one: what their number explains is taken off.
    pair = np.sqrt(np.maximum(0, beside.max(0, initial=0) ** 2 - 2 * np.log(max(1, len(anchors)))))
    taken: list[int] = []
    for by, most in ((own, count // 2), (pair, count * 3 // 4), ((p + c) * (n[0] + n[1] - p - c), count)):
        held = set(taken)
        taken += [i for i in np.argsort(-by, kind="stable").tolist() if i not in held][: most - len(taken)]
    taken = np.sort(np.array(taken, np.int64))
    return Terms(terms[taken], own[taken], np.maximum(own, pair)[taken])


def loss_slopes(params: list[np.ndarray], x: np.ndarray, labels: np.ndarray, hold: list[np.ndarray]) -> list[np.ndarray]:
    """Slopes of the mean logistic loss over rows ``x`` of zeros and ones, plus half the ``hold`` times each square, by bias, weights and vectors."""
    bias, w, v = params
    sums = x @ v
    z = bias + x @ w + (sums**2 - x @ v**2).sum(1) / 2
    error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels) / len(x)
    by_term = x.T @ error
    return [np.array([error.sum()]), by_term + hold[0] * w, x.T @ (error[:, None] * sums) - by_term[:, None] * v + hold[1][:, None] * v]


def fit_machine(known: np.ndarray, begins: np.ndarray, labels: np.ndarray, terms: Terms) -> Machine:
    """Minimise the logistic loss by Adam over shuffled batches, with penalties by the evidence for each term.

    ``known`` holds the places of terms row after row, the last of row i before ``begins[i + 1]``.
    """
    rng, n, size = np.random.default_rng(SEED), len(labels), len(terms.hashes)
    base = (labels.sum() + 0.5) / (n + 1)
    params = [np.array([np.log(base / (1 - base))]), np.zeros(size), rng.normal(0, 0.01, (size, FACTORS))]
    slopes, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    hold = [PENALTY / n / np.clip(e / ERRORS, 0.1, 1.0) ** 4 for e in (terms.own, terms.paired)]
    order = rng.permutation(n)
    for step in range(1, STEPS + 1):
        some = order[:BATCH]
        order = np.concatenate([order[BATCH:], rng.permutation(n) if len(order) <= BATCH else order[:0]])
        x = np.zeros((len(some), size))
        for i, r in enumerate(some):
            x[i, known[begins[r] : begins[r + 1]]] = 1
        grads = loss_slopes(params, x, labels[some], hold)
        rate = 0.02 * min(1.0, 2 - 2 * step / (STEPS + 1))
        for p, g, m, s in zip(params, grads, slopes, squares):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Machine(terms.hashes, float(params[0][0]), params[1], params[2])


def known_rows(labelled: DataFrame, terms: np.ndarray) -> DataFrame:
    """``hash, toxic, known``: a hash of the id, and the places of the known terms of a row as packed numbers."""
    kind = packed_kind(terms)

    def reduce(batches):
        for batch in batches:
            packed = []
            for _, place, begins in known_terms(batch.column("terms"), terms):
                place = place.astype(kind)
                packed += [place[a:b].tobytes() for a, b in zip(begins, begins[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("hash"), batch.column("toxic"), pa.array(packed, pa.binary())], ["hash", "toxic", "known"])

    rows = labelled.select(F.xxhash64("doc_id").alias("hash"), "toxic", "terms")
    return rows.mapInArrow(reduce, "hash long, toxic int, known binary")


def packed_kind(terms: np.ndarray) -> str:
    return "<u2" if len(terms) <= 1 << 16 else "<u4"


def sample_rows(known: DataFrame, terms: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``limit`` rows, those of the smallest hashes, as ``fit_machine`` takes them: places, begins and labels.

    A bound on the hash from the number of rows lets little more than these leave the tasks; equal rows travel once, with their number.
    """
    count = known.count()
    if count > 2 * limit:
        share = (1.2 * limit + 500) / count
        known = known.where(F.col("hash") <= int(-(1 << 63) + min(1.0, share) * ((1 << 64) - 1025)))
    few = known.groupBy("hash", "toxic", "known").agg(F.count("*").alias("times")).toArrow()
    few = few.sort_by([("hash", "ascending"), ("toxic", "ascending"), ("known", "ascending")])
    before = np.cumsum(few["times"].to_numpy()) - few["times"].to_numpy()
    times = np.clip(limit - before, 0, few["times"].to_numpy())
    which = np.repeat(np.arange(len(times)), times)
    packed = few["known"].take(which).to_pylist()
    kind = packed_kind(terms)
    sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(packed), kind), np.concatenate([[0], np.cumsum(sizes)]), few["toxic"].to_numpy()[which].astype(float)


def train(documents: DataFrame, labels: DataFrame, count: int = TERMS, rows: int = ROWS, least: int = LEAST) -> Machine:
    """Learn from ``documents(doc_id, text)`` and ``labels(doc_id, toxic)``, held-out rows left aside.

    Terms are counted over all labelled rows; the fit takes at most ``rows`` of them, chosen by a hash of the id.
    Labels other than 0 and 1 and rows without an id are left out. Without both labels, every score is 0.
    """
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    marked = broadcast_within(stored(marked, "toxicity-labels"), BROADCAST_ROWS)
    labelled = documents.select("doc_id", "text").join(marked, "doc_id").select("doc_id", "toxic", hashed_terms(text_of()).alias("terms"))
    labelled = stored(labelled, "toxicity-labelled")
    chosen = choose_terms(labelled, count, least)
    if chosen is None:
        return Machine(np.empty(0, np.int64), -60.0, np.zeros(0), np.zeros((0, FACTORS)))
    known = stored(known_rows(labelled, chosen.hashes), "toxicity-known")
    return fit_machine(*sample_rows(known, chosen.hashes, rows), chosen)


def score_column(machine: Machine, text: Column) -> Column:
    """Probability that a text is toxic; terms are made by Spark, and only sums over them in Python."""

    @F.arrow_udf("double")
    def score(lists: pa.Array) -> pa.Array:
        parts = [machine.score(place, begins) for _, place, begins in known_terms(lists, machine.terms)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score(hashed_terms(text))


def score_toxicity(documents: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``documents(doc_id, text)``.

    Null text counts as empty and, like a text of unknown terms only, has the score of the bias. A row without an id
    is not held out and never learned from; repeated rows all return. Other columns are ignored; no rows give no rows.
    """
    machine = train(documents, labels, **bounds)
    scored = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(machine, text_of()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(documents: DataFrame, labels: DataFrame, limit: float = 0.5, **bounds: int) -> DataFrame:
    """The documents that score below ``limit``. All columns stay, whatever their names."""
    machine = train(documents, labels, **bounds)
    names = [f"_toxic_{i}" for i in range(len(documents.columns))]
    text = names[documents.columns.index("text")]
    kept = documents.toDF(*names).where(score_column(machine, F.coalesce(F.col(text), F.lit(""))) < limit)
    return kept.select(*[F.col(names[i]).alias(name) for i, name in enumerate(documents.columns)])
