"""Probability of texts under a subword lattice, beside a count of words.

A text is its words and an end. A word is spelled in every way the pieces of a given vocabulary and the bytes of its
characters allow, and a word of the training texts also as a whole, by its discounted count; all these ways add up. The weights of
the pieces start from the scores in the vocabulary's file and are fitted to the distinct training words by expected counts. Since
every segmentation keeps to its word, each distinct word is scored once, wherever it occurs.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tollbook.llm import lattice
from tollbook.llm.common import stored, text_of

#: Passes over the distinct training words that fit the weights, and how many occurrences the file's scores stand for.
ROUNDS, PRIOR = 2, 1000.0
#: So many frequent words at most are sent to every task; all others are joined.
COMMON = 65_536
#: Words that a task counts before it hands them on, and words that go through the lattice together.
COUNTED, SCORED = 400_000, 100_000
#: Longer words are known to tasks and joins by a digest.
KEY_BYTES = 64


@dataclass
class Vocabulary:
    """Pieces that a lower-cased word can hold, their first guess, and which of them begin a word (with a blank)."""

    pieces: list[str]
    guess: np.ndarray
    begins: np.ndarray

    def weights(self, counts: np.ndarray) -> np.ndarray:
        """Log probabilities by counts: one sum for what begins a word, one for what goes on or ends it."""
        sums = np.where(self.begins, counts[self.begins].sum(), counts[~self.begins].sum())
        return np.log(counts / sums)


def load_vocabulary(path: str) -> Vocabulary:
    """Pieces and scores of a sentencepiece file. Places are 256 bytes, the pieces, and the end of a word.

    The file keeps the order of its merges as scores 0, -1, -2 and so on, so a piece is guessed to occur as often as one over
    its place in that order. The blank that the file writes as ``▁`` may only begin a piece.
    """
    from sentencepiece import SentencePieceProcessor

    model, kept = SentencePieceProcessor(model_file=path), {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        plain = piece[piece.startswith("▁") :]
        special = model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        if special or "▁" in plain or plain.encode() != plain.encode().lower() or len(plain.encode().split()) != 1:
            continue
        kept[" " + plain if piece != plain else plain] = 1 / (1 + max(0.0, -model.get_score(i)))
    pieces = list(kept)
    least = min(kept.values(), default=1.0)
    guess = np.concatenate([np.full(256, least), list(kept.values()), [0.1]])
    begins = np.zeros(len(guess), bool)
    begins[32], begins[256:-1] = True, [p.startswith(" ") for p in pieces]
    return Vocabulary(pieces, np.exp(Vocabulary(pieces, guess, begins).weights(guess)), begins)


def in_blocks(batches, most: int = SCORED):
    """Arrow batches joined until they hold ``most`` rows or 32 MB, so that words of one length meet."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= most or size > 1 << 25:
            yield pa.Table.from_batches(held)
            held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held)


def spelled(words: pa.ChunkedArray) -> list[str]:
    return [" " + w for w in words.to_pylist()]


def key_of(word: Column) -> Column:
    """A word itself, or the digest of a long one; line ends keep them apart."""
    return F.when(F.octet_length(word) <= KEY_BYTES, word).otherwise(F.concat(F.lit("\n"), F.md5(word.cast("binary"))))


def _key(word: bytes) -> bytes:
    return word if len(word) <= KEY_BYTES else b"\n" + hashlib.md5(word).hexdigest().encode()


def learned(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    """Rows to learn from; never those without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds != fold, F.lit(False))


def count_words(documents: DataFrame) -> DataFrame:
    """``word, train, every``: occurrences in the rows of ``documents(text, learned)`` to learn from, and in all."""

    def listed(train: Counter, other: Counter):
        words = [*train, *(w for w in other if w not in train)]
        for at in range(0, len(words), SCORED):
            some = words[at : at + SCORED]
            counts = [train.get(w, 0) for w in some]
            every = [n + other.get(w, 0) for n, w in zip(counts, some)]
            columns = [pa.array(some, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(every, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "train", "every"])

    def count(batches):
        by = {True: Counter(), False: Counter()}
        for batch in batches:
            for text, mine in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("learned").to_pylist()):
                by[mine].update(text.lower().split())
                if len(by[True]) + len(by[False]) > COUNTED:
                    yield from listed(by[True], by[False])
                    by = {True: Counter(), False: Counter()}
        yield from listed(by[True], by[False])

    counted = documents.mapInArrow(count, "word string, train long, every long")
    return counted.groupBy("word").agg(F.sum("train").alias("train"), F.sum("every").alias("every"))


def fit_weights(words: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS, prior: float = PRIOR) -> np.ndarray:
    """Weights under which the distinct training words of ``words(word, train)`` are likely; tasks hand on sums by piece."""
    training, guess = words.where("train > 0").select("word"), prior * vocabulary.guess
    weights = vocabulary.weights(guess)
    for _ in range(rounds):
        counted = training.mapInArrow(_expecting(vocabulary.pieces, weights), "place int, n double")
        sums = counted.groupBy("place").agg(F.sum("n").alias("n")).toArrow()  # one row per piece at most
        counts = guess.copy()
        counts[sums["place"].to_numpy()] += sums["n"].to_numpy()
        weights = vocabulary.weights(counts)
    return weights


def _expecting(pieces: list[str], weights: np.ndarray):
    def expect(batches):
        trie, counts = lattice.Pieces(pieces), np.zeros(len(weights))
        for block in in_blocks(batches):
            words = spelled(block["word"])
            counts[:-1] += lattice.expected_counts(words, np.ones(len(words)), trie, weights[:-1])
            counts[-1] += len(words)
        place = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(counts[place])], ["place", "n"])

    return expect


@dataclass
class Totals:
    """Of the training texts: their number, words, distinct words, and the discount of a count."""

    ends: int
    words: int
    distinct: int
    discount: float

    @property
    def tokens(self) -> int:
        return self.words + self.ends

    @property
    def types(self) -> int:
        return self.distinct + (self.ends > 0)

    def end_score(self) -> float:
        return float(np.log10((self.ends + 1) / (self.tokens + 2)))

    def score(self, counts: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """log10 of a word's probability, from its count and the log of all its spellings; what counts lose, spellings get."""
        whole = np.log(np.maximum(counts - self.discount, 1e-300))
        open_ = np.log(self.discount * self.distinct + 1) + spelled
        return (np.where(counts > 0, np.logaddexp(whole, open_), open_) - np.log(self.tokens + 2)) / np.log(10)


def totals_of(words: DataFrame, ends: int) -> Totals:
    n = words.where("train > 0").agg(
        F.coalesce(F.sum("train"), F.lit(0)).alias("words"), F.count("*").alias("distinct"),
        F.count_if(F.col("train") == 1).alias("once"), F.count_if(F.col("train") == 2).alias("twice"),
    ).first()
    discount = n["once"] / (n["once"] + 2 * n["twice"]) if n["once"] and n["twice"] else 0.5
    return Totals(ends, n["words"], n["distinct"], discount)


def score_words(words: DataFrame, vocabulary: Vocabulary, weights: np.ndarray, totals: Totals) -> DataFrame:
    """Adds ``score``, the log10 probability of each word."""
    pieces = vocabulary.pieces

    def score(batches):
        trie = lattice.Pieces(pieces)
        for block in in_blocks(batches):
            found = lattice.log_probabilities(spelled(block["word"]), trie, weights[:-1]) + weights[-1]
            block = block.append_column("score", pa.array(totals.score(block["train"].to_numpy(), found)))
            yield from block.combine_chunks().to_batches()

    return words.select("word", "train", "every").mapInArrow(score, "word string, train long, every long, score double")


def common_words(words: DataFrame, most: int = COMMON) -> dict[bytes, tuple[int, float]]:
    """The most frequent words, ``most`` at most, down to a count that depends on all words."""
    bucket = F.floor(4 * F.log2("every")).cast("int")
    sizes, level, held = words.groupBy(bucket.alias("b")).count().collect(), 1 << 30, 0  # four rows per power of two
    for row in sorted(sizes, reverse=True):
        held += row["count"]
        if held > most:
            break
        level = row["b"]
    some = words.where(bucket >= level).select(key_of(F.col("word")).alias("key"), "train", "score").toArrow()
    return dict(zip(some["key"].cast(pa.binary()).to_pylist(), zip(some["train"].to_pylist(), some["score"].to_pylist())))


def sum_common(documents: DataFrame, common: dict) -> DataFrame:
    """Sums of each document over the common words, and its other words with their times.

    ``n`` words, ``known`` of training texts, ``base`` of log10(count + 1) and ``score``; rows keep ``doc_id`` and ``learned``.
    """
    sent = documents.sparkSession.sparkContext.broadcast(common)  # at most COMMON words of KEY_BYTES bytes
    kind = documents.schema["doc_id"].dataType
    tail = StructType.fromDDL("learned boolean, n long, known long, base double, score double, rare array<string>, times array<int>")

    def add(batches):
        values = sent.value
        held = {key: (train > 0, float(np.log10(train + 1)), score) for key, (train, score) in values.items()}
        for batch in batches:
            sums, rare, times, ends = [], [], [], [0]
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                n = known = 0
                base = score = 0.0
                for word, k in Counter(text.lower().split()).items():
                    n += k
                    key = _key(word)
                    at = held.get(key)
                    if at is None:
                        rare.append(key)
                        times.append(k)
                    else:
                        known += k * at[0]
                        base += k * at[1]
                        score += k * at[2]
                sums.append((n, known, base, score))
                ends.append(len(rare))
            columns = list(zip(*sums)) or [()] * 4
            places = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("learned"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.float64()),
                    pa.ListArray.from_arrays(places, pa.array(rare, pa.binary()).cast(pa.string())),
                    pa.ListArray.from_arrays(places, pa.array(times, pa.int32())),
                ],
                ["doc_id", *tail.names],
            )

    return documents.select("doc_id", "learned", "text").mapInArrow(add, StructType([StructField("doc_id", kind), *tail]))


def score_documents(
    documents: DataFrame, vocabulary_path: str, folds: int = 7, fold: int = 2, rounds: int = ROUNDS, common: int = COMMON
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``documents(doc_id, text)``.

    Rows whose id falls into ``fold`` are held out, and rows without an id are neither held out nor learned from. A null
    text counts as empty: an end alone. ``base_score`` adds one to the counts of the training tokens, ``score`` is the log10 probability
    under the lattice. Without training texts counts are 0 and the file's scores alone weigh the pieces. Repeated rows all count and all
    return. Only words beyond the ``common`` ones are shuffled, none of which holds more than 1.2 of ``common`` parts of all tokens.
    """
    vocabulary = load_vocabulary(vocabulary_path)
    mine = learned(F.col("doc_id"), folds, fold)
    texts = documents.select("doc_id", mine.alias("learned"), text_of().alias("text"))
    counted = stored(count_words(texts), "scoring-words")
    totals = totals_of(counted, texts.where("learned").count())
    weights = fit_weights(counted, vocabulary, rounds)
    words = stored(score_words(counted, vocabulary, weights, totals), "scoring-scores")
    summed = sum_common(texts, common_words(words, common)).withColumn("row_no", F.monotonically_increasing_id())
    summed = stored(summed, "scoring-documents")
    rare = summed.select("row_no", F.explode(F.arrays_zip("rare", "times")).alias("of")).select("row_no", "of.*")
    met = rare.join(words.select(key_of(F.col("word")).alias("rare"), "train", F.col("score").alias("_score")), "rare")
    sums = met.groupBy("row_no").agg(
        F.sum(F.when(F.col("train") > 0, F.col("times")).otherwise(0)).alias("_known"),
        F.sum(F.col("times") * F.log10(F.col("train") + 1)).alias("_base"), F.sum(F.col("times") * F.col("_score")).alias("_score"),
    )
    whole = lambda name: F.col(name) + F.coalesce(f"_{name}", F.lit(0))
    tokens = F.col("n") + 1
    base = whole("base") + float(np.log10(totals.ends + 1)) - tokens * float(np.log10(totals.tokens + totals.types + 1))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))
    return summed.join(sums, "row_no", "left").select(
        "doc_id", held_out.alias("held_out"), tokens.alias("n_tokens"), (whole("known") + int(totals.ends > 0)).alias("n_known"),
        F.lit(totals.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (whole("score") + totals.end_score()).alias("score"),
    )
