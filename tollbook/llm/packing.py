"""Packing token sequences: first-fit decreasing with a tournament tree of bin capacities.

Documents are tokenized once and cut into pieces no longer than a sequence. Pieces are dealt into random groups
of bounded size, and inside a group the largest remaining piece goes to the first bin that still holds it, which a
tree of the largest capacities below each node finds in logarithmic time.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import held, stored

LENGTH, GROUP_PIECES, SEED = 2048, 4096, 3
#: The token that ends every document.
END_ID = 1
#: Words, and pieces of words, whose ids a Python worker keeps. Frequent ones come early, so later ones are just not kept.
KEPT_WORDS = 300_000


class Tokens(dict):
    """Ids of what stands between blanks, as packed 32-bit numbers; computed when first asked for.

    The tokenizer drops white space and splits there, so a text has the ids of its words in order. Words of plain
    Latin letters, digits and marks are cut by the tokenizer's own pattern here and go straight to its merges; all
    others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        # The split pattern of this tokenizer, and the byte alphabet of byte-level vocabularies.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.plain = regex.compile(r"[!-~¡-ɏ]*").fullmatch

    def __missing__(self, word: str) -> bytes:
        if self.plain(word) and "<|" not in word:
            pieces = self.pattern.findall(word.lower())
            packed = self._merged(word) if pieces == [word] else b"".join([self[p] for p in pieces])
        else:
            packed = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < KEPT_WORDS:
            self[word] = packed
        return packed

    def _merged(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(self.alphabet)
        return b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(letters)])

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def tokens_of(path: str) -> Tokens:
    """The tokenizer of this worker process, loaded once."""
    kept = held("tokens")
    if path not in kept:
        kept[path] = Tokens(path)
    return kept[path]


def pieces(documents: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, no`` of the pieces of every document, cut at multiples of ``length``.

    ``no`` numbers the pieces of a task. Ids are text on the way, because null among numbers would make them inexact.
    """

    def cut(batches):
        tokens, end, no = tokens_of(path), end_id.to_bytes(4, "little"), 0
        for frame in batches:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = memoryview(tokens.encode(text) + end)
                total = len(ids) // 4
                for start in range(0, total, length):
                    piece = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total, no))
                    no += 1
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "no"])

    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(cut, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, no long")


class Bins:
    """Bins in order of opening, under a tree that knows the largest free space below each node."""

    def __init__(self, capacity: int, most: int):
        self.width = 1 << max(0, most - 1).bit_length()
        self.free = [capacity] * (2 * self.width)

    def place(self, size: int) -> int:
        """Put a piece into the first bin with room for it."""
        free, node = self.free, 1
        while node < self.width:
            node *= 2
            if free[node] < size:
                node += 1
        bin_no = node - self.width
        free[node] -= size
        while node > 1:
            node //= 2
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
        return bin_no


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each piece, none larger than the capacity; sizes must come in decreasing order."""
    bins = Bins(capacity, len(sizes))
    return [bins.place(size) for size in sizes]


def pack(
    documents: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, group_pieces: int = GROUP_PIECES, seed: int = SEED
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece of ``documents(doc_id, text)``.

    A document is its ids and then ``end_id``; null and empty texts have that id alone. Sequences hold at most
    ``length`` ids, pieces without gaps from offset 0. Pieces of equal size are ordered by document (as text) and start; rows
    of one id are packed each, and a null id stays null. Special tokens written in a text are read as the
    tokenizer reads them. Other columns are ignored; no rows give no rows.
    """
    cut = stored(pieces(documents, path, length, end_id), "packing-pieces")
    groups = -(-cut.count() // group_pieces) or 1
    # The number of the piece spreads rows that agree in all else over the groups.
    dealt = cut.withColumn("bin_group", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "no"), F.lit(groups)).cast("int"))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        order = ["length", "doc_id", "start", "no"]
        frame = frame.sort_values(order, ascending=[False, True, True, True]).reset_index(drop=True)
        bins = np.array(first_fit_decreasing(frame["length"].tolist(), length), np.int64)
        by_bin = np.argsort(bins, kind="stable")
        ends = np.cumsum(frame["length"].to_numpy("int64")[by_bin])
        begins = np.concatenate([[0], ends[:-1]])
        first = np.flatnonzero(np.diff(bins[by_bin], prepend=-1))
        offset = np.empty(len(frame), np.int64)
        offset[by_bin] = begins - np.repeat(begins[first], np.diff(np.append(first, len(frame))))
        sequence = (frame["bin_group"].to_numpy("int64") << 32) + bins
        return frame.drop(columns=["bin_group", "no"]).assign(sequence_id=sequence, offset=offset)

    shape = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    packed = dealt.groupBy("bin_group").applyInPandas(fit, shape)
    return packed.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))
