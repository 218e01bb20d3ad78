"""Fill-in-middle: a text cut into prefix, middle and suffix, and put together again with the middle last.

A Fenwick tree over blocks of the text's bytes knows how many units end, and how many code points begin, in front of
every block. Cutting after a number of units is a descent by powers of two to the block that holds the cut and a look inside that
block alone. Tasks return three numbers a text; Spark builds the texts themselves from these.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import text_of

#: The marks of the parts. A text that holds one of them stays plain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of a block.
BLOCK = 512
#: Of a hundred texts so many are cut, and of a hundred cut ones so many have the suffix first.
CUT_RATE, SUFFIX_FIRST_RATE, SEED = 50, 80, 42

BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
LEADING = (np.arange(256) & 0xC0) != 0x80


class BlockTree:
    """Fenwick tree whose cells hold several counts: ``counts[kind, block]``."""

    def __init__(self, counts: np.ndarray):
        kinds, self.blocks = counts.shape
        self.sums = np.zeros((kinds, self.blocks + 1), np.int64)
        self.sums[:, 1:] = counts
        step = 1
        while 2 * step <= self.blocks:  # cells of one lowest bit hand their sums on at once
            parents = self.sums[:, 2 * step :: 2 * step]
            parents += self.sums[:, step :: 2 * step][:, : parents.shape[1]]
            step *= 2
        self.top = step

    def total(self, kind: int) -> int:
        """Sum over all blocks."""
        at, found = self.blocks, 0
        while at:
            found += int(self.sums[kind, at])
            at &= at - 1
        return found

    def descend(self, kind: int, target: int) -> tuple[int, np.ndarray]:
        """The block with the ``target``-th of a kind, and the counts of everything before it."""
        at, step, before = 0, self.top, np.zeros(len(self.sums), np.int64)
        while step:
            if at + step <= self.blocks and before[kind] + self.sums[kind, at + step] < target:
                at += step
                before = before + self.sums[:, at]
            step >>= 1
        return at, before


class Cutter:
    """Places of the units of many texts, whose bytes stand one after the other."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, block: int = BLOCK):
        self.offsets, self.block = offsets.astype(np.int64), block
        blank = BLANK[data]
        # A unit is the blanks before a word and the word; blanks at the end of a text are one more.
        self.ends = ~blank
        self.ends[:-1] &= blank[1:]
        full = self.offsets[1:] > self.offsets[:-1]
        self.ends[self.offsets[1:][full] - 1] = True
        self.leading = LEADING[data]
        sizes = -(-np.diff(self.offsets) // block)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        within = np.arange(self.first[-1]) - np.repeat(self.first[:-1], sizes)
        starts = np.repeat(self.offsets[:-1], sizes) + within * block
        sums = [np.add.reduceat(of, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64) for of in (self.ends, self.leading)]
        self.counts = np.stack(sums)

    def tree(self, text: int) -> BlockTree:
        return BlockTree(self.counts[:, self.first[text] : self.first[text + 1]])

    def cut(self, text: int, tree: BlockTree, units: int) -> int:
        """Code points of the first ``units`` units of a text."""
        if units == 0:
            return 0
        block, (passed, points) = tree.descend(0, units)
        start = self.offsets[text] + block * self.block
        inside = self.ends[start : min(start + self.block, self.offsets[text + 1])]
        last = np.flatnonzero(inside)[units - passed - 1]
        return int(points) + int(self.leading[start : start + last + 1].sum())


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of a column without nulls, and where each text begins and ends in it."""
    texts = texts.cast(pa.large_binary())
    buffers = texts.buffers()
    if not len(texts) or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def cut_points(block: int = BLOCK):
    """Column function of (text, h1, h2): units of a text, and code points before its two cuts."""

    @F.arrow_udf("struct<n:bigint,first:bigint,second:bigint>")
    def cuts(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        cutter = Cutter(*bytes_of(texts), block)
        found = np.zeros((3, len(texts)), np.int64)
        for i, (a, b) in enumerate(zip(one.to_pylist(), two.to_pylist())):
            tree = cutter.tree(i)
            n = tree.total(0)
            low, high = sorted((a % (n + 1), b % (n + 1)))
            found[:, i] = n, cutter.cut(i, tree, low), cutter.cut(i, tree, high)
        return pa.StructArray.from_arrays([pa.array(x) for x in found], ["n", "first", "second"])

    return cuts


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 from the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def restore(output: Column, form: Column) -> Column:
    """The exact text: parts hold no marks, so the output falls apart at its three marks alone."""
    parts = F.split(output, "<[PSM]>", -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(
    documents: DataFrame, cut_rate: int = CUT_RATE, suffix_first_rate: int = SUFFIX_FIRST_RATE, seed: int = SEED, block: int = BLOCK
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``documents(doc_id, text)``.

    ``form`` is plain, psm or spm (the order of prefix, suffix and middle). A null text counts as empty, and empty
    texts and those with a mark stay plain, with null lengths. A null id draws as an id without digits; rows of one id draw alike,
    and all return. A text is handled whole, whatever its length. Other columns are ignored; no rows give no rows.
    """
    text = text_of()
    rows = documents.select("doc_id", text.alias("text"), *[h.alias(f"h{i}") for i, h in enumerate(draws(F.col("doc_id"), seed), 1)])
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= cut_rate)
    spm = F.col("h4") % 100 < suffix_first_rate
    cut = rows.select(
        "doc_id", "text", F.when(plain, "plain").when(spm, "spm").otherwise("psm").alias("form"),
        cut_points(block)("text", "h1", "h2").alias("cuts"),
    )
    first, second = F.col("cuts.first").cast("int"), F.col("cuts.second").cast("int")
    prefix, middle = F.substring("text", F.lit(1), first), F.substring("text", first + 1, second - first)
    suffix = F.substring("text", second + 1, F.length("text"))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    output = F.when(F.col("form") == "psm", psm).when(
        F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    ).otherwise(F.col("text"))
    is_cut = F.col("form") != "plain"
    return cut.select(
        "doc_id", F.col("cuts.n").alias("n"), "form", F.when(is_cut, F.col("cuts.first")).alias("prefix_chars"),
        F.when(is_cut, F.col("cuts.second") - F.col("cuts.first")).alias("middle_chars"), output.alias("output"),
    )
