"""All segmentations of words into weighted pieces, for many words of one length at a time.

The pieces are a trie whose steps are looked up by (node, character), both in one number, so every arc of a lattice is
exact. Besides, each character is an arc of its bytes, so that no text has probability zero. Sums over the
segmentations run forward, and for expected counts backward, in log space.
"""

from __future__ import annotations

import numpy as np

#: Cells (words x positions x lengths) that one step of the work may hold.
CELLS = 2_000_000


class Pieces:
    """A vocabulary as a trie; places ``0 .. 255`` are bytes, then the pieces in their order."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        nodes: dict[tuple[int, int], int] = {}
        ends = {}
        for place, piece in enumerate(pieces):
            node = 0
            for letter in map(ord, piece):
                node = nodes.setdefault((node, letter), len(nodes) + 1)
            ends[node] = 256 + place
        self.longest = max(map(len, pieces), default=0)
        self.piece_of = np.full(len(nodes) + 1, -1, np.int32)
        self.piece_of[list(ends)] = list(ends.values())
        keys = np.array([(node << 21) | letter for node, letter in nodes], np.int64)
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.array(list(nodes.values()), np.int64)[order]
        # One probe finds most steps; those whose slot was taken are searched.
        self.bits = max(4, (8 * len(keys)).bit_length())
        slots = self._slot(self.keys)
        self.slot_key, self.slot_next = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        self.slot_key[slots], self.slot_next[slots] = self.keys, self.next
        taken = self.slot_key[slots] != self.keys
        self.late_keys, self.late_next = self.keys[taken], self.next[taken]
        late = np.zeros(1 << self.bits, bool)
        late[slots[taken]] = True
        self.late = late

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The node below each node by a letter, -1 if there is none."""
        keys = (nodes << 21) | letters
        slots = self._slot(keys)
        found = np.where(self.slot_key[slots] == keys, self.slot_next[slots], -1)
        open_ = np.flatnonzero((found < 0) & self.late[slots])
        if len(open_):
            at = np.minimum(np.searchsorted(self.late_keys, keys[open_]), len(self.late_keys) - 1)
            found[open_] = np.where(self.late_keys[at] == keys[open_], self.late_next[at], -1)
        return found

    def arcs(self, letters: np.ndarray, begin: int, end: int) -> np.ndarray:
        """``[length - 1, start - begin, word]``: the piece over ``length`` letters from ``start``, or -1.

        ``letters[place, word]`` are code points of words of equal length; starts lie from ``begin`` to ``end``.
        """
        size, count = letters.shape
        width = end - begin
        # Only starts that some piece still may continue from go on to the next length.
        start, word = (x.ravel() for x in np.indices((width, count)))
        node, found = np.zeros(width * count, np.int64), []
        for length in range(1, min(self.longest, size - begin) + 1):
            fits = np.searchsorted(start, size - begin - length, side="right")
            start, word, node = start[:fits], word[:fits], node[:fits]
            node = self.step(node, letters[start + (begin + length - 1), word])
            lives = np.flatnonzero(node >= 0)
            start, word, node = start[lives], word[lives], node[lives]
            if not len(word):
                break
            of_length = np.full((width, count), -1, np.int32)
            of_length[start, word] = self.piece_of[node]
            found.append(of_length)
        return np.stack(found) if found else np.full((1, width, count), -1, np.int32)


def log_sum(rows: np.ndarray) -> np.ndarray:
    """log of the sum of exponentials over the first axis, whose first row is finite."""
    most = rows.max(0)
    return most + np.log(np.exp(rows - most).sum(0))


class Lattice:
    """The lattices of words of equal length, ``letters[place, word]``, under the log ``weights`` of bytes and pieces."""

    def __init__(self, pieces: Pieces, letters: np.ndarray, weights: np.ndarray):
        self.pieces, self.letters = pieces, letters
        self.size, self.count = letters.shape
        # Place -1, no piece, weighs nothing.
        self.weights = np.append(weights, -np.inf)
        distinct, which = np.unique(letters, return_inverse=True)
        self.which = which.reshape(letters.shape)
        self.utf8 = [np.frombuffer(chr(c).encode(), np.uint8) for c in distinct]
        self.spelled = np.array([weights[u].sum() for u in self.utf8])
        # Positions in slices, so that a word of any length needs bounded memory besides its sums.
        width = max(1, CELLS // (max(1, pieces.longest) * self.count))
        self.slices = [(b, min(b + width, self.size)) for b in range(0, self.size, width)]

    def forward(self) -> np.ndarray:
        """``[place, word]``: log of the summed weight of all segmentations of the first ``place`` letters."""
        sums = np.zeros((self.size + 1, self.count))
        for begin, end in self.slices:
            low = max(0, begin + 1 - self.pieces.longest)
            weights = self.weights[self.pieces.arcs(self.letters, low, end)]
            for stop in range(begin + 1, end + 1):
                into = [sums[stop - 1] + self.spelled[self.which[stop - 1]]]
                for length in range(1, min(len(weights), stop) + 1):
                    into.append(sums[stop - length] + weights[length - 1, stop - length - low])
                sums[stop] = log_sum(np.array(into))
        return sums

    def expected(self, times: np.ndarray) -> np.ndarray:
        """How often bytes and pieces occur, over all segmentations by their probability, each word ``times`` over."""
        sums, counts = self.forward(), np.zeros(len(self.weights))
        back, whole = np.zeros((self.size + 1, self.count)), sums[self.size]
        spelled_by = np.zeros(len(self.utf8))
        for begin, end in reversed(self.slices):
            arcs = self.pieces.arcs(self.letters, begin, end)
            weights = self.weights[arcs]
            shares = np.zeros(arcs.shape)
            for start in range(end - 1, begin - 1, -1):
                lengths = min(len(arcs), self.size - start)
                out = np.empty((lengths + 1, self.count))
                out[0] = self.spelled[self.which[start]] + back[start + 1]
                out[1:] = weights[:lengths, start - begin] + back[start + 1 : start + 1 + lengths]
                back[start] = log_sum(out)
                part = np.exp(out + (sums[start] - whole)) * times
                spelled_by += np.bincount(self.which[start], part[0], len(spelled_by))
                shares[:lengths, start - begin] = part[1:]
            counts += np.bincount(arcs.ravel() % len(counts), shares.ravel(), len(counts))
        for utf8, by in zip(self.utf8, spelled_by):
            np.add.at(counts, utf8, by)
        return counts[:-1]


def by_length(words: list[str], pieces: Pieces):
    """Blocks of words of equal length: their places in the list and their letters."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    edges = np.flatnonzero(np.diff(sizes[order], prepend=-1, append=-1))
    for low, high in zip(edges[:-1], edges[1:]):
        size = int(sizes[order[low]])
        step = max(1, CELLS // (max(1, pieces.longest) * max(1, size)))
        for at in range(low, high, step):
            some = order[at : min(at + step, high)]
            text = "".join([words[i] for i in some])
            letters = np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(some), size)
            yield some, np.ascontiguousarray(letters.T.astype(np.int64))


def log_probabilities(words: list[str], pieces: Pieces, weights: np.ndarray) -> np.ndarray:
    """Natural log of each word's probability over all its segmentations."""
    found = np.zeros(len(words))
    for some, letters in by_length(words, pieces):
        found[some] = Lattice(pieces, letters, weights).forward()[-1]
    return found


def expected_counts(words: list[str], times: np.ndarray, pieces: Pieces, weights: np.ndarray) -> np.ndarray:
    """Expected occurrences of bytes and pieces in words that occur ``times`` each."""
    counts = np.zeros(len(weights))
    for some, letters in by_length(words, pieces):
        counts += Lattice(pieces, letters, weights).expected(times[some])
    return counts
