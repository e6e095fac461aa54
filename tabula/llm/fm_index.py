"""A compressed FM-index over word sequences, searched for many streams at once.

The pieces (sequences of word numbers from 1) stand one after another, each
closed by a terminator of its own that sorts before every word. The suffix
array comes from prefix doubling; the Burrows-Wheeler transform is held as a
wavelet matrix: one bit vector per bit of the word number, packed 64 bits to
a word with the counts before each. Only the transform, the counts and, for
the depths up to the threshold, the borders of suffixes that share a prefix
are kept.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """Packed bits with rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        own = np.packbits(bits, bitorder="little")
        packed[:len(own)] = own
        self.words = packed.view("<u8")
        counts = np.bitwise_count(self.words)
        self.before = np.concatenate([[0], np.cumsum(counts[:-1], dtype=np.int64)])
        self.zeros = len(bits) - int(counts.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones in front of every place."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Rank of symbols in a sequence, bit by bit from the highest."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = []
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bits = ((symbols >> shift) & 1).astype(bool)
            self.levels.append((shift, Bits(bits)))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        self.start = self._walk(np.arange(size), np.zeros(size, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> shift) & 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in front of its place."""
        return self._walk(symbol, at) - self.start[symbol]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; all symbols that close a piece differ."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if rank[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Index of ``pieces``; matches are followed up to ``depth`` words."""

    def __init__(self, words: np.ndarray, cuts: np.ndarray, size: int, depth: int):
        """``words``: numbers 1..size-1 of all pieces, ``cuts``: n + 1 borders."""
        pieces = len(cuts) - 1
        ends = cuts[1:] + np.arange(pieces)  # where the terminators stand
        text = np.zeros(len(words) + pieces, np.int64)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = words
        distinct = text + pieces
        distinct[ends] = np.arange(pieces)
        self.order = suffix_order(distinct)
        self.n, self.depth = len(text), depth
        counts = np.bincount(text, minlength=size)
        self.first = np.cumsum(counts) - counts
        self.ranks = WaveletMatrix(text[self.order - 1], size)
        #: borders[d]: where suffixes start to differ from the one before in their first d words
        self.borders = [np.array([0, self.n])]
        alike = np.ones(self.n, bool)
        alike[0] = False
        padded = np.concatenate([text, np.zeros(depth, np.int64)])
        for d in range(depth):
            own = padded[self.order + d]
            alike[1:] &= (own[1:] == own[:-1]) & (own[1:] > 0)
            self.borders.append(np.append(np.flatnonzero(~alike), self.n))

    def group(self, at: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that share their first d words with the one at ``at``."""
        border = self.borders[d]
        k = np.searchsorted(border, at, "right") - 1
        return border[k], border[k + 1]

    def matching_statistics(self, words: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every word of the streams: the length of the longest match that
        starts there (up to ``depth``), and a place in the suffix order of it.

        Backward search, all streams side by side from their ends. A word that
        cannot be put in front of the match shortens it from its far end, one
        word at a time, to the suffixes that share what is left. Words that
        the index does not know have number 0.
        """
        count = len(cuts) - 1
        length = np.zeros(len(words), np.int64)
        where = np.zeros(len(words), np.int64)
        low, high = np.zeros(count, np.int64), np.full(count, self.n)
        depth = np.zeros(count, np.int64)
        sizes = np.diff(cuts)
        by_size = np.argsort(-sizes, kind="stable")
        live = np.searchsorted(-sizes[by_size], -np.arange(int(sizes.max(initial=0))), "left")
        for step, n in enumerate(live):
            open_ = by_size[:n]
            at = cuts[open_ + 1] - 1 - step
            word = words[at]
            full = open_[depth[open_] == self.depth]
            low[full], high[full] = self.group(low[full], self.depth - 1)
            depth[full] -= 1
            while len(open_):
                both = self.ranks.rank(np.tile(word, 2), np.concatenate([low[open_], high[open_]]))
                a, b = both[:len(open_)] + self.first[word], both[len(open_):] + self.first[word]
                hit = (a < b) & (word > 0)
                done = open_[hit]
                low[done], high[done] = a[hit], b[hit]
                depth[done] += 1
                open_, word = open_[~hit], word[~hit]
                none = (depth[open_] == 0) | (word == 0)
                reset = open_[none]
                low[reset], high[reset], depth[reset] = 0, self.n, 0
                open_, word = open_[~none], word[~none]
                for d in np.unique(depth[open_]):
                    own = open_[depth[open_] == d]
                    low[own], high[own] = self.group(low[own], d - 1)
                depth[open_] -= 1
            active = by_size[:n]
            length[at], where[at] = depth[active], low[active]
        return length, where
