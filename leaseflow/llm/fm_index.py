"""An FM-index over sequences of words, in numpy.

Suffixes are sorted once; what stays is the Burrows-Wheeler transform as a wavelet matrix, one
packed bit vector with sampled ranks for each bit of a symbol, and a sample of the places. All
patterns are searched side by side, and rows found are located by walking back to a sample.
"""

from __future__ import annotations

import numpy as np

#: One place in so many is kept.
SAMPLE = 8


class Bits:
    """A packed bit vector with ranks."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([np.zeros(1, np.int32), np.cumsum(counts[:-1], dtype=np.int32)])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks of symbols 0..sigma-1 in a sequence."""

    def __init__(self, sequence: np.ndarray, sigma: int):
        self.levels: list[tuple[int, Bits, int]] = []
        rest = sequence
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bits = (rest >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bits), int(len(bits) - bits.sum())))
            rest = np.concatenate([rest[~bits], rest[bits]])
        # Where each symbol's places begin after the last level.
        self.begin = self._walk(np.arange(sigma), np.zeros(sigma, np.int64))

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where(symbols >> shift & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before the place beside it."""
        return self._walk(symbols, at) - self.begin[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before."""
        symbol = np.zeros(len(at), np.int64)
        for shift, bits, zeros in self.levels:
            ones = bits.ones(at)
            one = bits.ones(at + 1) > ones
            symbol |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones, at - ones)
        return symbol, at - self.begin[symbol]


class FMIndex:
    """Index of a text of symbols; 0 ends each of its parts, and the text.

    What is kept: the wavelet matrix of the transform, where each symbol begins, and for one
    place in ``sample`` (and each first place of a part) its place in the text.
    """

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        sigma = int(text.max()) + 1
        order = _suffix_order(text)
        self.size = len(text)
        self.matrix = WaveletMatrix(text[order - 1], sigma)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        ends = np.flatnonzero(text == 0)
        begins = np.concatenate([[0], ends[:-1] + 1])
        inside = np.arange(len(text)) - np.repeat(begins, np.diff(np.append(begins, len(text))))
        marked = (inside % sample == 0)[order]
        self.marks = Bits(marked)
        self.places = order[marked].astype(np.int32)

    def search(self, patterns: np.ndarray, alone: int = 1
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of (n, m) patterns: rows [low, high) and the matched length.

        The length is the matching statistic at the pattern's end, cut off at m: how many
        words before that end occur in the text. A search ends early once at most ``alone``
        rows are left (1: the pattern's own occurrence, for patterns taken from the text).
        """
        n = len(patterns)
        low, high = np.zeros(n, np.int64), np.full(n, self.size, np.int64)
        length = np.zeros(n, np.int64)
        live = np.arange(n)
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[live, k]
            base = self.smaller[c]
            a = base + self.matrix.rank(c, low[live])
            b = base + self.matrix.rank(c, high[live])
            low[live], high[live] = a, b
            length[live] += b > a
            live = live[b - a > alone]
            if not len(live):
                break
        return low, high, length

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place in the text of each row: steps back to a sampled place, counted."""
        at, steps = rows.astype(np.int64), np.zeros(len(rows), np.int64)
        place = np.empty(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            here = at[live]
            number = self.marks.ones(here)
            done = self.marks.ones(here + 1) > number
            place[live[done]] = self.places[number[done]] + steps[live[done]]
            live, here = live[~done], here[~done]
            symbol, before = self.matrix.access(here)
            at[live] = self.smaller[symbol] + before
            steps[live] += 1
        return place


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Places by the text that follows them, by doubling; ends of parts are ordered by place,
    so no suffix is compared beyond its part and all differ."""
    ends = np.flatnonzero(text == 0)
    rank = text + len(ends) - 1
    rank[ends] = np.arange(len(ends))
    have, kinds = 1, 0
    while True:
        order = np.argsort(rank, kind="stable")
        ordered = rank[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        kinds = int(new[-1]) + 1
        if kinds == len(text):
            return order
        rank = np.empty_like(rank)
        rank[order] = new
        after = np.zeros_like(rank)
        after[:-have] = rank[have:]
        rank = rank * kinds + after
        have *= 2
