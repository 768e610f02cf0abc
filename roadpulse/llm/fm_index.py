"""A compressed full-text index over word numbers: BWT in a wavelet matrix, searched backwards for many patterns at once."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``text``; 0 is a separator, smaller than all and different at every place."""
    n = len(text)
    apart = text == 0
    rank = np.where(apart, np.cumsum(apart), text.astype(np.int64) + int(apart.sum()))
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:]
        key = rank * (int(rank.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.append(0, np.cumsum(np.diff(key[order]) != 0)) + 1
        if int(new.max()) == n or step >= n:
            return order
        rank, step = new, step * 2


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        packed = np.append(packed, np.zeros(8 + -len(packed) % 8, np.uint8))
        self.words = packed.view(np.uint64)
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]).astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place ``i``."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class Wavelet:
    """Wavelet matrix of a sequence of small numbers."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels, self.zeros = [], []
        self.depth = max(1, int(symbols - 1).bit_length())
        for level in range(self.depth - 1, -1, -1):
            bits = (sequence >> level) & 1 == 1
            self.levels.append(Bits(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            sequence = np.concatenate([sequence[~bits], sequence[bits]])
        every = np.arange(symbols)
        self.first = self._down(every, np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for n, level in enumerate(range(self.depth - 1, -1, -1)):
            ones = self.levels[n].ones(i)
            i = np.where((symbol >> level) & 1 == 1, self.zeros[n] + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before place i."""
        return self._down(symbol, i) - self.first[symbol]


class FmIndex:
    """Index of ``text``, numbers from 1 on with 0 as separator."""

    def __init__(self, text: np.ndarray):
        symbols = int(text.max(initial=0)) + 1
        self.order = suffix_array(text)
        self.below = np.append(0, np.cumsum(np.bincount(text, minlength=symbols)))
        self.bwt = Wavelet(text[self.order - 1], symbols)

    def matching(self, text: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The suffix interval of text[start:start + length] for each start, by backward search.

        A pattern taken from the index itself occurs at least once; the search
        for one ends when its interval holds a single suffix, which is then its
        own, and (0, 0) stands for that.
        """
        lo, hi = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        live = np.arange(len(start))
        c = text[start + length - 1]
        a, b = self.below[c], self.below[c + 1]
        for back in range(length - 2, -1, -1):
            many = b - a > 1
            live, a, b = live[many], a[many], b[many]
            if not len(live):
                return lo, hi
            c = text[start[live] + back]
            base = self.below[c]
            a, b = base + self.bwt.rank(c, a), base + self.bwt.rank(c, b)
        many = b - a > 1
        lo[live[many]], hi[live[many]] = a[many], b[many]
        return lo, hi
