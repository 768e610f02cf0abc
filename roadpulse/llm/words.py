"""Words of whole Arrow text columns as numpy offsets and 64-bit hashes.

Texts are handled as UTF-8 bytes: both word classes used here treat every byte
of a non-ASCII character alike, so bytes and code points give the same words.
Equal words have equal hashes; where equality decides a result the bytes (or a
128-bit digest) are compared as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21

#: A-Z lower-cased, everything else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text: digits, letters, non-ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: `[^\x20\x09-\x0D]+`
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[0x20] = NOT_SPACE[0x09:0x0E] = False

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(CHUNK_BYTES, n)
        step = np.full(size, base, np.uint64)
        step[0] = 1
        _powers[base] = have = np.multiply.accumulate(step)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Murmur's 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Words:
    """Words of the documents ``lo`` to ``hi`` of a column."""
    lo: int
    hi: int
    data: np.ndarray    # bytes
    start: np.ndarray   # of each word, in data
    end: np.ndarray
    first: np.ndarray   # of each document, its first word; one more at the end

    def __len__(self) -> int:
        return len(self.start)

    @property
    def doc(self) -> np.ndarray:
        """Of each word, its document, counted from ``lo``."""
        return np.repeat(np.arange(self.hi - self.lo), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        if not len(self):
            return np.zeros(0, np.uint64)
        up, down = _power(_BASE, len(self.data)), _power(_INVERSE, len(self.data))
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:len(self.data)], out=total[1:])
        h = (total[self.end] - total[self.start]) * down[self.start]
        return mix(h + (self.end - self.start).astype(np.uint64))

    def text(self, word: int, n: int) -> bytes:
        """``n`` words from ``word`` on, joined by one space."""
        data = self.data
        return b" ".join(data[a:b].tobytes() for a, b in zip(self.start[word:word + n], self.end[word:word + n]))


def shingle_hashes(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of k words; runs that cross documents are in it, the caller leaves them out."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    n = len(h) - k + 1
    out = np.full(n, (k + seed * 1_000_003) & 0xFFFFFFFF, np.uint64)
    for j in range(k):
        out = (out + h[j:j + n]) * np.uint64(0xD6E8FEB86659FD93 + 2 * seed)
        out ^= out >> np.uint64(32)
    return mix(out)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without nulls, and the offset of each text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def spans(column: pa.Array, chunk: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of documents of about ``chunk`` bytes together: (lo, hi, their bytes, offsets in them)."""
    data, offsets = flat(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + chunk, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def words(column: pa.Array, kind: np.ndarray, lower: bool, chunk: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of a column without nulls, a bounded number of bytes (or one text) at a time."""
    for lo, hi, data, offsets in spans(column, chunk):
        data = LOWER[data] if lower else data
        inside = kind[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        yield Words(lo, hi, data, start, end, np.searchsorted(start, offsets))
