"""Words and shingles of whole Arrow text columns, vectorised with numpy.

A column's characters lie in one buffer; words, their 64-bit hashes and the
hashes of runs of words are computed on slices of that buffer of about
``CHUNK`` bytes (a longer text is a slice of its own), so memory does not follow
the batch.  White space is the six ASCII characters, and only A-Z is lowered,
so bytes of UTF-8 can be looked at one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: letters, digits and anything beyond ASCII; the rest is punctuation
_SOLID = np.zeros(256, bool)
_SOLID[48:58] = _SOLID[65:91] = _SOLID[97:123] = _SOLID[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.cumprod(np.full(4096, _BASE, np.uint64))


def _power(n: int) -> np.ndarray:
    global _powers
    if n >= len(_powers):
        _powers = np.cumprod(np.full(2 * n, _BASE, np.uint64))
    return _powers


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of rows ``row0 ..``: byte bounds in ``data``, hashes, and each row's first word (one more at the end)."""

    row0: int
    data: np.ndarray
    row_at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words inside a row, and the word each starts with."""
        n = len(self.hash)
        if n < k:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        h = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            h = h * np.uint64(0xD6E8FEB86659FD93) + self.hash[j : n - k + 1 + j]
        last = np.repeat(self.first[1:], np.diff(self.first))[: n - k + 1] - k
        at = np.flatnonzero(np.arange(n - k + 1) <= last)
        return mix64(h[at] + np.uint64(k)), at


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, weight: np.ndarray | None) -> np.ndarray:
    """64-bit hash per word of its bytes; bytes of weight 0 (between words) do not count; None: all count."""
    if not len(start):
        return np.empty(0, np.uint64)
    a = int(start[0])
    stop = int(end[-1])
    span = np.diff(np.append(start, stop))
    at = np.arange(a, stop) - np.repeat(start, span)
    value = data[a:stop].astype(np.uint64) + np.uint64(1)
    if weight is not None:
        value *= weight[a:stop]
    h = np.add.reduceat(value * _power(int(span.max()))[at], start - a)
    return mix64(h + (end - start).astype(np.uint64))


def split_words(data: np.ndarray, row_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, its weight mask, and each row's first word."""
    solid = ~_SPACE[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[row_at] = True
    edge[n] = True
    opens = solid.copy()
    opens[1:] &= ~solid[:-1] | edge[1:n]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:] | edge[1:n]
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1, solid, np.searchsorted(start, row_at)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    return (np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)), offsets


def slices(column: pa.Array, chunk: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, row offsets in them) of consecutive rows."""
    data, offsets = buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + chunk, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(column: pa.Array, chunk: int = CHUNK, plain: bool = False) -> Iterator[Words]:
    """Words of a text column, lowered.  ``plain``: punctuation does not count, so words differ by letters and digits alone."""
    for lo, _, data, row_at in slices(column, chunk):
        low = _LOWER[data]
        start, end, solid, first = split_words(low, row_at)
        if plain:
            letters = _SOLID[low]
            if len(start):
                real = np.add.reduceat(letters, start, dtype=np.int64) > 0
                real_before = np.concatenate(([0], np.cumsum(real)))
                start, end, first = start[real], end[real], real_before[first]
            h = _plain_hash(low, start, end, letters)
        else:
            h = hash_words(low, start, end, solid.astype(np.uint64))
        yield Words(lo, low, row_at, start, end, h, first)


def _plain_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Hashes of the words without their punctuation."""
    at = np.flatnonzero(letters)
    new_start, new_end = np.searchsorted(at, start), np.searchsorted(at, end)
    packed = data[at]
    return hash_words(packed, new_start, new_end, np.ones(len(packed), np.uint64))
