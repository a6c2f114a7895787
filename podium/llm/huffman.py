"""Canonical length-limited Huffman codes over token ids: code lengths, block encoder and table-driven decoder (numpy).

A code is stored as its lengths alone.  Blocks are decoded on their own: every
``STEP`` ids a checkpoint keeps the bit offset, and all checkpoints of a block
are decoded side by side, one table look-up per id.
"""

from __future__ import annotations

import numpy as np

#: longest code in bits (more only if the number of distinct ids needs it); the decoding table has 2^LIMIT entries
LIMIT = 16
STEP = 128


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 where the count is 0."""
    ids = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if not len(ids):
        return out
    if len(ids) == 1:
        out[ids] = 1
        return out
    limit = max(limit, int(len(ids) - 1).bit_length())
    ids = ids[np.argsort(counts[ids], kind="stable")]
    weight = counts[ids].astype(np.float64)
    # levels[k]: for each item in merged order, its single id or -1 for a package of the level below
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        merged = np.concatenate((weight, packages))
        kind = np.concatenate((np.arange(len(ids)), np.full(len(packages), -1)))
        order = np.argsort(merged, kind="stable")
        merged, kind = merged[order], kind[order]
        levels.append(kind)
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * (len(ids) - 1)
    length = np.zeros(len(ids), np.uint8)
    for kind in reversed(levels):
        taken = kind[:take]
        singles = taken[taken >= 0]
        length[singles] += 1
        take = 2 * (len(taken) - len(singles))
    out[ids] = length
    return out


class Code:
    """Codes and decoding table of the canonical code with the given lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.limit = max(int(lengths.max(initial=0)), 1)
        ids = np.flatnonzero(lengths)
        self.ids = ids[np.lexsort((ids, lengths[ids]))]  # by length, then id
        size = lengths[self.ids].astype(np.int64)
        span = 1 << (self.limit - size)
        start = np.concatenate(([0], np.cumsum(span)))
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[self.ids] = (start[:-1] >> (self.limit - size)).astype(np.uint64)
        table = np.zeros(1 << self.limit, np.int32)
        if len(ids):
            full = np.repeat(np.arange(len(self.ids)), span)
            table[: len(full)] = full
        self.table_id = self.ids[table].astype(np.uint32) if len(ids) else table.astype(np.uint32)
        self.table_len = lengths[self.table_id].astype(np.int64) if len(ids) else np.ones(len(table), np.int64)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits of the ids (padded to 4 bytes) and the bit offset of every ``STEP``-th."""
        size = self.lengths[ids].astype(np.int64)
        end = np.cumsum(size)
        at = end - size
        word, shift = at >> 5, (64 - size - (at & 31)).astype(np.uint64)
        value = self.codes[ids] << shift
        n = int((end[-1] + 31) >> 5) + 1
        # codes do not overlap, so sums of their bits are exact in 53 bits
        words = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n)
        words += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n + 1)[:n]
        return words.astype(np.uint32).astype(">u4").tobytes(), at[::STEP].astype(np.uint32)

    def decode(self, raw: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` ids of a block; lanes start at the checkpoints and take one id per step."""
        data = np.frombuffer(raw + b"\0" * 8, np.uint8).astype(np.uint64)
        window = np.zeros(len(data) - 5, np.uint64)
        for j in range(5):
            window = (window << np.uint64(8)) | data[j : len(data) - 5 + j]
        out = np.empty((STEP, len(checkpoints)), np.uint32)
        at = checkpoints.astype(np.int64)
        mask, top = np.uint64((1 << self.limit) - 1), 40 - self.limit
        last = len(window) - 1
        for i in range(min(STEP, n)):
            pos = np.minimum(at >> 3, last)  # lanes past the end run on and are cut below
            bits = (window[pos] >> (top - (at & 7)).astype(np.uint64)) & mask
            out[i] = self.table_id[bits]
            at += self.table_len[bits]
        return out.T.reshape(-1)[:n]
