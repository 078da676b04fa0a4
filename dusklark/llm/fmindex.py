"""An FM-index over a sequence of small integers, in numpy.

The Burrows-Wheeler transform is kept in a wavelet matrix (one bit vector with prefix counts per bit of the symbol);
ranks in it drive backward search, for many patterns at once. Suffix positions are sampled at every ``STEP``-th text
position; the others are reached by walking backwards to a sample.
"""

from __future__ import annotations

import numpy as np

#: Smallest symbol, once, at the end of the text.
END = 0
STEP = 16


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the compared length until all ranks differ."""
    n = len(text)
    width = max(1, int(text.max()).bit_length())
    first = max(1, min(62 // width, 16))  # symbols that fit one key
    key = np.zeros(n, dtype=np.int64)
    for k in range(first):
        key <<= width
        if k < n:
            key[: n - k] |= text[k:].astype(np.int64)
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    done = first
    while True:
        sorted_key = key[order]
        rank[order] = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]]))
        if rank[order[-1]] == n - 1 or done >= n:
            return order
        key = rank * (n + 1)
        key[: n - done] += rank[done:] + 1
        order = np.argsort(key, kind="stable")
        done *= 2


class WaveletMatrix:
    """Rank and access over a sequence of integers below ``2 ** bits``."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.counts, self.zeros = bits, [], []
        v = values
        for b in reversed(range(bits)):
            bit = (v >> b) & 1
            self.counts.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(int(len(v) - bit.sum()))
            v = np.concatenate([v[bit == 0], v[bit == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        lo, hi = np.zeros(len(at), dtype=np.int64), at.astype(np.int64)
        for level, b in enumerate(reversed(range(self.bits))):
            ones = self.counts[level]
            one = ((symbols >> b) & 1).astype(bool)
            lo1, hi1 = ones[lo].astype(np.int64), ones[hi].astype(np.int64)
            lo = np.where(one, self.zeros[level] + lo1, lo - lo1)
            hi = np.where(one, self.zeros[level] + hi1, hi - hi1)
        return hi - lo

    def access_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before it."""
        lo, hi = np.zeros(len(at), dtype=np.int64), at.astype(np.int64)
        symbol = np.zeros(len(at), dtype=np.int64)
        for level in range(self.bits):
            ones = self.counts[level]
            lo1, hi1 = ones[lo].astype(np.int64), ones[hi].astype(np.int64)
            one = (ones[hi + 1] - ones[hi]).astype(bool)
            symbol = symbol * 2 + one
            lo = np.where(one, self.zeros[level] + lo1, lo - lo1)
            hi = np.where(one, self.zeros[level] + hi1, hi - hi1)
        return symbol, hi - lo


class FMIndex:
    """Index of ``text`` (symbols of 1 and more); an end mark is added."""

    def __init__(self, text: np.ndarray, symbols: int):
        text = np.append(text, END).astype(np.int64)
        order = suffix_array(text)
        self.tree = WaveletMatrix(text[order - 1], max(1, int(symbols - 1).bit_length()))
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))]).astype(np.int64)
        sampled = order % STEP == 0
        self.slots = np.concatenate([[0], np.cumsum(sampled, dtype=np.int32)])
        self.sampled, self.samples = sampled, order[sampled]
        self.size = len(text)

    def intervals(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffix order that begin with each pattern, as half-open intervals.

        patterns: one row each, aligned to the right (the last symbol in the last column).
        """
        count, width = patterns.shape
        lo, hi = np.zeros(count, dtype=np.int64), np.full(count, self.size, dtype=np.int64)
        live = np.flatnonzero(lengths > 0)
        lo[lengths == 0] = hi[lengths == 0] = 0
        for step in range(width):
            act = live[(lengths[live] > step) & (hi[live] > lo[live])]
            if len(act) == 0:
                break
            s = patterns[act, width - 1 - step]
            both = self.tree.rank(np.concatenate([s, s]), np.concatenate([lo[act], hi[act]]))
            lo[act] = self.starts[s] + both[: len(act)]
            hi[act] = self.starts[s] + both[len(act) :]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix order."""
        at, moved = rows.astype(np.int64).copy(), np.zeros(len(rows), dtype=np.int64)
        out = np.full(len(rows), -1, dtype=np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            here = at[open_]
            hit = self.sampled[here]
            out[open_[hit]] = self.samples[self.slots[here[hit]]] + moved[open_[hit]]
            open_ = open_[~hit]
            if len(open_):
                symbol, before = self.tree.access_rank(at[open_])
                at[open_] = self.starts[symbol] + before
                moved[open_] += 1
        return out
