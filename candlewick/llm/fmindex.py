"""FM-index over integer sequences, in numpy: suffix order, wavelet matrix, sampled positions."""

from __future__ import annotations

import numpy as np

GAP = 0


class Bits:
    """A bit vector with rank: packed words and the ones before each word."""

    def __init__(self, flags: np.ndarray):
        packed = np.zeros((len(flags) // 64 + 1) * 8, np.uint8)
        small = np.packbits(flags, bitorder="little")
        packed[: len(small)] = small
        self.words = packed.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.ones = int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & low)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) > 0


class Wavelet:
    """Wavelet matrix: one bit vector for each bit of a symbol, values parted by the bits above."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.depth = max(1, (symbols - 1).bit_length())
        self.levels, self.zeros = [], []
        for bit in range(self.depth - 1, -1, -1):
            ones = (values >> bit) & 1 > 0
            self.levels.append(Bits(ones))
            self.zeros.append(len(values) - self.levels[-1].ones)
            values = np.concatenate([values[~ones], values[ones]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position i."""
        start, end = np.zeros(len(i), np.int64), i
        for level, zeros, bit in zip(self.levels, self.zeros, range(self.depth - 1, -1, -1), strict=True):
            one = (symbol >> bit) & 1 > 0
            s, e = level.rank(start), level.rank(end)
            start, end = np.where(one, zeros + s, start - s), np.where(one, zeros + e, end - e)
        return end - start

    def get(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and how often it occurs before it."""
        symbol, start = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        for level, zeros in zip(self.levels, self.zeros, strict=True):
            one = level.get(i)
            s, e = level.rank(start), level.rank(i)
            start, i = np.where(one, zeros + s, start - s), np.where(one, zeros + e, i - e)
            symbol = symbol * 2 + one
        return symbol, i - start


def suffix_order(text: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by prefix doubling.

    Gaps are all different and sort first, by position; so a suffix is compared up to its next
    gap only, and only groups that are still tied are sorted again.
    """
    n = len(text)
    rank = before[text].astype(np.int64)
    gaps = np.flatnonzero(text == GAP)
    rank[gaps] = np.arange(len(gaps))
    sizes = np.diff(np.append(before, n))
    tied, k = np.flatnonzero((text != GAP) & (sizes[text] > 1)), 1
    while len(tied):
        key = rank[tied] * n + rank[tied + k]
        order = np.argsort(key)
        tied, key = tied[order], key[order]
        old = rank[tied]
        at = np.arange(len(tied))
        fresh = np.ones(len(tied), bool)
        fresh[1:] = key[1:] != key[:-1]
        group = np.ones(len(tied), bool)
        group[1:] = old[1:] != old[:-1]
        rank[tied] = old + np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        alone = fresh & np.append(fresh[1:], True)
        tied, k = tied[~alone], 2 * k
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class FmIndex:
    """Count and locate patterns in a text of symbols ``1 ..`` with gaps (0) that match nothing.

    The text starts and ends with a gap. Positions are sampled at every ``sample``-th one and after
    each gap, because a walk backwards cannot cross a gap.
    """

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 8):
        counts = np.bincount(text, minlength=symbols)
        self.n, self.before = len(text), np.concatenate([[0], np.cumsum(counts)[:-1]])
        order = suffix_order(text, self.before)
        last = text[order - 1]
        self.wavelet = Wavelet(last.astype(np.int64), symbols)
        known = (order % sample == 0) | (last == GAP)
        self.known, self.samples = Bits(known), order[known]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges ``[low, high)`` of the suffixes that start with each pattern (one a row)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for step in range(patterns.shape[1]):
            live = np.flatnonzero((step < lengths) & (low < high))
            symbol = patterns[live, lengths[live] - 1 - step].astype(np.int64)
            found = self.wavelet.rank(np.tile(symbol, 2), np.concatenate([low[live], high[live]]))
            low[live], high[live] = self.before[symbol] + found[: len(live)], self.before[symbol] + found[len(live) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: walk back to a sampled one and count the steps."""
        out, at, walked = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(at):
            hit = self.known.get(rows)
            out[at[hit]] = self.samples[self.known.rank(rows[hit])] + walked
            at, rows, walked = at[~hit], rows[~hit], walked + 1
            if len(at):
                symbol, rank = self.wavelet.get(rows)
                rows = self.before[symbol] + rank
        return out
