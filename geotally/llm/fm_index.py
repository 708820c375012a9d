"""A full-text index over integer sequences: suffix order, Burrows-Wheeler transform, wavelet matrix, sampled positions.

Symbol 0 separates pieces of text; it never matches, and each separator counts as a symbol of its own.
All searches are vectorised over the patterns.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions in the lexical order of their suffixes, by prefix doubling; separators sort by position."""
    n = len(text)
    zero = text == 0
    zeros = int(zero.sum())
    rank = np.where(zero, np.cumsum(zero) - 1, text.astype(np.int64) + zeros)
    k = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:] + 1
        key = rank * (n + int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        in_order = key[order]
        fresh = np.concatenate(([0], (in_order[1:] != in_order[:-1]).cumsum()))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1 or k >= n:
            return order
        k *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit plane a level, with prefix counts of zeros."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels = max(1, int(largest).bit_length())
        self.zeros_before, self.zeros = [], []
        now = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (now >> level) & 1
            before = np.zeros(len(now) + 1, np.int32)
            np.cumsum(1 - bit, out=before[1:])
            self.zeros_before.append(before)
            self.zeros.append(int(before[-1]))
            now = np.concatenate((now[bit == 0], now[bit == 1]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often ``symbol[q]`` stands in the first ``end[q]`` places."""
        start, end = np.zeros(len(end), np.int64), end.astype(np.int64)
        for i in range(self.levels):
            bit = (symbol >> (self.levels - 1 - i)) & 1
            before, zeros = self.zeros_before[i], self.zeros[i]
            a, b = before[start], before[end]
            start = np.where(bit == 1, zeros + start - a, a)
            end = np.where(bit == 1, zeros + end - b, b)
        return end - start


class FMIndex:
    """Index of ``text`` (must end in 0) over the symbols 0..``largest``."""

    def __init__(self, text: np.ndarray, largest: int):
        order = suffix_order(text)
        self.bwt = text[order - 1]
        self.first = np.concatenate(([0], np.bincount(text, minlength=largest + 1).cumsum()))
        self.ranks = WaveletMatrix(self.bwt, largest)
        # A walk back from any match meets a sampled position before it would cross a separator.
        sampled = (order % SAMPLE == 0) | (self.bwt == 0)
        self.sampled = sampled
        self.sample_no = np.cumsum(sampled) - 1
        self.samples = order[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of the patterns (rows padded on the right); an empty range means no occurrence."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), len(self.bwt), np.int64)
        for step in range(int(lengths.max(initial=0))):
            live = np.nonzero((lengths > step) & (lo < hi))[0]
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - 1 - step]
            lo[live] = self.first[symbol] + self.ranks.rank(symbol, lo[live])
            hi[live] = self.first[symbol] + self.ranks.rank(symbol, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes at ``rows``."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        away = np.nonzero(~self.sampled[rows])[0]
        while len(away):
            symbol = self.bwt[rows[away]]
            rows[away] = self.first[symbol] + self.ranks.rank(symbol, rows[away])
            steps[away] += 1
            away = away[~self.sampled[rows[away]]]
        return self.samples[self.sample_no[rows]] + steps
