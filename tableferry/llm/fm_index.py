"""A compressed full-text index over a sequence of small integers, searched for many patterns at once.

The sequence's Burrows-Wheeler transform is held as a wavelet matrix: one packed bit vector per bit of
the symbols, with a count per 64 bits. Suffixes are ordered by their first ``depth`` symbols, which is
all that backward search needs for patterns up to that length.
"""

from __future__ import annotations

import numpy as np


def _ranked(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    new = np.zeros(len(keys), np.int64)
    new[order[1:]] = keys[order[1:]] != keys[order[:-1]]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new[order])
    return rank


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions by the first ``depth`` symbols at least, by doubling the compared length."""
    rank, length = text.astype(np.int64), 1
    while length < depth:
        far = np.zeros(len(rank), np.int64)
        far[:-length] = rank[length:] + 1
        rank = _ranked(rank * (int(far.max()) + 1) + far)
        length *= 2
        if length >= len(rank):
            break
    return np.argsort(rank, kind="stable")


class BitRank:
    """Bits in 64-bit words, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words)[:-1], out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Number of ones before each position."""
        w = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)


class FMIndex:
    def __init__(self, text: np.ndarray, depth: int):
        """``text``: symbols from 0 up; ``depth``: length of the longest pattern."""
        self.depth, self.n = depth, len(text)
        self.order = suffix_order(text, depth)
        self.count = np.concatenate(([0], np.cumsum(np.bincount(text))))
        last = text[self.order - 1]
        self.levels: list[tuple[BitRank, int]] = []
        # Where each symbol's own stretch of the last level begins.
        start = np.zeros(len(self.count) - 1, np.int64)
        symbols = np.arange(len(start))
        for bit in range(max(1, int(text.max()).bit_length()) - 1, -1, -1):
            ones = (last >> bit & 1).astype(np.uint8)
            rank, zeros = BitRank(ones), int(len(ones) - ones.sum())
            self.levels.append((rank, zeros))
            r = rank.ones(start)
            start = np.where(symbols >> bit & 1, zeros + r, start - r)
            last = np.concatenate((last[ones == 0], last[ones == 1]))
        self.start = start

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position in the transform."""
        bit = len(self.levels)
        pos = at
        for rank, zeros in self.levels:
            bit -= 1
            r = rank.ones(pos)
            pos = np.where(symbol >> bit & 1, zeros + r, pos - r)
        return pos - self.start[symbol]

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that begin with a symbol and go on as those of [low, high)."""
        base = self.count[symbol]
        both = self.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        return base + both[: len(low)], base + both[len(low) :]

    def matches(self, text: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the windows text[at : at + length] occur twice or more, and their suffix intervals.

        All windows are extended to the left in step; one whose interval holds fewer than two
        suffixes is given up, as its match is shorter than the window (or its own).
        """
        alive = np.arange(len(at))
        last = text[at + length - 1]
        low, high = self.count[last], self.count[last + 1]
        for k in range(length - 2, -1, -1):
            more = high - low > 1
            alive, low, high = alive[more], low[more], high[more]
            if not len(alive):
                break
            low, high = self.step(text[at[alive] + k], low, high)
        more = high - low > 1
        return alive[more], low[more], high[more]
