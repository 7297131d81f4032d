"""Words and word n-grams of Arrow text columns, worked out over whole byte buffers with numpy.

A word is a longest run of bytes other than U+0020 and U+0009 to U+000D. Nothing is cut off: a text
longer than a slice makes a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# Odd factors of the words of an n-gram, by position.
_PLACES = np.random.default_rng(7).integers(1 << 62, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

SLICE_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BACK)):
            all_of = np.full(max(n, SLICE_BYTES), base, np.uint64)
            all_of[0] = 1
            _powers[k] = np.cumprod(all_of, dtype=np.uint64)
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of the texts of a slice: byte spans, the row of each, and each row's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word, the same wherever the word stands."""
        n = len(self.data)
        up, down = _power(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        h = (total[self.ends] - total[self.starts]) * down[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def ngrams(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Start (word number) and hash of each run of n words within one text."""
        at = np.flatnonzero(np.arange(len(hashes)) + n <= self.first[self.rows + 1])
        return at, join_hashes([hashes[at + j] for j in range(n)])

    def text(self, a: int, b: int) -> bytes:
        """Bytes from word a to word b - 1, with the white space between them."""
        return self.data[self.starts[a] : self.ends[b - 1]].tobytes() if b > a else b""


def join_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of a sequence of word hashes; its length counts too."""
    out = np.full(len(parts[0]), len(parts) * 0x632BE59BD9B4E019 & (1 << 64) - 1, np.uint64)
    for j, part in enumerate(parts):
        out += part * _PLACES[j % 64]
    return mix(out)


def slices(texts: pa.Array, lower: bool = False, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Rows [a, b) and their words, for slices of about ``most`` bytes; null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        piece = data[offsets[a] : offsets[b]]
        yield a, b, split(_LOWER[piece] if lower else piece, offsets[a : b + 1] - offsets[a])
        a = b


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = space[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = space[1:]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return Words(data, starts, ends, rows, np.searchsorted(starts, offsets))
