"""Vectorised word splitting and hashing of a batch of texts (numpy).

A batch of Arrow strings is one byte buffer plus offsets; words, their hashes
and shingle hashes come from whole-buffer numpy operations, so the cost per
word is a few array steps instead of Python objects.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Powers kept for each base (4 MB).
_KEPT = 1 << 19


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The 64-bit finaliser of SplitMix64: spreads every input bit."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """The powers 0 to n - 1; those that a small slice of texts needs are kept."""
    if n <= _KEPT:
        return _kept_powers(base)[:n]
    return _made_powers(base, n)


def _made_powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & ((1 << 64) - 1), np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=4)
def _kept_powers(base: int) -> np.ndarray:
    out = _made_powers(base, _KEPT)
    out.flags.writeable = False
    return out


def slices(column: pa.Array, budget: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of the column with about ``budget`` bytes of text each; one
    longer text is a range of its own."""
    n = len(column)
    if not n:
        return
    offsets = text_buffer(column)[1]
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + budget, "right")) - 1
        end = min(n, max(at + 1, end))
        yield at, end
        at = end


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of the column and the n + 1 offsets (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    bufs, n, at = column.buffers(), len(column), column.offset
    offsets = np.frombuffer(bufs[1], np.int64)[at:at + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    data = data[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """The words of a range of texts: byte starts and ends, the text each is
    in, and ``first``: the index of every text's first word (n + 1 entries)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, n = data, offsets, len(data)
        space = _SPACE[data]
        before = np.ones(n, bool)
        before[1:] = space[:-1]
        inner = offsets[:-1][offsets[:-1] < n]
        before[inner] = True
        after = np.ones(n, bool)
        after[:-1] = space[1:]
        ends = offsets[1:][offsets[1:] > 0] - 1
        after[ends[ends < n]] = True
        word = ~space
        self.start = np.flatnonzero(word & before)
        self.end = np.flatnonzero(word & after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def hashes(self, data: np.ndarray | None = None, start=None, end=None) -> np.ndarray:
        """A 64-bit hash of each word's bytes (polynomial prefix sums, mixed)."""
        data = self.data if data is None else data
        start = self.start if start is None else start
        end = self.end if end is None else end
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=total[1:])
        raw = (total[end] - total[start]) * _powers(_INVERSE, len(data) + 1)[start]
        return mix(raw ^ (end - start).astype(np.uint64))


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def shingles(word: np.ndarray, size: int) -> np.ndarray:
    """Order-dependent hash of each run of ``size`` words; the caller leaves
    out runs that cross a text's end. Entry i starts at word i."""
    n = max(0, len(word) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + word[k:k + n]
    return mix(out)
