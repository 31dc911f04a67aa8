"""A Bloom filter of a fixed size over 64-bit hashes.

It only spares a shuffle the rows that cannot match; the join that follows
decides. Its size does not grow with the data, so it may be broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _places(h: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for k in range(2):
        yield h >> np.uint64(32 * k) & np.uint64(bits - 1)


def build(df: DataFrame, column: str, bits: int) -> bytes:
    """The filter of a column of hashes; ``bits`` is a power of two up to 2^32.
    Tasks fill partial filters, which are or-ed by 64-bit word, so the driver
    gets at most ``bits / 64`` words."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(bits, bool)
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for place in _places(h, bits):
                flags[place.astype(np.int64)] = True
        words = np.packbits(flags, bitorder="little").view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(words[at])], ["at", "word"])

    merged = df.select(column).mapInArrow(fill, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word"))
    words = np.zeros(bits // 64, np.int64)
    got = merged.toArrow()
    words[got.column("at").to_numpy()] = got.column("word").to_numpy()
    return words.tobytes()


def may_hold(flags: bytes, h: np.ndarray) -> np.ndarray:
    """Which of the unsigned hashes may be in the filter."""
    cells = np.frombuffer(flags, np.uint8)
    hit = np.ones(len(h), bool)
    for place in _places(h, 8 * len(cells)):
        hit &= (cells[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return hit


def prefilter(df: DataFrame, column: str, flags: bytes, may: bool = True) -> DataFrame:
    """The rows of ``df`` whose hash may be in the filter, or, with ``may``
    false, the others: those that are surely not in it."""
    shared = df.sparkSession.sparkContext.broadcast(flags)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(column).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(may_hold(shared.value, h) == may))

    return df.mapInArrow(keep, df.schema)


def bits_for(rows: int, most: int = 1 << 28) -> int:
    """Bits of a filter of so many hashes: 16 for each, up to 2^28 (32 MB).
    Beyond that it lets through more rows that do not match."""
    return min(most, 1 << max(16, (16 * rows).bit_length()))
