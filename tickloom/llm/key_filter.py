"""Which keys of a DataFrame a later scan has to look at, told to it in one of two ways.

Up to `LIMIT_BITS / BITS_A_KEY` keys a bitmap is broadcast, of `WANTED` bits for each key or as many as the limit leaves. It may let a key pass
that is not there, never the reverse. Beyond that nothing is broadcast: the keys stay a DataFrame, and whoever scans meets them by a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for a key that a bitmap should have and must have, and bits of the largest one that is broadcast (8 MB).
WANTED, BITS_A_KEY, LIMIT_BITS = 128, 8, 1 << 26
#: Words of a bitmap that travel to the driver as one row.
SEGMENT = 4096


class Bitmap:
    """Bits of 64-bit keys, by their low bits: the size is a power of two."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(32 * len(words) - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys.view(np.uint64) & self.mask
        return (self.words[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1


class Listed:
    """Keys one by one."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys.view(np.uint64))

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        at = np.searchsorted(self.keys, keys.view(np.uint64))
        return self.keys[np.minimum(at, len(self.keys) - 1)] == keys.view(np.uint64)


def bits_for(n: int, each: int) -> int:
    """Bits of the bitmap of n keys: a power of two."""
    return max(32 * SEGMENT, 1 << max(0, n * each - 1).bit_length())


def bitmap_of(keys: DataFrame, n: int, always: bool = False) -> Bitmap | None:
    """The bitmap of the n values of the long column `key`, or None where it would be too large to broadcast (with `always` one of the largest size, that lets more pass).

    Words are combined by Spark; LIMIT_BITS / 32 / SEGMENT rows of 16 KB at most reach the driver.
    """
    if bits_for(n, BITS_A_KEY) > LIMIT_BITS and not always:
        return None
    bits = min(bits_for(n, WANTED), max(LIMIT_BITS, 32 * SEGMENT))
    at = F.col("key").bitwiseAND(F.lit(bits - 1))
    words = keys.where("key is not null").select(F.shiftright(at, 5).alias("word"), at.bitwiseAND(F.lit(31)).cast("int").alias("k")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, k)")).alias("b"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            word, b = (batch.column(c).to_numpy() for c in ("word", "b"))
            for s in np.unique(word // SEGMENT).tolist():
                own = word // SEGMENT == s
                held.setdefault(s, np.zeros(SEGMENT, np.uint32))[word[own] % SEGMENT] |= b[own].astype(np.uint32)
        if held:
            yield pa.RecordBatch.from_pydict({"s": pa.array(list(held), pa.int64()), "data": pa.array([x.tobytes() for x in held.values()], pa.binary())})

    out = np.zeros(bits // 32, np.uint32)
    packed = words.repartition(F.floor(F.col("word") / F.lit(SEGMENT))).mapInArrow(gather, "s long, data binary")
    for r in packed.collect():
        out[r["s"] * SEGMENT : (r["s"] + 1) * SEGMENT] |= np.frombuffer(r["data"], np.uint32)
    return Bitmap(out)
