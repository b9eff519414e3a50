"""A Bloom filter of 64-bit hashes, made by Spark and asked by numpy: what it holds back never leaves a task.

It only saves traffic: a join decides what passes. It has ``BITS_A_HASH`` bits for each hash as a power of two, up to
``MOST_BITS`` (16 MB, which bounds its broadcast); beyond that it lets more through, never less."""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_A_HASH, LEAST_BITS, MOST_BITS = 12, 1 << 16, 1 << 27
_SHIFTS = (0, 18, 36)


def bloom_filter(hashes: DataFrame, column: str, count: int) -> np.ndarray:
    """The filter of ``count`` hashes (bigint): bits in 64-bit words. The driver receives the words that are set."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_HASH * count - 1).bit_length()))
    places = F.array(*[F.shiftrightunsigned(F.col(column), s).bitwiseAND(F.lit(bits - 1)) for s in _SHIFTS])
    words = (hashes.select(F.explode(places).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("mask")).toArrow())
    out = np.zeros(bits // 64, np.uint64)
    out[words["word"].to_numpy()] = words["mask"].to_numpy().view(np.uint64)
    return out


def held(bloom: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) the filter may hold."""
    mask = np.uint64(len(bloom) * 64 - 1)
    out = np.ones(len(hashes), bool)
    for s in _SHIFTS:
        bit = (hashes >> np.uint64(s)) & mask
        out &= (bloom[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out
