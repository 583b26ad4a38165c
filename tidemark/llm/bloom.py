"""A Bloom filter of a fixed number of bits over long keys, built by Spark's bitmap aggregates and read in Python workers.

It has ``BITS`` / 8 bytes whatever the input, so it may be collected and broadcast. A fuller filter lets more keys pass that were
not put in; it never holds back one that was.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, HASHES = 1 << 27, 3
#: Bits in one row of ``bitmap_construct_agg``.
BLOCK_BITS = 32768


def build(places: DataFrame, column: str, bits: int) -> np.ndarray:
    """The bit array with the places in ``column`` set."""
    p = F.col(column) + 1  # Spark counts places in a bitmap from 1
    rows = places.groupBy(F.bitmap_bucket_number(p).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(p)).alias("bits"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in rows.toLocalIterator():  # bits / BLOCK_BITS rows at most
        start = (row["bucket"] - 1) * BLOCK_BITS // 8
        out[start : start + BLOCK_BITS // 8] = np.frombuffer(row["bits"], dtype=np.uint8)[: len(out) - start]
    return out


def test(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether each bit is set."""
    return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0


def _places(key: Column) -> Column:
    return F.explode(F.array(*(F.pmod(F.shiftrightunsigned(key, s), F.lit(BITS)) for s in range(0, 8 * HASHES, 8))))


def of_keys(keys: DataFrame, column: str) -> np.ndarray:
    """The filter of a column of well mixed longs."""
    return build(keys.select(_places(F.col(column)).alias("place")), "place", BITS)


def passes(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys may have been put in."""
    ok = np.ones(len(keys), dtype=bool)
    for shift in range(0, 8 * HASHES, 8):
        ok &= test(filter_, ((keys.view(np.uint64) >> np.uint64(shift)) % np.uint64(BITS)).astype(np.int64))
    return ok
