"""A Bloom filter of fixed size over 64-bit ids, counted on the cluster and held by every worker."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter: 2 MB, whatever goes in. Beyond some millions of ids it lets more and more through.
BLOOM = 1 << 24


def spots(c: Column) -> tuple[Column, Column]:
    """The two bits of an id, as columns."""
    return F.pmod(F.xxhash64(F.lit(1), c), F.lit(BLOOM)), F.pmod(F.xxhash64(F.lit(2), c), F.lit(BLOOM))


def filled(ids: DataFrame, column: str) -> np.ndarray:
    """The filter of all ids in a column, as words of 64 bits; at most BLOOM / 64 rows come to the driver."""
    bits = ids.select(F.explode(F.array(*spots(F.col(column)))).alias("x")).select(F.shiftright("x", 6).alias("w"), F.expr("shiftleft(1L, cast(x % 64 as int))").alias("b"))
    found = bits.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    words = np.zeros(BLOOM // 64, np.int64)
    words[found.column("w").to_numpy()] = found.column("b").to_numpy()
    return words.view(np.uint64)


def has(words: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether ids with the bits x and y can be in the filter."""
    bit = lambda z: words[z >> 6] >> (z & 63).astype(np.uint64)
    return (bit(x) & bit(y) & np.uint64(1)).astype(bool)
