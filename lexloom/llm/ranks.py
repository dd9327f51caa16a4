"""Ranks within groups of any size, without a task that holds a whole group."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm.tables import unused

#: Groups are counted on the driver: one row for each, at most so many.
MOST_GROUPS = 65_536


def rank_within(df: DataFrame, key: str, order: list[str], rank: str = "rank", block_rows: int | None = None, counts: dict | None = None) -> DataFrame:
    """Add `rank`: 0, 1, 2 ... within each value of `key` (never null), without gaps.

    A group is split into blocks of about `block_rows` rows by a hash of the order columns; rows are ranked inside a
    block, and each block starts after the counts of the blocks before it. So the largest task holds some blocks,
    however many rows one key has. Ranks follow (block, order), not `order` over the whole group. Rows that are
    equal in `order` may exchange ranks. Other columns stay, whatever they are called (an older `rank` is replaced). Empty input
    gives an empty result.
    """
    if counts is None:
        rows = df.groupBy(key).count().limit(MOST_GROUPS + 1).collect()
        if len(rows) > MOST_GROUPS:
            raise ValueError(f"more than {MOST_GROUPS} groups")
        counts = {r[0]: r[1] for r in rows}
    spark = df.sparkSession
    total = sum(counts.values())
    block_rows = block_rows or max(512, math.isqrt(total))
    kind = df.schema[key].dataType
    own, n, b, c, r, start = (unused(f"__{x}", df) for x in ("key", "n", "b", "c", "r", "start"))
    blocks = spark.createDataFrame([(k, math.ceil(m / block_rows)) for k, m in counts.items()], f"`{own}` {kind.simpleString()}, `{n}` long")
    salted = df.join(F.broadcast(blocks), F.col(key) == F.col(own)).drop(own)
    salted = salted.withColumn(b, F.pmod(F.xxhash64(F.lit(17), *order), F.col(n))).drop(n)
    sizes = salted.groupBy(key, b).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(key).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(key).alias(own), F.col(b).alias(c), F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    inside = Window.partitionBy(key, b).orderBy(*order)
    ranked = salted.withColumn(r, F.row_number().over(inside) - 1)
    return (
        ranked.join(starts, (F.col(key) == F.col(own)) & (F.col(b) == F.col(c)))
        .withColumn(rank, (F.col(start) + F.col(r)).cast("long"))
        .drop(own, b, c, r, start)
    )
