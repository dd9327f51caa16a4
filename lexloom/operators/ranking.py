"""Ranks, running sums and neighbours over a whole table, without a task that holds all of it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows to a range, and the most ranges: their edges and counts are literals and rows of a driver-sized table.
RANGE_ROWS, MOST_RANGES = 100_000, 512


def ranged(df: DataFrame, keys: list[Column], block: str = "block") -> DataFrame:
    """df with `block`: the number of the range that a row's keys (never null) fall into; ranges ascend, as keys do. A
    sample of bounded size tells the edges; it decides only how even the ranges are."""
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    n = df.count()
    ranges = min(MOST_RANGES, n // RANGE_ROWS + 1)
    if ranges == 1:
        return df.withColumn(block, F.lit(0))
    some = sorted(tuple(r[0]) for r in df.select(key.alias("k")).sample(min(1.0, 60.0 * ranges / n), seed=1).limit(100 * ranges).collect())
    edges = sorted({some[len(some) * i // ranges] for i in range(1, ranges)}) if some else []
    if not edges:
        return df.withColumn(block, F.lit(0))
    kinds = [f.dataType for f in df.select(key.alias("k")).schema["k"].dataType]
    literal = lambda e: F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(e, kinds, strict=True))])
    step = math.isqrt(len(edges)) + 1
    coarse, fine = F.array(*[literal(e) for e in edges[::step]]), F.array(*[literal(e) for e in edges])
    rows = df.withColumn("__key", key)
    upto = lambda table: F.size(F.filter(table, lambda e: e <= F.col("__key")))
    low = (upto(coarse) - 1) * step
    return rows.withColumn(block, F.when(low < 0, 0).otherwise(low + upto(F.slice(fine, F.greatest(low, F.lit(0)) + 1, step)))).drop("__key")


def with_totals(df: DataFrame, keys: list[Column], rank: str = "rank", sums: dict[str, str] | None = None) -> DataFrame:
    """df with `rank` (from 1) in ascending order of keys (never null) and, for each name -> column of `sums`, the running
    sum up to the row. Rows are numbered within ranges of the keys; a range starts after what the ranges before it hold."""
    sums, block = sums or {}, "__block"
    rows = ranged(df, keys, block)
    totals = rows.groupBy(block).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s_{name}") for name, c in sums.items()])
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)  # over at most MOST_RANGES rows
    starts = totals.select(F.col(block).alias("__start"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__n"), *[F.coalesce(F.sum(f"s_{name}").over(before), F.lit(0)).alias(f"__s_{name}") for name in sums])
    inside = Window.partitionBy(block).orderBy(*keys)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    for name, c in sums.items():
        rows = rows.withColumn(name, F.sum(c).over(upto))
    out = rows.withColumn(rank, F.row_number().over(inside)).join(F.broadcast(starts), F.col(block) == F.col("__start"))
    out = out.withColumn(rank, F.col(rank) + F.col("__n"))
    for name in sums:
        out = out.withColumn(name, F.col(name) + F.col(f"__s_{name}"))
    return out.drop(block, "__start", "__n", *[f"__s_{name}" for name in sums])
