"""Connected components of an edge table by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.tables import discard, keep, resting


def components(edges: DataFrame, files: int | None = None, most_rounds: int = 60) -> DataFrame:
    """edges (a, b: long, never null) -> (node, component), the component being its smallest node. Nodes without an edge
    to another node aren't there. Rounds grow with the logarithm of the nodes; each round's edges are written, so no
    lineage grows, and the round before is deleted; only a count and a checksum come to the driver. Joins have one side of
    one row a node, so adaptive execution splits the edges of a hub; minima are combined before the shuffle."""
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e, seen = keep(e, "edges", files), None
    for _ in range(most_rounds):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        last, e = e, keep(small, "edges", files)
        discard(last)
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    out = e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    return resting(out, e)
