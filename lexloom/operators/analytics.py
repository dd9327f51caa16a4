"""Small statistics on count tables: distances, scaling, clusters, projections."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assembled(df: DataFrame, columns: list[str], center: bool = False) -> DataFrame:
    if center:
        means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
        df = df.select(*[c for c in df.columns if c not in columns], *[(F.col(c) - float(means[c] or 0)).alias(c) for c in columns])
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df)


def clusters(df: DataFrame, columns: list[str], k: int = 4, seed: int = 42) -> DataFrame:
    """df with cluster; numbers are arbitrary."""
    rows = assembled(df, columns)
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(rows).transform(rows).drop("features")


def projected(df: DataFrame, columns: list[str], k: int = 2) -> DataFrame:
    """df with pc1 .. pck of the centred columns."""
    rows = assembled(df, columns, center=True)
    out = PCA(k=k, inputCol="features", outputCol="pc").fit(rows).transform(rows).withColumn("pc", vector_to_array("pc"))
    return out.select(*[c for c in df.columns if c not in columns], *[F.col("pc")[i].alias(f"pc{i + 1}") for i in range(k)])


def column_distances(df: DataFrame, columns: list[str]) -> DataFrame:
    """a, b, distance: Euclidean distances of columns, all pairs in one pass over the rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    sums = df.agg(*[F.sqrt(F.sum(F.pow(F.col(a) - F.col(b), 2))).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    each = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.col(f"`{i}`"), 6).alias("distance")) for i, (a, b) in enumerate(pairs)])
    return sums.select(F.explode(each).alias("p")).select("p.*")


def classical_scaling(distances: DataFrame, k: int = 2) -> dict[str, list[float]]:
    """Coordinates of the few columns of column_distances(), on the driver."""
    rows = distances.collect()
    names = sorted({x for r in rows for x in (r["a"], r["b"])})
    d = np.zeros((len(names), len(names)))
    for r in rows:
        i, j = names.index(r["a"]), names.index(r["b"])
        d[i, j] = d[j, i] = r["distance"]
    n = len(names)
    c = np.eye(n) - np.ones((n, n)) / n
    values, vectors = np.linalg.eigh(-0.5 * c @ (d**2) @ c)
    order = np.argsort(-values)[:k]
    at = vectors[:, order] * np.sqrt(np.maximum(values[order], 0))
    return {name: at[i].tolist() for i, name in enumerate(names)}


def scaled_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns scaled to 0 .. 1, the matrix behind a cluster map."""
    low = df.agg(*[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]).first()
    scale = lambda c: (F.col(c) - float(low[f"lo_{c}"])) / (float(low[f"hi_{c}"] - low[f"lo_{c}"]) or 1.0)
    return df.select(*[c for c in df.columns if c not in columns], *[scale(c).alias(c) for c in columns])


def average_linkage(distances: DataFrame) -> list[tuple[str, str, float]]:
    """The merges of a hierarchical clustering of few columns, on the driver."""
    rows = distances.collect()
    d = {frozenset((r["a"], r["b"])): r["distance"] for r in rows}
    groups = [frozenset([x]) for x in sorted({x for r in rows for x in (r["a"], r["b"])})]
    merges = []
    while len(groups) > 1:
        mean = lambda g, h: sum(d[frozenset((a, b))] for a in g for b in h) / (len(g) * len(h))
        far, i, j = min((mean(g, h), i, j) for i, g in enumerate(groups) for j, h in enumerate(groups) if i < j)
        merges.append(("+".join(sorted(groups[i])), "+".join(sorted(groups[j])), far))
        groups = [g for x, g in enumerate(groups) if x not in (i, j)] + [groups[i] | groups[j]]
    return merges
