"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Words and runs of signs are tokens; tokens and pairs of neighbouring tokens are hashed into buckets, and a pair that the
text has had before goes to a bucket for its number of repeats. A target model is counted on labelled good documents, a
raw model on all documents; the target's counts are smoothed towards the raw model by as much as best predicts each
target document from the others. A document's log ratio is the sum over its n-grams. As n-grams of one document aren't
independent, the sum is tempered: it is divided by the standard deviation that sums of that many n-grams have among the
target's own documents, each held against the model without it. Weights are the exponentials. Adding Gumbel noise to
their logarithms and keeping the k largest draws k documents without replacement in proportion to the weights; k is a
parameter, or the number that rejection sampling by the same weights would accept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.shingles import hash_spans, mix
from lexloom.llm.tables import bound_batches, discard, keep, resting

#: Documented bound: labelled documents whose n-grams are the target.
EXAMPLES = 5000
BUCKETS, REPEATS = 16_384, 16
#: Weights of the raw model in the target's, as multiples of the target's n-grams, that are tried.
SMOOTH = tuple(2.0**e for e in range(-8, 13))
#: Rejection sampling accepts a document with the probability min(1, exp(SLACK) * weight): two standard deviations.
SLACK = 2.0

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_kind = np.full(256, 2, np.uint8)  # 0 space, 1 letters and digits (and all beyond ASCII), 2 signs
_kind[[0x20, *range(0x09, 0x0E)]] = 0
_kind[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def features(text: str | None) -> np.ndarray:
    """The bucket of each n-gram of the whole text, 0 .. BUCKETS + REPEATS - 1."""
    b = np.frombuffer((text or "").encode(), np.uint8)
    if not len(b):
        return np.zeros(0, np.int64)
    kind = _kind[b]
    cut = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(b)]])
    inside = kind[starts] > 0
    w = hash_spans(_lower[b], starts[inside], ends[inside])
    pairs = mix(w[:-1] * np.uint64(3) + (w[1:] ^ np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(pairs, kind="stable")
    ranked = pairs[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
    nth = np.arange(len(ranked)) - np.repeat(first, np.diff(np.concatenate([first, [len(ranked)]])))
    own = (ranked % np.uint64(BUCKETS)).astype(np.int64)
    again = BUCKETS + np.minimum(np.log2(np.maximum(nth, 1)).astype(np.int64), REPEATS - 1)
    return np.concatenate([(mix(w) % np.uint64(BUCKETS)).astype(np.int64), np.where(nth > 0, again, own)])


@dataclass(frozen=True)
class Model:
    ratio: np.ndarray  # log target / raw of each bucket
    apart: float  # variance, among target documents, of the mean log ratio of a document without end
    within: float  # what one n-gram adds to the variance of a sum

    def log_ratio(self, text: str | None) -> tuple[float, int]:
        """The sum of log ratios over n-grams, and their number. A text without tokens has ratio 0 and no n-grams."""
        f = features(text)
        return (float(self.ratio[f].sum()), len(f)) if len(f) else (0.0, 0)

    def log_weight(self, log_ratio: float, n: int) -> float:
        spread = n * self.within + float(n) ** 2 * self.apart
        return log_ratio / spread**0.5 if spread > 0 else 0.0


def spread(means: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """apart and within, fitted to mean ** 2 = apart + within / n by least squares, longer documents counting more."""
    if not len(n):
        return 0.0, 1.0
    side = np.sqrt(n)
    terms = np.stack([side, 1 / side], 1)
    apart, within = np.linalg.lstsq(terms, means**2 * side, rcond=None)[0]
    if apart <= 0:
        return 0.0, float((means**2 * n).mean())
    return (float(apart), float(within)) if within > 0 else (float((means**2).mean()), 0.0)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", examples: int = EXAMPLES) -> Model:
    """The models of docs: the target is at most `examples` documents labelled 1 (lowest hash first), the raw model all of
    docs. Null and empty texts count nothing; rows of one id and repeated rows count each; null ids and labels aren't
    targets; other columns aren't read. Without a target, or on an empty table, all weights are 1."""
    bound_batches(docs.sparkSession)
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).filter("k is not null and y = 1").select("k").distinct()
    chosen = keep(known.orderBy(F.xxhash64("k"), "k").limit(examples), "chosen", 2)  # at most `examples` rows
    marked = docs.select(F.col(key).alias("d"), F.col(text).alias("t")).join(F.broadcast(chosen), F.col("d") == F.col("k"), "left").select(F.col("k").isNotNull().alias("y"), "t")
    width = BUCKETS + REPEATS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, raw = np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                f = np.bincount(features(t.as_py()), minlength=width)
                raw += f
                if y:
                    target += f
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(target), pa.array(raw)], ["b", "target", "raw"])

    got = np.array([tuple(r) for r in marked.mapInArrow(count, "b int, target long, raw long").groupBy("b").agg(F.sum("target"), F.sum("raw")).collect()], np.int64).reshape(-1, 3)
    target, raw = np.zeros(width), np.ones(width)
    target[got[:, 0]] += got[:, 1]
    raw[got[:, 0]] += got[:, 2]
    raw /= raw.sum()
    total = target.sum()
    if not total:
        discard(chosen)
        return Model(np.zeros(width), 0.0, 1.0)
    shared = docs.sparkSession.sparkContext.broadcast((target, raw))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the mean log ratio of each target document under the other ones, for each smoothing
        target, raw = shared.value
        for batch in batches:
            n, means = [], []
            for t in batch.column(0):
                b, c = np.unique(features(t.as_py()), return_counts=True)
                if len(b):
                    n.append(int(c.sum()))
                    means.append([float((c * np.log((target[b] - c + s * total * raw[b]) / (total - n[-1] + s * total) / raw[b])).sum() / n[-1]) for s in SMOOTH])
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(means, pa.list_(pa.float64()))], ["n", "means"])

    rows = marked.filter("y").select("t").mapInArrow(alone, "n long, means array<double>").collect()  # the target's documents
    discard(chosen)
    n, means = np.array([r["n"] for r in rows], float), np.array([r["means"] for r in rows]).reshape(-1, len(SMOOTH))
    best = int(np.argmax(n @ means))
    weight = SMOOTH[best] * total
    return Model(np.log((target + weight * raw) / (total + weight) / raw), *spread(means[:, best], n))


def noise(key: Column, text: Column, seed: int = 10) -> Column:
    """Gumbel noise that key and text decide."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, text), 11).cast("double") + 0.5) * (2.0**-53)
    return -F.log(-F.log(u))


def with_weight(docs: DataFrame, model: Model, key: str, text: str, seed: int = 10) -> DataFrame:
    """key, log_ratio, ngrams, log_weight and gumbel_key for each row."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.log_ratio(t.as_py()) for t in batch.column(1)]
            weights = [shared.value.log_weight(x, n) for x, n in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in got], pa.float64()), pa.array([n for _, n in got], pa.int64()), pa.array(weights, pa.float64()), batch.column(2)], ["k", "log_ratio", "ngrams", "log_weight", "h"])

    rows = docs.select(F.col(key), F.col(text), noise(F.col(key), F.col(text), seed).alias("h"))
    out = rows.mapInArrow(run, f"k {kind}, log_ratio double, ngrams long, log_weight double, h double")
    return out.select(F.col("k").alias(key), "log_ratio", "ngrams", "log_weight", (F.col("log_weight") + F.col("h")).alias("gumbel_key"))


def kth_largest(rows: DataFrame, value: str, k: int, bins: int = 4096) -> float | None:
    """The k-th largest value, exactly: histograms of an ever narrower range; never more than `bins` rows are collected."""
    if k <= 0:
        return None
    low, high, n = rows.agg(F.min(value), F.max(value), F.count(value)).first()
    if n == 0 or k >= n:
        return low
    above, at = 0, F.col(value)
    for _ in range(40):
        if low == high:
            return low
        width = (high - low) / bins
        if width == 0.0:
            return low
        b = F.least(F.lit(bins - 1), F.floor((at - low) / width))
        part = rows.filter((at >= low) & (at <= high)).groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).collect()
        for r in sorted(part, key=lambda r: -r["b"]):
            if above + r["n"] >= k:
                if r["n"] == 1 or (r["lo"], r["hi"]) == (low, high) and len(part) == 1:
                    return r["lo"]
                low, high = r["lo"], r["hi"]
                break
            above += r["n"]
    return low


def resample(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", k: int | None = None, seed: int = 10) -> DataFrame:
    """key, log_ratio, ngrams, log_weight, gumbel_key and selected for every row: the k rows of largest gumbel_key. `k`
    defaults to the number of rows that rejection sampling by the same weights would accept, so it follows what docs
    holds; labels don't decide it. Null and empty texts and texts without tokens have no evidence either way: weight 1.
    Repeated rows have equal keys and share their fate, so ties at the border may add rows; other columns aren't read; an
    empty table gives an empty result."""
    rows = keep(with_weight(docs, model, key, text, seed), "weights")
    if k is None:
        k = round(rows.agg(F.sum(F.least(F.lit(1.0), F.exp(F.col("log_weight") + SLACK)))).first()[0] or 0.0)
    border = kth_largest(rows, "gumbel_key", k)
    chosen = F.col("gumbel_key") >= float(border) if border is not None else F.lit(False)
    return resting(rows.withColumn("selected", chosen), rows)


def keep_selected(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", k: int | None = None) -> DataFrame:
    """The rows of docs that resampling draws, with their columns as they are, whatever they are called: the border is
    found on the narrow table of keys, and each row's own key, computed again from its text, is held against it, so no
    text is shuffled. Null and empty texts and repeated rows: see resample; an empty table stays empty."""
    bound_batches(docs.sparkSession)
    rows = resample(docs, model, key, text, k)
    border = rows.filter("selected").agg(F.min("gumbel_key")).first()[0]
    discard(rows)
    if border is None:
        return docs.filter(F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def weight(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda t: shared.value.log_weight(*shared.value.log_ratio(t))).astype(float)

    own = F.pandas_udf(weight, "double")(F.coalesce(F.col(text), F.lit("")))
    return docs.filter(own + noise(F.col(key), F.col(text)) >= float(border))
