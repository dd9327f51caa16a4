"""Toxicity by nearest labelled examples: exact TF-IDF cosine through block-max inverted indexes.

Examples are a bounded sample of labelled rows (the same number of each class at most, lowest hash first). Every word of
every example is a term. A word weighs (1 + log count) x idf x relevance: document frequencies are counted over all
documents; relevance, between FLOOR and 1, rises with the word's tie to the label among the examples, so that the few
telling words aren't drowned by the many that documents share by chance, and no word is left out. Examples lie in blocks
of similar ones; the index has each term's postings and its largest weight in each block. The blocks of highest bounds
are scored first; then all those whose bound reaches the k-th cosine found, so the nearest `k` are exact. Their votes,
weighted by squared cosine and by how many labelled rows an example stands for, give a raw score; isotonic regression on the
examples, each scored without itself, makes it a probability. The nearest examples are the evidence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.shingles import hash_spans, runs
from lexloom.llm.tables import bound_batches, discard, keep, release

#: Documented bound: examples of each class, with their whole texts.
EXAMPLES = 1500
#: Examples in a block; nearest examples that vote; blocks scored before the bound is asked; power of a cosine in a vote.
BLOCK, NEAREST, FIRST_BLOCKS, POWER = 64, 24, 6, 2
#: Chi-squared (one degree of freedom) at which half the relevance is reached, and the relevance of a word without tie.
HALF, FLOOR = 100.0, 0.02

#: Lengths of the beginnings of words that are terms too.
STEMS = (4, 6)
#: A term that more than this share of the examples have lies in the block-max index, a rarer one in plain postings.
FREQUENT = 1 / 16
#: Texts compared with the examples, and examples or terms taken in, together.
TOGETHER = 128

_letter: list[np.ndarray] = []


def terms_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct words (runs of letters, digits and underscores, lower case) and of their beginnings,
    and their counts."""
    if not _letter:
        _letter.append(np.array([chr(i).isalnum() or i == 95 for i in range(0x110000)], bool))
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    starts, ends = runs(_letter[0][points])
    found = [hash_spans(points, starts, ends)]
    for n in STEMS:
        some = starts[ends - starts >= n]
        found.append(hash_spans(points, some, some + n) ^ np.uint64(0x5EED))
    return np.unique(np.concatenate(found), return_counts=True)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots and values of the rising step function nearest to y. Equal x are one point."""
    knots, at = np.unique(x, return_inverse=True)
    weight, total = np.bincount(at, w, len(knots)), np.bincount(at, w * y, len(knots))
    pools: list[list[float]] = []
    for knot, a, b in zip(knots.tolist(), total.tolist(), weight.tolist(), strict=True):
        pools.append([a, b, knot])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            a, b, _ = pools.pop()
            pools[-1] = [pools[-1][0] + a, pools[-1][1] + b, pools[-1][2]]
    return np.array([p[2] for p in pools]), np.array([p[0] / p[1] for p in pools])


def relevance(held: np.ndarray, toxic: np.ndarray, examples: int, toxic_examples: int) -> np.ndarray:
    """For words in `held` examples, of which `toxic` are toxic: FLOOR + (1 - FLOOR) * chi / (chi + HALF)."""
    a, b = toxic.astype(float), (held - toxic).astype(float)
    c, d = toxic_examples - a, examples - toxic_examples - b
    low = (a + b) * (c + d) * (a + c) * (b + d)
    chi = np.where(low > 0, examples * (a * d - b * c) ** 2 / np.where(low > 0, low, 1.0), 0.0)
    return FLOOR + (1 - FLOOR) * chi / (chi + HALF)


def _spread(ptr: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all postings of some terms, and how many each term has."""
    first = ptr[terms]
    n = ptr[terms + 1] - first
    ends = np.cumsum(n)
    at = np.repeat(first - ends + n, n)
    at += np.arange(len(at))
    return at, n


class Index:
    """The examples' block-max inverted index and the calibrated vote. Examples are (id, word hashes, counts, label);
    df[i] is the number of documents with the i-th of `vocabulary`, the sorted hashes of all words of the examples."""

    def __init__(self, examples: list[tuple[int, np.ndarray, np.ndarray, int]], vocabulary: np.ndarray, df: np.ndarray, corpus: int, labelled: dict[int, int]):
        n = len(examples)
        self.vocabulary = vocabulary
        # the driver makes the index: what has an entry for each posting is made once, in place
        places = [np.searchsorted(vocabulary, h).astype(np.int32) for _, h, _, _ in examples]
        labels = np.array([y for *_, y in examples], float)
        held, toxic = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
        for p, y in zip(places, labels, strict=True):  # an example has a word once
            held[p] += 1
            if y:
                toxic[p] += 1
        self.weight = np.maximum(np.log((1 + corpus) / (1 + df)), 0.0) * relevance(held, toxic, n, int(labels.sum()))
        # examples whose heaviest terms agree share blocks, which keeps a block's bounds low
        vectors = (self._vector(p, c) for p, (_, _, c, _) in zip(places, examples, strict=True))
        top = [int(p[np.argmax(v)]) if len(p) and v.max() > 0 else -1 for p, v in zip(places, vectors, strict=True)]
        order = sorted(range(n), key=lambda i: (top[i], labels[i], examples[i][0]))
        self.ids = [examples[i][0] for i in order]
        self.labels = labels[order]
        share = {y: labelled.get(y, 0) / max(int((labels == y).sum()), 1) for y in (0, 1)}
        self.weights = np.array([share[int(y)] for y in self.labels])
        self.ptr = np.concatenate([np.zeros(1, np.int64), np.cumsum(held)])
        self.at, self.value, free = np.zeros(self.ptr[-1], np.int32), np.zeros(self.ptr[-1]), self.ptr[:-1].copy()
        for place, i in enumerate(order):  # so within a term by example
            p = places[i]
            self.at[free[p]], self.value[free[p]] = place, self._vector(p, examples[i][2])
            free[p] += 1
        self.blocks = -(-n // BLOCK)
        self._dense = None
        total = max(self.weights.sum(), 1.0)
        bare = np.array([len(places[i]) == 0 for i in order], bool)
        prior = (self.labels * self.weights).sum() / total
        self.bare = float(((self.labels * self.weights)[bare].sum() + prior) / (self.weights[bare].sum() + 1)) if n else 0.0
        self.knots, self.values = np.zeros(0), np.zeros(0)
        near = [f for i in range(0, n, TOGETHER) for f in self.nearest([(places[o], examples[o][2]) for o in order[i : i + TOGETHER]], without=list(range(i, min(i + TOGETHER, n))))]
        mine = [i for i, f in enumerate(near) if len(f[0])]
        if mine:
            self.knots, self.values = isotonic(np.array([self.raw(near[i]) for i in mine]), self.labels[mine], self.weights[mine])
        self._dense = None  # made again by each worker

    def _vector(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = (1 + np.log(counts)) * self.weight[places]
        norm = float(np.sqrt((v * v).sum()))
        return v / norm if norm else v

    def known(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The text's words that examples have, and their counts."""
        h, counts = terms_of(text)
        if not len(self.vocabulary):
            return np.zeros(0, np.int64), counts[:0]
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == h
        return at[hit], counts[hit]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_dense": None}

    def _block_max(self) -> tuple[np.ndarray, ...]:
        """For frequent terms: their row by term (else -1), their weights by block (blocks, rows, BLOCK), and the largest
        weight in each block (rows, blocks). Made where it is used."""
        if self._dense is None:
            frequent = np.flatnonzero(np.diff(self.ptr) > FREQUENT * len(self.ids))
            row = np.full(len(self.vocabulary), -1)
            row[frequent] = np.arange(len(frequent))
            cube = np.zeros((self.blocks, len(frequent), BLOCK))
            for i in range(0, len(frequent), TOGETHER):
                at, n = _spread(self.ptr, frequent[i : i + TOGETHER])
                at_block = self.at[at]
                cube[at_block // BLOCK, i + np.repeat(np.arange(len(n)), n), at_block % BLOCK] = self.value[at]
            self._dense = row, cube, cube.max(2).T.copy()
        return self._dense

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = NEAREST, without: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (terms and counts): places and cosines of the k examples of largest cosine (above 0; ties: lowest
        place), nearest first. Words that no example has would only make all cosines of a text smaller in one proportion;
        they are left out of its length."""
        if not len(self.ids):
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        row, cube, most = self._block_max()
        places, qs = self.blocks * BLOCK, [self._vector(t, c) for t, c in queries]
        term, q = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in queries)]), np.concatenate([np.zeros(0), *qs])
        of = np.repeat(np.arange(len(queries)), [len(v) for v in qs])
        rows = row[term]
        rare = rows < 0
        plain, edges = np.zeros((len(queries), places)), np.searchsorted(of, np.arange(len(queries) + 1))
        for i in range(len(queries)):  # one at a time: what a query needs stays in the processor's cache
            own = slice(edges[i], edges[i + 1])
            at, n = _spread(self.ptr, term[own][rare[own]])
            if len(at):
                plain[i] = np.bincount(self.at[at], np.repeat(q[own][rare[own]], n) * self.value[at], places)
        plain = plain.reshape(-1, self.blocks, BLOCK)
        often = np.zeros((len(queries), len(most)))
        often[of[~rare], rows[~rare]] = q[~rare]
        bound = often @ most + plain.max(2) + 1e-9
        scores = np.zeros_like(plain)
        rank = np.argsort(np.argsort(-bound, axis=1, kind="stable"), axis=1)
        now = rank < FIRST_BLOCKS
        for _ in range(2):
            for b in range(self.blocks):
                some = np.flatnonzero(now[:, b])
                if len(some) == len(queries):
                    scores[:, b] = plain[:, b] + often @ cube[b]
                elif len(some):
                    scores[some, b] = plain[some, b] + often[some] @ cube[b]
            flat = scores.reshape(len(queries), places)
            if without is not None:
                flat[np.arange(len(queries)), without] = 0.0
            least = np.partition(flat, -k, axis=1)[:, -k] if k < places else np.zeros(len(queries))
            now = (rank >= FIRST_BLOCKS) & (bound >= np.maximum(least, 1e-9)[:, None])
        flat, out = np.round(flat, 9), []
        least = np.maximum(np.partition(flat, -k, axis=1)[:, -k], 1e-9) if k < places else np.full(len(queries), 1e-9)
        for i in range(len(queries)):
            some = np.flatnonzero(flat[i] >= least[i])
            best = np.argsort(-flat[i, some], kind="stable")[:k]
            out.append((some[best], flat[i, some[best]]))
        return out

    def raw(self, near: tuple[np.ndarray, np.ndarray]) -> float:
        at, cosines = near
        w = cosines**POWER * self.weights[at]
        return float((w * self.labels[at]).sum() / w.sum())

    def score(self, texts: list[str | None]) -> Iterator[tuple[float, tuple[np.ndarray, np.ndarray]]]:
        """For each text a probability and the nearest examples (places, cosines). A text that shares no word with an
        example gets the share of toxic ones among wordless examples; without examples the score is 0."""
        for i in range(0, len(texts), TOGETHER):
            for near in self.nearest([self.known(t) for t in texts[i : i + TOGETHER]]):
                if not len(near[0]) or not len(self.knots):
                    yield self.bare, near
                else:
                    yield float(self.values[max(int(np.searchsorted(self.knots, self.raw(near), "right")) - 1, 0)]), near


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", examples: int = EXAMPLES) -> Index:
    """The index of at most `examples` labelled documents of each class, of rows that aren't held out. Rows without a key,
    a text or a label of 0 or 1 teach nothing; of several labels of a key the largest holds, of several texts that of the
    smallest hash. No label, or no labelled document here, gives an index without examples, which scores 0."""
    bound_batches(docs.sparkSession)
    known = labels.select(F.col(key).cast("long").alias("k"), F.col(label).cast("int").alias("y")).filter("k is not null and y in (0, 1)").filter(~held_out(F.col("k")))
    known = known.groupBy("k").agg(F.max("y").alias("y"))
    rows = docs.select(F.col(key).cast("long").alias("d"), F.col(text).alias("t"))
    known = keep(known.join(rows.filter("d is not null and t is not null").select("d"), F.col("k") == F.col("d"), "left_semi"), "labelled", 2)
    counts = {r[0]: r[1] for r in known.groupBy("y").count().collect()}
    chosen = None
    for y in (0, 1):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(examples)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = keep(chosen, "chosen", 2)  # at most 2 * examples rows

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [terms_of(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([h.tobytes() for h, _ in got], pa.binary()), pa.array([n.astype(np.int32).tobytes() for _, n in got], pa.binary()), batch.column(3)], ["k", "y", "h", "n", "x"])

    wanted = rows.filter("t is not null").join(F.broadcast(chosen), F.col("d") == F.col("k")).select("k", "y", "t", F.xxhash64("t").alias("x"))
    got = wanted.mapInArrow(terms, "k long, y int, h binary, n binary, x long").groupBy("k", "y").agg(F.min_by(F.struct("h", "n"), "x").alias("w"))
    got = keep(got.select("k", "y", "w.h", "w.n"), "examples", 4)
    in_order = got.orderBy(F.xxhash64("k"), "k").toLocalIterator()
    sample = [(r["k"], np.frombuffer(r["h"], np.uint64), np.frombuffer(r["n"], np.int32), r["y"]) for r in in_order]
    discard(known, chosen, got)
    vocabulary = np.zeros(0, np.uint64)
    for i in range(0, len(sample), TOGETHER):
        vocabulary = np.unique(np.concatenate([vocabulary, *(h for _, h, _, _ in sample[i : i + TOGETHER])]))
    release(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the words of at most 2 * examples texts

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = shared.value, 0
        df = np.zeros(len(known), np.int64)
        for batch in batches:
            total += batch.num_rows
            for t in batch.column(0):
                h, _ = terms_of(t.as_py())
                if len(h) and len(known):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    df[at[known[at] == h]] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([*some, -1], pa.int32()), pa.array([*df[some], total], pa.int64())], ["term", "n"])

    found = docs.select(text).mapInArrow(frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # 12 bytes a word
    term, n = (found.column(c).to_numpy() for c in ("term", "n"))
    df = np.zeros(len(vocabulary), np.int64)
    df[term[term >= 0]] = n[term >= 0]
    index = Index(sample, vocabulary, df, int(n[term < 0].sum()), counts)
    del sample, found, term, n
    release(docs.sparkSession)
    return index


def score(docs: DataFrame, index: Index, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score, evidence (the nearest labelled examples: id, label, cosine) of every row, from its text alone. Null and
    empty texts score as texts without words do; equal texts, and so repeated rows, have equal scores; other columns
    aren't read; an empty table gives an empty result."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    near = pa.list_(pa.struct([("example", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            s, e = [], []
            for p, (at, cosines) in own.score(batch.column(1).to_pylist()):
                s.append(p)
                e.append([{"example": own.ids[a], "label": int(own.labels[a]), "cosine": c} for a, c in zip(at[:3].tolist(), cosines[:3].tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array(e, near)], ["k", "score", "evidence"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"k {kind}, score double, evidence array<struct<example:long,label:int,cosine:double>>").withColumnRenamed("k", key)


def keep_clean(docs: DataFrame, index: Index, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of docs whose score is below the threshold, with their columns as they are, whatever they are called. Null
    and empty texts score as texts without words do; repeated rows share their fate; an empty table stays empty."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([p < threshold for p, _ in shared.value.score(part.tolist())], dtype=bool)

    return docs.filter(F.pandas_udf(clean, "boolean")(F.coalesce(F.col(text), F.lit(""))))
