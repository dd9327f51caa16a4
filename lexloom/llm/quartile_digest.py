"""Quartile bucket digests of whole texts, their bounded comparison, and neighbours in order of id.

A window of five bytes slides over the UTF-8 text; six byte triplets of each window that hold its newest byte, each
under a salt of its own, are hashed into buckets. A bucket's count is coded as the quartile it falls into (2 bits), after
a code of the text's length and of the quartiles' ratios. Two digests differ by a sum over buckets of the squared steps
between quartiles plus bounded terms for the codes; likeness is 1 minus that sum over the largest it can be in
practice, never below 0.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.tables import bound_batches

BUCKETS = 256
#: Offsets back from the newest byte.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
#: The sum of differences at which two texts have nothing in common.
UNLIKE = 2 * BUCKETS
#: Bytes hashed at once.
CHUNK = 1 << 20

_mix = np.random.Generator(np.random.PCG64(7)).permutation(256).astype(np.uint8)
_salted = [_mix[_mix[(np.arange(65536) >> 8).astype(np.uint8) ^ _mix[salt]] ^ (np.arange(65536) & 255).astype(np.uint8)] for salt in range(2, 2 + len(TRIPLETS))]


def bucket_counts(data: bytes) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(len(data) - 4, 0), CHUNK):
        x = np.frombuffer(data[at : at + CHUNK + 4], np.uint8)
        new = x[4:].astype(np.uint16) << 8
        back = [None, *(x[4 - k : len(x) - k] for k in range(1, 5))]
        for salted, (j, k) in zip(_salted, TRIPLETS, strict=True):
            counts += np.bincount(_mix[salted[new | back[j]] ^ back[k]], minlength=BUCKETS)
    return counts


def digest(text: str | bytes | None) -> str:
    """Lowercase hex: 2 digits of length, 2 of quartile ratios, 2 of a checksum, then 2 bits for each bucket. Null is the
    empty text. Texts of under five bytes have empty buckets; their checksum tells them apart."""
    data = text if isinstance(text, bytes) else (text or "").encode()
    counts = bucket_counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = code[0::4] << 6 | code[1::4] << 4 | code[2::4] << 2 | code[3::4]
    length = min(255, round(math.log(len(data) + 1, 1.1)))
    ratios = (q1 * 16 // max(q3, 1) & 15) << 4 | (q2 * 16 // max(q3, 1) & 15)
    check = hashlib.blake2b(data, digest_size=1).digest()
    return (bytes([length, int(ratios)]) + check + body.tobytes()).hex()


_steps = np.array([[sum(min(((a >> s & 3) - (b >> s & 3)) ** 2, 6) for s in (0, 2, 4, 6)) for b in range(256)] for a in range(256)], np.int32)


def difference(a: str, b: str) -> int:
    """0 for equal digests; grows by at most 18 from the codes and by the squared quartile steps of the buckets."""
    x, y = np.frombuffer(bytes.fromhex(a), np.uint8), np.frombuffer(bytes.fromhex(b), np.uint8)
    length = abs(int(x[0]) - int(y[0]))
    ratio = abs(int(x[1] >> 4) - int(y[1] >> 4)) + abs(int(x[1] & 15) - int(y[1] & 15))
    codes = min(length, 12) + min(ratio, 5) + int(x[2] != y[2])
    if min(x[0], y[0]) <= 17:  # under five bytes: no windows
        codes += 0 if a == b else UNLIKE
    return codes + int(_steps[x[3:], y[3:]].sum())


def likeness(a: str, b: str) -> float:
    return max(0.0, 1.0 - difference(a, b) / UNLIKE)


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text", block_rows: int = 256, most_blocks: int = 20_000) -> DataFrame:
    """Rows (block, last, key, text) such that within a block, in order of (last, key, text), each row but the final one
    is followed by the next document in ascending key; the final row of a block (last = 1) is a copy of the first row of
    the next block, or of the first block after the final one. Null keys come first. Ranges of keys are cut at
    approximate quantiles, so no task holds more than some ranges; texts move once."""
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    n = df.select(key).count()
    blocks = max(1, min(most_blocks, n // block_rows))
    at = F.col("k").cast("double")
    edges = sorted(set(rows.select(at.alias("x")).approxQuantile("x", [i / blocks for i in range(1, blocks)], 0.25 / blocks))) if blocks > 1 else []
    cut = Bucketizer(splits=[-math.inf, *(edges or [0.0]), math.inf], inputCol="x", outputCol="b", handleInvalid="keep")
    placed = cut.transform(rows.withColumn("x", F.coalesce(at, F.lit(-math.inf)))).select(F.when(F.col("k").isNull(), F.lit(-1)).otherwise(F.col("b").cast("int")).alias("block"), "k", "t")
    firsts = sorted((r[0], r[1]) for r in placed.groupBy("block").agg(F.min("k")).collect())  # at most most_blocks + 2
    if not firsts:
        return placed.select("block", F.lit(0).alias("last"), "k", "t")
    before = spark.createDataFrame([(b, firsts[i - 1][0], k) for i, (b, k) in enumerate(firsts)], f"fb int, pb int, fk {df.schema[key].dataType.simpleString()}")
    heads = placed.join(F.broadcast(before), (F.col("block") == F.col("fb")) & F.col("k").eqNullSafe(F.col("fk"))).groupBy("pb").agg(F.min("k").alias("k"), F.min("t").alias("t"))
    both = placed.select("block", F.lit(0).alias("last"), "k", "t").unionByName(heads.select(F.col("pb").alias("block"), F.lit(1).alias("last"), "k", "t"))
    return both.repartition("block").sortWithinPartitions("block", "last", F.col("k").asc_nulls_first(), "t")


def edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row of df. Null
    texts are empty; an only document is its own next; rows with equal keys follow each other by text; an empty table
    gives an empty result."""
    bound_batches(df.sparkSession)
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (block, key, text, fingerprint): waits for the row after it
        for batch in batches:
            keys, out = [], []
            for block, last, k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = digest(t)
                if held and held[0] == block:
                    other = edited(held[2], t)
                    theirs = digest(other)
                    keys.append(held[1])
                    out.append((len(held[2]), hashlib.sha256(other.encode()).hexdigest(), held[3], theirs, likeness(held[3], theirs), likeness(held[3], mine)))
                held = None if last else (block, k, t, mine)
            cols = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(2).type), *(pa.array(c, kind) for c, kind in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True))], [f.name for f in schema])

    schema = T.StructType([T.StructField("k", kind), T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")), *(T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next"))])
    return with_next(df, key, text).mapInArrow(run, schema).withColumnRenamed("k", key)
