"""Best-fit packing planned on the histogram of lengths.

Texts are tokenized once, into a narrow table of pieces (length and checksum; ids of a piece can be had again from
`piece_ids`). The histogram has at most `window` counts, whatever the corpus; best fit runs over those counts, longest
first, and gives runs: pieces number a .. b of a length go to these sequences at this offset. Pieces then take their
slots by their rank within their length.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.bpe_fst import _bytes
from lexloom.llm.ranks import rank_within
from lexloom.llm.tables import bound_batches, keep, resting, unused

#: Splits texts into pieces before merging; fixed value of the public byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _tokenizer(data: bytes) -> Callable[[str], list[int]]:
    """text -> ids of a byte-level BPE .json file, as the library tokenizers gives them without special tokens added: a
    string of the file's added tokens within a text is that token. They are computed by the faster of two libraries that
    give the same ids (a token's rank in merging is its id), unless an added token asks for more than its own string."""
    import tiktoken

    whole = json.loads(data)
    model, added = whole["model"], whole.get("added_tokens") or []
    if any(t.get(x) for t in added for x in ("single_word", "lstrip", "rstrip", "normalized")):
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(data.decode())
        return lambda text: library.encode(text, add_special_tokens=False).ids
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    made = {a + b for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])}
    ranks = {bytes(signs[c] for c in t): i for t, i in model["vocab"].items() if len(t) == 1 or t in made}
    special = {t["content"]: t["id"] for t in added}
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(text: str) -> list[int]:
        return enc.encode(text, allowed_special="all") if any(x in text for x in special) else enc.encode_ordinary(text)

    return ids


def pieces(df: DataFrame, vocabulary: str, window: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece: key, piece, start, length, ids_crc32. A document is its ids and id 0 (null or empty text:
    only that); one longer than `window` is cut so that the first piece takes what is over."""
    bound_batches(df.sparkSession)
    data = df.sparkSession.sparkContext.broadcast(_bytes(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(data.value)
        for batch in batches:
            at, rows = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                ids = np.array([*(encode(t) if t else []), 0], "<u4")
                for piece, (a, b) in enumerate(cuts(len(ids), window)):
                    at.append(i)
                    rows.append((piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])], ["k", "piece", "start", "length", "ids_crc32"])

    schema = T.StructType([T.StructField("k", df.schema[key].dataType), T.StructField("piece", T.IntegerType()), *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32"))])
    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema).withColumnRenamed("k", key)


def cuts(n: int, window: int) -> list[tuple[int, int]]:
    first = n % window or window
    edges = [0, *range(min(first, n), n + 1, window)]
    return list(zip(edges, edges[1:], strict=False))


def plan(histogram: dict[int, int], window: int) -> tuple[dict[int, list[tuple[int, int, int, int]]], int]:
    """Best fit, longest first, over counts. Returns for each length its runs (first rank, pieces in a sequence, first
    sequence, offset), in order of rank, and the number of sequences. A run's piece of rank q sits in sequence
    first + (q - rank) // k at offset + (q - rank) % k * length."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    room: list[int] = []  # residuals in use, ascending
    groups: dict[int, list[tuple[int, int]]] = {}  # residual -> (first sequence, sequences)
    used = 0

    def put(residual: int, first: int, n: int) -> None:
        if n and residual:
            if residual not in groups:
                insort(room, residual)
                groups[residual] = []
            groups[residual].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank, mine = histogram[length], 0, runs.setdefault(length, [])
        if not 0 < length <= window:
            raise ValueError(f"length {length} is not in 1 .. {window}")
        while left:
            i = bisect_left(room, length)
            if i < len(room):
                residual = room[i]
                first, n = groups[residual].pop()
                if not groups[residual]:
                    del groups[residual], room[i]
            else:
                residual, first = window, used
                n = -(-left // (window // length))
                used += n
            k = residual // length
            full = min(n, left // k)
            part = min(left - full * k, k) if full < n else 0
            mine.append((rank, k, first, window - residual))
            put(residual - k * length, first, full)
            if part:
                put(residual - part * length, first + full, 1)
            put(residual, first + full + bool(part), n - full - bool(part))
            rank += full * k + part
            left -= full * k + part
    return runs, used


def pack(piece_rows: DataFrame, window: int = 2048, key: str = "doc_id") -> DataFrame:
    """Rows of pieces (any with key, piece, start, length, ids_crc32) with sequence_id and offset added. Equal rows,
    repeated keys and null keys are pieces like any other; an empty table gives an empty result."""
    bound_batches(piece_rows.sparkSession)
    counts = {r[0]: r[1] for r in piece_rows.groupBy("length").count().collect()}  # at most `window` rows
    if any(not 0 < n <= window for n in counts):
        raise ValueError(f"lengths must be in 1 .. {window}")
    runs, _ = plan(counts, window)
    arrays = {n: tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) for n, r in runs.items()}
    spark = piece_rows.sparkSession
    shared = spark.sparkContext.broadcast(arrays)  # bounded by the window: runs follow lengths, not pieces
    place = unused("__rank", piece_rows)
    ranked = rank_within(piece_rows.drop("sequence_id", "offset"), "length", [key, "piece", "start", "ids_crc32"], place, counts=counts)
    names = [c for c in ranked.columns if c != place]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column(place).to_numpy(zero_copy_only=False)
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                starts, k, first, offset = shared.value[int(n)]
                r = np.searchsorted(starts, rank[rows], "right") - 1
                q = rank[rows] - starts[r]
                seq[rows], off[rows] = first[r] + q // k[r], offset[r] + q % k[r] * n
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(seq), pa.array(off)], [*names, "sequence_id", "offset"])

    schema = T.StructType([*(ranked.schema[c] for c in names), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(run, schema)


def pack_documents(df: DataFrame, vocabulary: str, window: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenize, cut and pack: key, piece, start, length, ids_crc32, sequence_id, offset. Null and empty texts are a piece
    of one token; repeated rows and null keys are packed like any other; other columns aren't read; an empty table gives
    an empty result."""
    rows = keep(pieces(df, vocabulary, window, key, text), "pieces")
    return resting(pack(rows, window, key), rows)


def piece_ids(text: str | None, start: int, length: int, vocabulary: bytes) -> list[int]:
    """The ids of one piece, for a writer of sequences."""
    return [*(_tokenizer(vocabulary)(text) if text else []), 0][start : start + length]
