"""Byte-level BPE as a lazily determinised finite-state transducer, and a streaming decoder.

Encoding. The canonical encoding of a prefix of a piece ends in exactly one token that is compatible with the token
before it (two neighbours are compatible when merging their joined bytes by rank gives the same two tokens back;
the merges inside them, undone one by one, decide that). A
nondeterministic transducer therefore has one hypothesis for each place where the next token may start: the place's
node in the trie of tokens, and the tokens up to that place. Its subsets are the states of the deterministic machine;
they are made on first use and kept with the tokens that the move emits: those on which all hypotheses agree. As no
hypothesis outlives the longest token, the lookahead is bounded by that length.

Decoding. Tokens become bytes; a UTF-8 state machine runs over them, remembered as state x token -> state, and hands
out text up to the last complete code point of each chunk.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.tables import bound_batches

#: Entries kept in one worker: moves of the machine, and whole pieces. Beyond it the memory is emptied and refilled.
MOST_MOVES, MOST_PIECES = 1_000_000, 350_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """A .tiktoken file: base64 of a token and its rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


class MergeTransducer:
    """encode_piece(bytes) -> ids, as merging neighbours by lowest rank would give."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        # The trie: one dict for all edges, (node << 8 | byte) -> node; final: node -> token id; inner: nodes that go on.
        edges: dict[int, int] = {}
        final: dict[int, int] = {}
        inner: set[int] = {0}
        n = 1
        for token, rank in ranks.items():
            node = 0
            for b in token:
                inner.add(node)
                key = node << 8 | b
                nxt = edges.get(key)
                if nxt is None:
                    nxt = edges[key] = n
                    n += 1
                node = nxt
            final[node] = rank
        self.edges, self.final, self.inner = edges, final, inner
        self.below: dict[int, list[int]] = {}
        for token, rank in ranks.items():
            node = 0
            for b in token[:-1]:
                node = edges[node << 8 | b]
                self.below.setdefault(node, []).append(rank)
        self.fits: dict[int, bool] = {}
        self._split()
        self.lives: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        # A state: (last emitted token or -1, hypotheses); a hypothesis: (trie node, tokens since the last emitted).
        start = (-1, ((0, ()),))
        self.state_ids: dict[tuple, int] = {start: 0}
        self.states: list[tuple] = [start]
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _split(self) -> tuple[list[int], list[int]]:
        """The last merge of each token: its left and right part (itself for a single byte)."""
        size = max(self.tokens, default=0) + 1
        self.left, self.right = list(range(size)), list(range(size))
        for token, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i], rank), self.ranks.get(token[i:], rank)
                if a < rank and b < rank and self._apart(a, b, rank):
                    self.left[rank], self.right[rank] = a, b
                    break
            else:
                if len(token) > 1:
                    raise ValueError(f"token {rank} can't be made by merges")
        return self.left, self.right

    def _apart(self, a: int, b: int, limit: int) -> bool:
        """Whether merges of a rank below `limit` leave the border between tokens a and b alone. Merges are undone in
        reverse order; a merge over the border would come first if its rank is less than that of the merge which took
        its left part (of two equal ones the left comes first), and not more than that of its right part."""
        tokens, ranks, left, right = self.tokens, self.ranks, self.left, self.right
        took_a = took_b = limit
        while True:
            over = ranks.get(tokens[a] + tokens[b])
            if over is not None and over < took_a and over <= took_b and over < limit:
                return False
            if a > b:
                if right[a] == a:
                    if left[b] == b:
                        return True
                    took_b, b = b, left[b]
                else:
                    took_a, a = a, right[a]
            elif left[b] == b:
                if right[a] == a:
                    return True
                took_a, a = a, right[a]
            else:
                took_b, b = b, left[b]

    def compatible(self, a: int, b: int) -> bool:
        if a < 0:
            return True
        key = a << 32 | b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > MOST_MOVES:
                self.fits.clear()
            known = self.fits[key] = self._apart(a, b, 1 << 60)
        return known

    def can_end(self, last: int, node: int) -> bool:
        """Whether a token that goes on from this node can follow `last`; else the hypothesis is dead. Nodes with very
        many tokens below count as live, which keeps the answer right."""
        below = self.below[node]
        if last < 0 or len(below) > 4:
            return True
        key = last << 32 | node
        known = self.lives.get(key)
        if known is None:
            if len(self.lives) > MOST_MOVES:
                self.lives.clear()
            known = self.lives[key] = any(self.compatible(last, t) for t in below)
        return known

    def determinise(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The move from a state on a byte: the next state and the tokens it emits."""
        last, hypotheses = self.states[state]
        edges, final, inner, fits, lives, below = self.edges, self.final, self.inner, self.fits, self.lives, self.below
        alive, whole = [], None
        for node, path in hypotheses:
            nxt = edges.get(node << 8 | byte)
            if nxt is None:
                continue
            before = path[-1] if path else last
            if whole is None:
                token = final.get(nxt)
                if token is not None:
                    fit = True if before < 0 else fits.get(before << 32 | token)
                    if fit is None:
                        fit = self.compatible(before, token)
                    if fit:
                        whole = (*path, token)
            if nxt in inner:
                live = True if before < 0 or len(below[nxt]) > 4 else lives.get(before << 32 | nxt)
                if live is None:
                    live = self.can_end(before, nxt)
                if live:
                    alive.append((nxt, path))
        shared = 0
        least = min([len(p) for _, p in alive], default=len(whole))
        if least > len(whole):
            least = len(whole)
        while shared < least:
            token = whole[shared]
            for _, p in alive:
                if p[shared] != token:
                    break
            else:
                shared += 1
                continue
            break
        alive.append((0, whole))
        emitted = whole[:shared]
        pending = tuple([(n, p[shared:]) for n, p in alive]) if shared else tuple(alive)
        # the last emitted token matters only where a next token would follow it directly
        direct = any([not p for _, p in pending])
        new = ((emitted[-1] if emitted else last) if direct else -1, pending)
        at = self.state_ids.get(new)
        if at is None:
            at = self.state_ids[new] = len(self.states)
            self.states.append(new)
        self.moves[state << 8 | byte] = (at, emitted)
        return at, emitted

    def encode_piece(self, piece: bytes) -> list[int]:
        if len(self.moves) > MOST_MOVES:
            self.clear()
        state, out, moves = 0, [], self.moves
        for b in piece:
            move = moves.get(state << 8 | b)
            if move is None:
                if len(moves) > 2 * MOST_MOVES:  # inside one very long piece: keep only where we are
                    here = self.states[state]
                    self.clear()
                    moves = self.moves
                    self.state_ids[here] = len(self.states)
                    self.states.append(here)
                    state = self.state_ids[here]
                move = self.determinise(state, b)
            state, emitted = move
            if emitted:
                out += emitted
        out += self.states[state][1][-1][1]  # the end: the hypothesis of the whole prefix
        return out


class _Pieces(dict):
    """piece -> ids, filled on demand; when full, it becomes the older generation and starts anew."""

    def __init__(self, machine: MergeTransducer):
        super().__init__()
        self.machine, self.older = machine, {}

    def __missing__(self, piece: str) -> list[int]:
        ids = self.older.get(piece) or self.machine.encode_piece(piece.encode())
        if len(self) >= MOST_PIECES:
            self.older = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class BpeEncoder:
    """Whole texts: pieces by the pattern, each through the transducer, whole pieces remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.machine = MergeTransducer(ranks)
        self.find = regex.compile(pattern).findall
        self.pieces = _Pieces(self.machine)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.find(text))))


#: UTF-8 by lead byte: (continuation bytes to come, least and greatest value of the first of them). Fixed values of the
#: encoding's definition (Unicode 3.9, table of well-formed byte sequences).
def _leads() -> dict[int, tuple[int, int, int]]:
    lead = {b: (0, 0, 0) for b in range(0x80)}
    lead |= {b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)}
    lead |= {b: (2, 0x80, 0xBF) for b in range(0xE1, 0xF0)}
    lead |= {0xE0: (2, 0xA0, 0xBF), 0xED: (2, 0x80, 0x9F)}
    lead |= {b: (3, 0x80, 0xBF) for b in range(0xF1, 0xF4)}
    return lead | {0xF0: (3, 0x90, 0xBF), 0xF4: (3, 0x80, 0x8F)}


class Utf8Machine:
    """States: 0 between code points, (left, least, greatest) inside one; None is an error."""

    def __init__(self) -> None:
        self.leads = _leads()

    def step(self, state, byte: int):
        if state == 0:
            lead = self.leads.get(byte)
            return None if lead is None else 0 if not lead[0] else lead
        left, least, most = state
        if not least <= byte <= most:
            return None
        return (left - 1, 0x80, 0xBF) if left > 1 else 0

    def run(self, state, data: bytes):
        for b in data:
            state = self.step(state, b)
            if state is None:
                return None
        return state


class StreamDecoder:
    """feed(ids) -> text that is complete so far; finish() -> the rest. Ill-formed bytes become U+FFFD."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens, self.machine = tokens, Utf8Machine()
        self.known: dict[tuple, object] = {}
        self.whole = {i for i, t in tokens.items() if self.machine.run(0, t) == 0}
        self.reset()

    def reset(self) -> None:
        self.state: object = 0
        self.held: list[bytes] = []

    def feed(self, ids: list[int]) -> bytes:
        """The bytes up to the last complete code point; what follows is held back."""
        tokens, known, state, held = self.tokens, self.known, self.state, self.held
        if state == 0 and self.whole.issuperset(ids):  # every token begins and ends between code points
            return b"".join(map(tokens.__getitem__, ids))
        done = 0
        for i in ids:
            data = tokens[i]
            held.append(data)
            key = (state, i)
            nxt = known.get(key, 1)
            if nxt == 1:
                nxt = known[key] = self.machine.run(state, data)
            if nxt is None:
                nxt = 0  # ill-formed: hand it out as it is, the caller's codec replaces it
            state = nxt
            if state == 0:
                done = len(held)
        out = b"".join(held[:done])
        rest = b"".join(held[done:])
        if rest and state != 0:
            cut = self._complete(rest)
            out, rest = out + rest[:cut], rest[cut:]
        self.held, self.state = [rest] if rest else [], state
        return out

    def _complete(self, data: bytes) -> int:
        for back in range(1, min(4, len(data)) + 1):
            if data[-back] >= 0xC0:
                return len(data) - back
        return 0

    def feed_text(self, ids: list[int]) -> str:
        return self.feed(ids).decode("utf-8", "replace")

    def finish(self) -> bytes:
        out = b"".join(self.held)
        self.reset()
        return out


def little(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    a = array("I", ids)
    if a.itemsize != 4:
        return np.array(ids, "<u4").tobytes()
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


@lru_cache(maxsize=4)
def _encoder(data: bytes, pattern: str) -> BpeEncoder:
    return BpeEncoder(read_ranks(data), pattern)


def _bytes(path: str) -> bytes:
    """A vocabulary file, read once on the driver; at most 16 MB, as it goes to every executor."""
    with open(path, "rb") as f:
        data = f.read((16 << 20) + 1)
    if len(data) > 16 << 20:
        raise ValueError(f"{path} is larger than 16 MB")
    return data


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add `out`, the token ids of `text` (array of int). Null and empty texts give an empty array. Texts are encoded
    whole, of any length; other columns are passed on as they are, an older `out` column is replaced."""
    bound_batches(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(_bytes(ranks_path))

    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(ranks.value, pattern)
        for part in texts:
            yield part.map(lambda t: np.array(enc.encode(t) if t else [], np.int32))

    return df.withColumn(out, F.pandas_udf(ids, "array<int>")(F.col(text)))


def coded_digests(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", chunk: int = 8192) -> DataFrame:
    """For each row of df: key, n_tokens, ids_sha256, decoded_sha256. Ids go through the stream decoder in chunks. Null and
    empty texts have no ids, so the digests of nothing; texts of any length are encoded whole; repeated rows and null keys
    are rows like any other; other columns aren't read; an empty table gives an empty result."""
    bound_batches(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(_bytes(ranks_path))
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(ranks.value, pattern)
        dec = StreamDecoder(enc.machine.tokens)
        for batch in batches:
            n, a, b = [], [], []
            for t in batch.column(1).to_pylist():
                ids = enc.encode(t) if t else []
                whole = hashlib.sha256()
                for i in range(0, len(ids), chunk):
                    whole.update(dec.feed(ids[i : i + chunk]))
                whole.update(dec.finish())
                n.append(len(ids))
                a.append(hashlib.sha256(little(ids)).hexdigest())
                b.append(whole.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["k", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = T.StructType([T.StructField("k", kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema).withColumnRenamed("k", key)
