"""Chat formatting in budgeted windows.

Turns become `<|im_start|>role`, a newline, the text, `<|im_end|>` and a newline. Inside texts and roles every `<`,
backslashes, `|` gets one backslash more, so no control string can arise from a text, and taking one away gives the text back.
Prefix sums of turn tokens choose windows: with a span of S tokens, a turn that lies in one span [kS, (k+1)S) goes to
that span's window, and a turn over a border has a window of its own. So every turn is a target once, windows need no
sequential pass, and a conversation of any length is spread over tasks. Each window begins with the system turn and with
as many whole turns before it as fit in the history budget; only assistant texts that are targets bear loss.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.bpe_fst import _bytes, read_ranks
from lexloom.llm.packing import PATTERN
from lexloom.llm.tables import bound_batches, keep

START, END = "<|im_start|>", "<|im_end|>"
#: Turn numbers to a block of prefix sums.
BLOCK_TURNS = 1000


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def escape_role(c: Column) -> Column:
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


@lru_cache(maxsize=2)
def _counter(data: bytes):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(data), special_tokens={})


def _turns(df: DataFrame, ranks_path: str, conv: str, turn: str, role: str, text: str) -> DataFrame:
    bound_batches(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(_bytes(ranks_path))

    def tokens(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _counter(ranks.value)
        for part in parts:
            yield part.map(lambda t: len(enc.encode_ordinary(t))).astype("int64")

    count = F.pandas_udf(tokens, "long")
    null = F.lit("")
    rows = df.select(F.col(conv).alias("c"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), null).alias("role"), F.coalesce(F.col(text), null).alias("text"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    rows = rows.withColumn("head", F.length(head)).withColumn("body", F.length(escape(F.col("text"))))
    rows = rows.withColumn("formatted", F.concat(head, escape(F.col("text")), F.lit(END + "\n")))
    rows = rows.withColumn("n", count("formatted")).withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(-(1 << 60))) / BLOCK_TURNS))
    inside = Window.partitionBy("c", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum("n").over(inside)).withColumn("pos", F.count(F.lit(1)).over(inside) - 1)
    rows = keep(rows.select("c", "block", "role", "head", "body", "formatted", "n", "end", "pos"), "turns")
    before = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("c", "block").agg(F.sum("n").alias("bn"), F.count(F.lit(1)).alias("bc"), F.max(F.when(F.col("pos") == 0, F.struct("role", "n"))).alias("lead"))
    lead = F.first("lead").over(Window.partitionBy("c").orderBy("block"))
    blocks = blocks.select(F.col("c").alias("c2"), F.col("block").alias("b2"), F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("bc").over(before), F.lit(0)).alias("p0"), F.sum("bc").over(Window.partitionBy("c")).alias("turns"), lead.alias("lead"))
    rows = rows.join(blocks, F.col("c").eqNullSafe(F.col("c2")) & (F.col("block") == F.col("b2")))
    led = (F.col("lead.role") == "system") & (F.col("turns") > 1)
    return rows.select("c", "role", "head", "body", "formatted", "n", (F.col("end") + F.col("n0")).alias("end"), (F.col("pos") + F.col("p0")).alias("pos"), "turns", F.when(led, F.col("lead.n")).otherwise(0).alias("sn"))


SPANS = "array<struct<start:long,end:long>>"


def windows(df: DataFrame, ranks_path: str, budget: int = 1024, history: int = 256, least_span: int = 64, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, window (ascending along the conversation), text, loss (spans of code points in text), repeated (leading
    turns that another window has as its own), turns, tokens, over_budget.

    Turns are ordered by (turn, role, text), a null turn first; null roles and texts are empty, null conversations are
    one conversation. The system turn is the first turn if its role is `system` and other turns follow. What the system
    turn leaves of the budget goes to the span of own turns, less `history`; where that would leave the span under
    `least_span`, history gives way first. Repeated history takes no more than the window's own turns leave. So a window
    is over budget only where the system turn and one target turn are so by themselves: no turn is cut or dropped. Equal
    rows are turns like any other; other columns aren't read; an empty table gives an empty result."""
    rows = _turns(df, ranks_path, conv, turn, role, text)
    is_system = (F.col("pos") == 0) & (F.col("sn") > 0)
    salts = F.ceil(F.col("turns") / BLOCK_TURNS)  # the system turn of a long conversation is joined in so many parts
    system = rows.filter(is_system).select(F.col("c").alias("c2"), F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("s2"), F.struct(F.lit(0).alias("kind"), "pos", "role", "head", "body", "formatted", "n").alias("system"))
    rows = rows.filter(~is_system)
    rows = rows.withColumn("end", F.col("end") - F.col("sn")).withColumn("start", F.col("end") - F.col("n"))
    room = F.lit(budget) - F.col("sn")
    span = F.greatest(F.lit(1), room - F.least(F.lit(history), F.greatest(F.lit(0), room - least_span)))
    a, b = F.floor(F.col("start") / span), F.floor(F.greatest(F.col("end") - 1, F.col("start")) / span)
    rows = rows.withColumn("window", F.when(a == b, 2 * a).otherwise(2 * a + 1))
    turn_of = lambda kind: F.struct(F.lit(kind).alias("kind"), "pos", "role", "head", "body", "formatted", "n")
    left = F.least(F.lit(history), F.greatest(F.lit(0), F.first(room) - F.sum("n")))
    begins = rows.groupBy("c", "window").agg(F.min("start").alias("at"), left.alias("left"), F.pmod(F.xxhash64("window"), F.first(salts)).alias("salt"))
    bucket = lambda x: F.floor(x / history)
    past = rows.filter(F.col("n") <= history).select("c", "start", "end", turn_of(1).alias("t"), F.explode(F.sequence(bucket(F.col("end")), bucket(F.col("start") + history))).alias("k")) if history else None
    parts = rows.select("c", "window", turn_of(2).alias("t"))
    if history:
        at = begins.select(F.col("c").alias("c2"), "window", "at", "left", bucket(F.col("at")).alias("k2"))
        joined = past.join(at, F.col("c").eqNullSafe(F.col("c2")) & (F.col("k") == F.col("k2")) & (F.col("at") >= F.col("end")) & (F.col("at") <= F.col("start") + F.col("left")))
        parts = parts.unionByName(joined.select("c", "window", "t"))
    with_system = begins.join(system, F.col("c").eqNullSafe(F.col("c2")) & (F.col("salt") == F.col("s2"))).select("c", "window", F.col("system").alias("t"))
    whole = parts.unionByName(with_system).groupBy("c", "window").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    whole = whole.join(begins.select(F.col("c").alias("c2"), F.col("window").alias("w2"), "at"), F.col("c").eqNullSafe(F.col("c2")) & (F.col("window") == F.col("w2")))
    offsets = F.aggregate(
        "ts",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["formatted"])).cast("long").alias("at"),
            F.when((t["kind"] == 2) & (t["role"] == "assistant"), F.concat(s["spans"], F.array(F.struct((s["at"] + t["head"]).cast("long").alias("start"), (s["at"] + t["head"] + t["body"]).cast("long").alias("end"))))).otherwise(s["spans"]).alias("spans"),
        ),
    )
    kinds = lambda k: F.size(F.filter("ts", lambda t: t["kind"] == k))
    tokens = F.aggregate("ts", F.lit(0).cast("long"), lambda s, t: s + t["n"])
    return whole.select(
        F.col("c").alias(conv), "window", F.array_join(F.transform("ts", lambda t: t["formatted"]), "").alias("text"), offsets["spans"].alias("loss"),
        (kinds(1) + F.when(F.col("at") > 0, kinds(0)).otherwise(0)).alias("repeated"), F.size("ts").alias("turns"), tokens.alias("tokens"), (tokens > budget).alias("over_budget"),
    )


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted window."""
    found, at = [], 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError(f"no turn at {at}")
        line = text.index("\n", at)
        end = text.index(END, line)
        found.append((unescape_role(text[at + len(START) : line]), unescape(text[line + 1 : end])))
        at = end + len(END) + 1
    return found


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the windows say, for each conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars. A hash
    over a conversation is sequential: its windows stream through one task, of which only one is held at a time."""
    bound_batches(formatted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def done():
            return [now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]]

        for batch in batches:
            out = []
            for c, text, loss, repeated in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if now != (c,):
                    if now:
                        out.append(done())
                    now, state = (c,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = parse(text)[repeated:]
                state[0] += len(turns)
                for r, t in turns:
                    state[1].update(f"{r}\n{t}\n".encode())
                for s in loss:
                    t = unescape(text[s["start"] : s["end"]])
                    state[2] += len(t)
                    state[3].update(t.encode())
                state[4] += len(text)
            yield made(out, batch.schema.field(0).type)
        if now:
            yield made([done()], kind)

    def made(rows, key_type):
        nonlocal kind
        kind = key_type
        cols = list(zip(*rows, strict=True)) or [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], [f.name for f in schema])

    kind = None
    schema = T.StructType([T.StructField("k", formatted.schema[conv].dataType), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])
    rows = formatted.repartition(conv).sortWithinPartitions(conv, "window").select(conv, "text", "loss", "repeated")
    return rows.mapInArrow(run, schema).withColumnRenamed("k", conv)
