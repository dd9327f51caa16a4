"""Concordance: runs of keywords in token sequences, with sentences around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.binding import let

Keyword = tuple[str | None, str | None]


def match_word(keyword: Keyword, word: Column, pos: Column) -> Column:
    """Whether a word (and its array of parts of speech) fits a keyword; None fits all."""
    w, p = keyword
    fits = F.lit(True) if w is None else word == w
    return fits & (F.lit(True) if p is None else F.coalesce(F.array_contains(pos, p), F.lit(False)))


def find(keywords: list[Keyword], words: Column, poss: Column | None = None) -> Column:
    """array<int>: the starts (from 0) of runs of neighbouring words that fit the keywords, overlapping ones too. No
    keywords are found once, at 0."""
    if not keywords:
        return F.array(F.lit(0))
    k = len(keywords)
    none = F.array().cast("array<string>")

    def starts(x: Column) -> Column:
        ws, tags = x["ws"], x["tags"]

        def fits(i: Column) -> Column:
            out = F.lit(True)
            for j, kw in enumerate(keywords):
                out = out & match_word(kw, F.get(ws, i + j), F.get(tags, i + j) if poss is not None else none)
            return F.coalesce(out, F.lit(False))

        return F.filter(F.when(F.size(ws) >= k, F.sequence(F.lit(0), F.size(ws) - k)).otherwise(F.array().cast("array<int>")), fits)

    return let(F.struct(words.alias("ws"), (poss if poss is not None else none).alias("tags")), starts)


def intervals(found: Column, length: int, offset: Column | int = 0) -> Column:
    """array<struct<start,end>>, half open."""
    off = F.lit(offset) if isinstance(offset, int) else offset
    return F.transform(found, lambda f: F.struct((f + off).alias("start"), (f + off + length).alias("end")))


def highlight(words: Column, spans: Column, mark: str = "**") -> Column:
    """words with marks around those inside the spans (array<struct<start,end>>, in order of start; they may overlap). The
    words are cut at the spans, so a text costs its words and its spans, not their product."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def merge(out: Column, s: Column) -> Column:
        last = F.element_at(out, -1)
        s = F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(out) > 0) & (s["start"] <= last["end"]), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(longer))).otherwise(F.concat(out, F.array(s)))

    def shown(x: Column) -> Column:
        ws, at = x["ws"], x["at"]
        end = lambda i: F.coalesce(F.get(at, i)["end"], F.lit(0))
        pieces = F.transform(at, lambda s, i: F.concat(F.slice(ws, end(i - 1) + 1, F.greatest(s["start"] - end(i - 1), F.lit(0))), F.transform(F.slice(ws, s["start"] + 1, s["end"] - s["start"]), lambda w: F.concat(F.lit(mark), w, F.lit(mark)))))
        return F.concat(F.flatten(pieces), F.slice(ws, end(F.size(at) - 1) + 1, F.size(ws)))

    return let(F.struct(words.alias("ws"), F.aggregate(spans, none, merge).alias("at")), shown)


def concordance(sentences: DataFrame, keywords: list[Keyword], k: int = 1, book: str = "book", idx: str = "idx", sentence: str = "sentence", words: str = "words", poss: str | None = None) -> DataFrame:
    """Hit sentences with k sentences before and after: book, idx, sentence, words, intervals.

    `idx` numbers the sentences 0, 1, 2 ... over the whole corpus. Context is all or nothing: fewer than k sentences
    before (after) in the corpus give none on that side; of those, the ones of another book are left out. Only hits
    are joined with their neighbours, on the number; the corpus is not sorted or gathered."""
    n = sentences.agg(F.max(idx)).first()[0]
    n = -1 if n is None else n
    base = sentences.select(F.col(book).alias("book"), F.col(idx).alias("idx"), F.col(sentence).alias("sentence"), F.col(words).alias("words"), *([F.col(poss).alias("poss")] if poss else []))
    found = find(keywords, F.col("words"), F.col("poss") if poss else None)
    hits = base.withColumn("found", found).filter(F.size("found") > 0)
    if k == 0:
        out = hits.withColumn("before", F.array()).withColumn("after", F.array())
        return out.select("book", "idx", F.concat(F.lit(" "), "sentence", F.lit(" ")).alias("sentence"), "words", intervals(F.col("found"), len(keywords)).alias("intervals"))
    steps = F.concat(F.when(F.col("idx") >= k, F.sequence(F.lit(-k), F.lit(-1))).otherwise(F.array().cast("array<int>")), F.when(F.col("idx") + k <= n, F.sequence(F.lit(1), F.lit(k))).otherwise(F.array().cast("array<int>")))
    wanted = hits.select("book", "idx", F.explode_outer(steps).alias("d")).withColumn("near", F.col("idx") + F.col("d"))
    near = base.select(F.col("idx").alias("near"), F.col("book").alias("b2"), F.col("sentence").alias("s2"), F.col("words").alias("w2"))
    around = wanted.join(near, "near").filter(F.col("book").eqNullSafe(F.col("b2"))).groupBy("idx").agg(F.sort_array(F.collect_list(F.struct("d", "s2", "w2"))).alias("around"))
    out = hits.join(around, "idx", "left").withColumn("around", F.coalesce("around", F.array()))
    side = lambda cond: F.filter("around", cond)
    out = out.withColumn("before", side(lambda x: x["d"] < 0)).withColumn("after", side(lambda x: x["d"] > 0))
    said = lambda c: F.array_join(F.transform(c, lambda x: x["s2"]), " ")
    told = lambda c: F.flatten(F.transform(c, lambda x: x["w2"]))
    none = F.array().cast("array<string>")
    return out.select(
        "book", "idx", F.concat(said("before"), F.lit(" "), "sentence", F.lit(" "), said("after")).alias("sentence"),
        F.concat(F.coalesce(told("before"), none), "words", F.coalesce(told("after"), none)).alias("words"),
        intervals(F.col("found"), len(keywords), F.aggregate("before", F.lit(0), lambda s, x: s + F.size(x["w2"]))).alias("intervals"),
    )


def neighbours(df: DataFrame, tokens: Column, *carry: str) -> DataFrame:
    """carry, pos, token, prev, next, after_next of each token of each row, told inside the row: nothing is shuffled."""
    near = let(tokens, lambda t: F.transform(t, lambda w, i: F.struct(w.alias("token"), F.get(t, i - 1).alias("prev"), F.get(t, i + 1).alias("next"), F.get(t, i + 2).alias("after_next"))))
    return df.select(*carry, F.posexplode(near).alias("pos", "x")).select(*carry, "pos", "x.*")


def lookup(entries: DataFrame, needle: str, columns: list[str], source: str, lemma: str, ord_: str, most: int = 12) -> DataFrame:
    """Entries in which a column holds the needle, each (source, lemma) once, the first `most` in order."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c).contains(needle), F.lit(False))
    first = entries.filter(hit).groupBy(source, lemma).agg(F.min_by(F.struct(*[c for c in entries.columns if c not in (source, lemma)]), ord_).alias("r"))
    return first.select(source, lemma, "r.*").orderBy(ord_, source, lemma).limit(most)


def segmented(words: DataFrame, word: str, morphemes: DataFrame, morpheme: str) -> DataFrame:
    """words with `breaks`: whether a word is a sequence of known morphemes, of which there may be any number. Substrings
    of the distinct words, of lengths that morphemes have, meet the morphemes by a join; which places can be reached from
    the beginning is then a fold over a word's hits in order of their starts."""
    known = morphemes.select(F.col(morpheme).alias("__m")).filter("__m <> ''").distinct()
    lengths = [r[0] for r in known.select(F.length("__m").alias("n")).distinct().collect()]  # lengths, not morphemes
    w = words.select(F.col(word).alias("__w")).filter("__w is not null").distinct()
    cut = lambda n: F.transform(F.sequence(F.lit(1), F.length("__w") - n + 1), lambda i: F.struct((i - 1).alias("a"), F.substring(F.col("__w"), i, F.lit(n)).alias("s")))
    none = F.array().cast("array<struct<a:int,s:string>>")
    pieces = F.concat(*[F.when(F.length("__w") >= n, cut(n)).otherwise(none) for n in sorted(lengths)]) if lengths else none
    hits = w.select("__w", F.explode(pieces).alias("p")).select("__w", "p.a", "p.s").join(known, F.col("s") == F.col("__m")).groupBy("__w").agg(F.sort_array(F.collect_list(F.struct("a", (F.col("a") + F.length("s")).alias("b")))).alias("hits"))
    reached = F.aggregate("hits", F.array(F.lit(0)), lambda at, h: F.when(F.array_contains(at, h["a"]) & ~F.array_contains(at, h["b"]), F.concat(at, F.array(h["b"]))).otherwise(at))
    told = hits.filter(F.array_contains(reached, F.length("__w"))).select(F.col("__w").alias("__ok"))
    return words.join(told, F.col(word) == F.col("__ok"), "left").withColumn("breaks", F.col("__ok").isNotNull() | (F.col(word) == "")).drop("__ok")
