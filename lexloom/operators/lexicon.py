"""Morpheme lexicon from glossed text: tiers of units and parts aligned, then counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.binding import let
from lexloom.operators.counts import most_common_value, packed_counts

# Fixed values of the glossed corpus.
NOISE = ["", "―", "ー", "***", "...", "…", "?"]
UNIT, PART = r"\|\|", "-"


def clean_morpheme(c: Column) -> Column:
    quotes = "\"“”‘’「『」』"
    c = F.regexp_replace(F.trim(c), f"^[{quotes}]+|[{quotes}]+\\z", "")
    c = F.regexp_replace(F.regexp_replace(c, r"[,.?!;:]+\z", ""), f"^[{quotes}]+|[{quotes}]+\\z", "")
    return F.regexp_replace(c, r"(?U)\s+", "")


def morpheme_with_note(c: Column) -> Column:
    """struct(morpheme, note, drop): noise, refrain marks and Japanese are dropped; sources, optional parts, doubts and
    brackets are resolved and noted."""
    return let(clean_morpheme(c), _noted)


def _noted(raw: Column) -> Column:
    why = F.when(raw == "", "empty").when(raw.isin(NOISE), "noise_token").when(raw.rlike(r"^V(?:\d+)?(?:[:(].*)?\z"), "refrain_marker").when(raw.rlike("[ぁ-んァ-ン一-龯々〆ヵヶ]"), "japanese_transcript_noise")
    rules = [
        (r"^([A-Za-z=\-]+)\(<([^)>]+)>?\)\z", "$1", F.concat(F.lit("source:"), F.regexp_extract(raw, r"^([A-Za-z=\-]+)\(<([^)>]+)>?\)\z", 2))),
        (r"^\(([A-Za-z=]*)\)([A-Za-z=\-]+)\z", "$1$2", F.lit("optional_segment_unwrapped")),
        (r"^([A-Za-z=\-]+)\(\?\)\z", "$1", F.lit("uncertain_form_marker_removed")),
        (r"^([A-Za-z=\-]*)\[([A-Za-z=]+)\]([A-Za-z=\-]*)\z", "$1$2$3", F.lit("bracket_markup_removed")),
        (r"^NI\.([A-Za-z=\-]+)\z", "$1", F.lit("ni_prefix_annotation_removed")),
    ]

    def step(pattern: str, new: str, note: Column):
        noted = lambda x: F.concat(x["notes"], F.when(x["form"].rlike(pattern), F.array(note)).otherwise(F.array().cast("array<string>")))
        return lambda x: F.struct(F.regexp_replace(x["form"], pattern, new).alias("form"), noted(x).alias("notes"))

    told = F.struct(raw.alias("form"), F.array().cast("array<string>").alias("notes"))
    for rule in rules:
        told = let(told, step(*rule))

    def last(x: Column) -> Column:
        gone = x["form"].isin(NOISE)
        notes = F.when(gone, F.concat(x["notes"], F.array(F.lit("empty_after_normalization")))).otherwise(x["notes"])
        return F.struct(x["form"].alias("morpheme"), F.array_join(notes, " | ").alias("note"), gone.alias("drop"))

    clean = let(told, lambda x: last(F.struct(clean_morpheme(x["form"]).alias("form"), x["notes"].alias("notes"))))
    return F.when(why.isNotNull(), F.struct(raw.alias("morpheme"), why.alias("note"), F.lit(True).alias("drop"))).otherwise(clean)


def align(rows: DataFrame, morpheme: str = "morpheme", gloss_en: str = "gloss_en", gloss_jp: str = "gloss_jp", *carry: str) -> tuple[DataFrame, DataFrame]:
    """(aligned, unresolved). Tiers are cut into units, units into parts. Units align where all tiers have as many (an
    empty gloss tier counts as blanks); within a unit parts align where the English gloss has as many parts, a Japanese
    gloss of one part going to all. Else the unit is unresolved, with a reason."""
    blank = lambda c, n: F.when(F.coalesce(c, F.lit("")) == "", F.array_repeat(F.lit(""), n)).otherwise(F.split(c, UNIT))
    units = F.split(morpheme, UNIT)
    base = rows.filter(F.coalesce(F.col(morpheme), F.lit("")) != "").withColumn("__u", units).withColumn("__e", blank(F.col(gloss_en), F.size(units))).withColumn("__j", blank(F.col(gloss_jp), F.size(units)))
    same = (F.size("__u") == F.size("__e")) & (F.size("__u") == F.size("__j"))
    bad_rows = base.filter(~same).select(*carry, F.lit(-1).alias("unit"), F.col(morpheme).alias("text"), F.lit("unit_count_mismatch").alias("reason"))
    cells = base.filter(same).select(*carry, F.posexplode(F.arrays_zip("__u", "__e", "__j")).alias("unit", "z")).select(*carry, "unit", F.col("z.__u").alias("u"), F.col("z.__e").alias("e"), F.col("z.__j").alias("j"))
    p, e, j = F.split("u", PART), F.split("e", PART), F.split("j", PART)
    n = F.size(p)
    ej = F.when(n == 1, F.array("e")).when(F.size(e) == n, e).when(F.trim("e") == "", F.array_repeat(F.lit(""), n))
    jj = F.when(n == 1, F.array("j")).when(F.size(j) == n, j).when(F.size(j) == 1, F.array_repeat(F.col("j"), n))
    cells = cells.withColumn("p", p).withColumn("ep", ej).withColumn("jp", jj)
    ok = F.col("ep").isNotNull() & F.col("jp").isNotNull()
    bad_units = cells.filter(~ok).select(*carry, "unit", F.col("u").alias("text"), F.lit("part_count_mismatch").alias("reason"))
    good = cells.filter(ok).select(*carry, "unit", F.posexplode(F.arrays_zip("p", "ep", "jp")).alias("part", "z"))
    # what is dropped is told inside an array, so that the filter doesn't work the rules out a second time
    kept = F.filter(F.array(morpheme_with_note(F.col("z.p"))), lambda m: ~m["drop"] & (m["morpheme"] != ""))
    told = good.select(*carry, "unit", "part", F.col("z.p").alias("raw"), F.trim("z.ep").alias("gloss_en"), F.trim("z.jp").alias("gloss_jp"), F.explode(kept).alias("m"))
    aligned = told.select(*carry, "unit", "part", F.col("m.morpheme").alias("morpheme"), F.col("m.note").alias("note"), "raw", "gloss_en", "gloss_jp")
    return aligned, bad_rows.unionByName(bad_units)


def lexicon(aligned: DataFrame, sentence: str, ord_: str) -> DataFrame:
    """morpheme, occurrences, sentences, primary gloss, glosses with counts, example sentence (the first with a gloss, else
    the first)."""
    base = aligned.groupBy("morpheme").agg(F.count(F.lit(1)).alias("occurrences"), F.count_distinct(sentence).alias("sentences"), F.min_by(sentence, F.struct(F.coalesce(F.col("gloss_en"), F.lit("")) == "", F.col(ord_))).alias("example"))
    main = most_common_value(aligned, "morpheme", "gloss_en", ord_).withColumnRenamed("gloss_en", "primary_gloss")
    all_ = packed_counts(aligned, "morpheme", "gloss_en", ord_, "glosses")
    return base.join(main, "morpheme").join(all_, "morpheme", "left").na.fill("", ["glosses"])


def grouped_forms(rows: DataFrame, lemma: str, gloss: str, form: str) -> DataFrame:
    """lemma, glosses: for each gloss its sorted forms."""
    inner = rows.groupBy(lemma, gloss).agg(F.array_sort(F.collect_set(form)).alias("forms"))
    return inner.groupBy(lemma).agg(F.sort_array(F.collect_list(F.struct(gloss, "forms"))).alias("glosses"))


def distinct_glosses(rows: DataFrame, lemma: str, glosses: str) -> DataFrame:
    """lemma, glosses: how many different glosses the lists of a lemma hold."""
    return rows.select(lemma, F.explode(glosses).alias("__g")).groupBy(lemma).agg(F.count_distinct("__g").alias("glosses"))
