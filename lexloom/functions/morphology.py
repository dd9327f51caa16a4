"""Lemmas and features of words: literal tables, looked up by expression or by join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.tokens import normalize

# Valency of a part of speech (absent: none).
VALENCY = {
    "vi": "+1", "vt": "+2", "vd": "+3", "vc": "0", "auxv": "0", "cop": "+2", "n": "-1", "nl": "-1", "nmlz": "-1",
    "pron": "-1", "propn": "-1", "adn": "+1", "adv": "0", "cconj": "0", "post": "+1", "sfp": "0", "intj": "0",
    "sconj": "0", "padv": "+1", "root": "-1", "advp": "0", "parti": "0",
}
# Features of the personal affixes.
PERSONS = {
    "a=": {"Person": "4", "Number": "Plur", "Clusivity": "In", "Case": "Erg", "Valency": "-1"},
    "an=": {"Person": "4", "Number": "Plur", "Clusivity": "In", "Case": "Erg", "Valency": "-1"},
    "=an": {"Person": "4", "Number": "Plur", "Clusivity": "In", "Case": "Nom", "Valency": "-1"},
    "i=": {"Person": "4", "Number": "Plur", "Clusivity": "In", "Case": "Acc", "Valency": "-1"},
    "ku=": {"Person": "1", "Number": "Sing", "Case": "Nom", "Valency": "-1"},
    "en=": {"Person": "1", "Number": "Sing", "Case": "Acc", "Valency": "-1"},
    "ci=": {"Person": "1", "Number": "Sing", "Clusivity": "Ex", "Case": "Nom", "Valency": "-1"},
    "=as": {"Person": "1", "Number": "Plur", "Clusivity": "Ex", "Case": "Nom", "Valency": "-1"},
    "un=": {"Person": "1", "Number": "Plur", "Clusivity": "Ex", "Case": "Acc", "Valency": "-1"},
    "e=": {"Person": "2", "Number": "Sing", "Valency": "-1"},
    "eci=": {"Person": "2", "Number": "Plur", "Valency": "-1"},
}
VERBS = ["v", "vi", "vt", "vd", "vc"]
# Universal tag -> parts of speech; of two tags for one part the later holds.
UPOS = {
    "VERB": ["vi", "vd", "vc", "v", "verb"],
    "NOUN": ["n", "nl", "nmlz", "noun"],
    "PRON": ["pron", "int"],
    "PROPN": ["propn"],
    "DET": ["adn", "determiner"],
    "ADV": ["adv"],
    "CCONJ": ["cconj"],
    "SCONJ": ["cconj", "sconj", "padv"],
    "POST": ["post"],
    "AUX": ["auxv", "cop"],
    "PART": ["sfp", "pers"],
    "INTJ": ["intj"],
    "ADP": ["advp", "postp", "parti"],
    "NUM": ["num"],
    "PUNCT": ["punct"],
}


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def upos(xpos: Column, corrected: bool = False) -> Column:
    """The universal tag of a part of speech, `_` if there is none. `vt` has none unless corrected."""
    table = {p: u for u, ps in UPOS.items() for p in ps} | ({"vt": "VERB"} if corrected else {})
    return F.coalesce(F.element_at(literal_map(table), xpos), F.lit("_"))


def valency(pos: Column) -> Column:
    return F.element_at(literal_map(VALENCY), pos)


def closed_possessives(rows: list[tuple[str, str, str]]) -> dict[str, str]:
    """form -> lemma of a table (lemma, short, long), read top to bottom: a rewritten word is held against later rows.
    An empty long form matches nothing."""
    out: dict[str, str] = {}
    for form in {f for _, s, g in rows for f in (s, g) if f}:
        word = form
        for lemma, short, long in rows:
            if word in (short, long):
                word = lemma
        out[form] = word
    return out


def lemmatize(words: DataFrame, possessives: DataFrame | None = None, plurals: DataFrame | None = None, word: str = "word", pos: str = "pos") -> DataFrame:
    """words with `lemma` and `features` (map, null-free). `possessives` has (form, lemma), see closed_possessives();
    `plurals` has (ord, singular, plural, valency), the first row that fits holds. Both are lookup tables; Spark
    broadcasts them by their size. A personal affix replaces all other features. An empty word is its own lemma."""
    out = words.withColumn("__w", normalize(F.col(word)))
    if possessives is not None:
        own = possessives.groupBy("form").agg(F.min("lemma").alias("__poss"))
        out = out.join(own, (F.col("__w") == F.col("form")) & (F.col(pos) == "n"), "left").drop("form")
    else:
        out = out.withColumn("__poss", F.lit(None).cast("string"))
    if plurals is not None:
        either = plurals.select("ord", "singular", "valency", F.col("singular").alias("form"), F.lit("Sing").alias("number")).unionByName(plurals.select("ord", "singular", "valency", F.col("plural").alias("form"), F.lit("Plur").alias("number")))
        first = either.groupBy("form").agg(F.min_by(F.struct("singular", "number", "valency"), F.struct("ord", F.when(F.col("number") == "Sing", 0).otherwise(1))).alias("__pl"))
        out = out.join(first, (F.col("__w") == F.col("form")) & F.col(pos).isin(VERBS), "left").drop("form")
    else:
        out = out.withColumn("__pl", F.lit(None).cast("struct<singular:string,number:string,valency:string>"))
    persons = F.create_map(*[x for k, v in PERSONS.items() for x in (F.lit(k), literal_map(v))])
    person = F.element_at(persons, F.col("__w"))
    plain = F.map_filter(F.create_map(F.lit("Valency"), F.coalesce(F.col("__pl.valency"), valency(F.col(pos))), F.lit("Number"), F.col("__pl.number"), F.lit("Possessed"), F.when(F.col("__poss").isNotNull(), "Yes")), lambda k, v: v.isNotNull())
    lemma = F.coalesce(F.col("__pl.singular"), F.col("__poss"), F.col("__w"))
    empty = F.coalesce(F.col(word), F.lit("")) == ""
    return (
        out.withColumn("lemma", F.when(empty, F.col(word)).otherwise(lemma))
        .withColumn("features", F.when(empty, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).when(F.col("__pl").isNull() & person.isNotNull(), person).otherwise(plain))
        .drop("__w", "__poss", "__pl")
    )


def feature_string(features: Column) -> Column:
    """Sorted key=value pairs joined by |, `_` if there are none; maps can't be compared, this can."""
    pairs = F.array_join(F.transform(F.array_sort(F.map_entries(features)), lambda e: F.concat_ws("=", e["key"], e["value"])), "|")
    return F.when(F.size(features) > 0, pairs).otherwise(F.lit("_"))
