"""Record linkage between dictionaries: stages from exact keys to substrings, each for what the last one left.

Queries have (id, lemma, gloss) and perhaps kana; entries have (entry, source, base_conf, ord, lemma, definition) and
perhaps lemma_kana. Each stage yields (id, entry, kind, score); of equal scores the entry first in order wins. Old forms
of characters are read as new ones by `old` and `new`, two strings of equal length (a table of pairs, see
readers.kanji_pairs). What a stage finds for a query depends on its content alone, so each distinct content is matched once
and its best entry goes to all ids that have it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.orthography import edit1_keys, gloss_lookup_variants, gloss_tokens_en, gloss_tokens_ja, jaccard, kana_key, latin_key, lookup_keys, primary_gloss, stem_variants, substrings, variants

# Sources whose one-word concepts make gloss matches by chance.
BLOCKED = ("asjp", "pannous_swadesh", "shimabukuro_proto")
# Distinct queries that are broadcast; more are joined by sorting, as sizes of compressed files tell too little of them.
FEW = 1000


def best(matches: DataFrame) -> DataFrame:
    return _ranked(matches).select("id", "entry", "kind", "score")


def _ranked(matches: DataFrame) -> DataFrame:
    return matches.groupBy("id").agg(F.min_by(F.struct("entry", "kind", "score", "step", "ord"), F.struct(-F.col("score"), F.col("step"), F.col("ord"), F.col("entry"))).alias("r")).select("id", "r.*")


def _contents(q: DataFrame, columns: list[str]) -> tuple[DataFrame, str]:
    """Distinct rows of the columns, each with an id of its own, and how they are joined. Ids of queries may repeat, so a
    hash tells contents of the same least id apart."""
    rows = q.groupBy(*columns).agg(F.min("id").alias("id"))
    # behind inline() no filter on keys or tokens, which are costly, moves in front of the grouping
    rows = rows.select(F.struct("id", F.xxhash64(*columns).alias("hash")).alias("id"), F.inline(F.array(F.struct(*columns))))
    how = "broadcast" if rows.limit(FEW + 1).count() <= FEW else "merge"
    return rows.hint(how), how


def _dealt(q: DataFrame, contents: DataFrame, found: DataFrame, columns: list[str], how: str, join: str) -> DataFrame:
    """q's ids with what was found for their content."""
    told = contents.join(found, "id").drop("id").withColumnsRenamed({c: f"__{c}" for c in columns})
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return q.select("id", *columns).join(told.hint(how), same, join).drop(*columns, *told.columns[: len(columns)])


def _once(q: DataFrame, columns: list[str], rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The best of rows(q), where rows() depends on the columns: it gets each distinct content once."""
    contents, how = _contents(q, columns)
    return best(_dealt(q, contents, _ranked(rows(contents)), columns, how, "inner"))


def _scored(pairs: DataFrame, kind: str, base: Column, weight: float, least: float, most: float, step: Column | int = 0) -> DataFrame:
    overlap = jaccard(F.col("tokens"), F.col("etokens"))
    rows = pairs.withColumn("overlap", overlap).filter(F.col("overlap") >= least)
    step = F.lit(step) if isinstance(step, int) else step
    return rows.select("id", "entry", "ord", step.alias("step"), F.lit(kind).alias("kind"), F.round(F.least(F.lit(most), base + weight * F.col("overlap")), 6).alias("score"))


def _given(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit("")


def _tokens(text: Column, old: str, new: str) -> Column:
    return F.array_union(gloss_tokens_en(text), gloss_tokens_ja(text, old=old, new=new))


def prepared_queries(queries: DataFrame, old: str = "", new: str = "") -> DataFrame:
    return queries.select("id", "lemma", lookup_keys(F.col("lemma")).alias("keys"), kana_key(_given(queries, "kana")).alias("kana"), _tokens(F.col("gloss"), old, new).alias("tokens"), primary_gloss(F.col("gloss"), old, new).alias("primary"))


def prepared_entries(entries: DataFrame, old: str = "", new: str = "") -> DataFrame:
    """Entries with their keys and the tokens of their definitions; `terms`: those by which a gloss finds them, from the
    whole definition; and `index`, for the primary stage: the first eight English and the first eight Japanese ones."""
    d = F.col("definition")
    en, ja = gloss_tokens_en(d), gloss_tokens_ja(d, old=old, new=new)
    fit = lambda t: F.length(t).between(3, 20)
    index, terms = F.array_union(F.filter(F.slice(en, 1, 8), fit), F.slice(ja, 1, 8)), F.array_union(F.filter(en, fit), ja)
    return entries.select("entry", "source", "base_conf", "ord", latin_key(F.col("lemma")).alias("ekey"), kana_key(_given(entries, "lemma_kana")).alias("ekana"), F.array_union(en, ja).alias("etokens"), terms.alias("terms"), index.alias("index"), primary_gloss(d, old, new).alias("eprimary"), F.length("definition").alias("long"))


def ota_words(entries: DataFrame, title: str = "title", description: str = "description") -> DataFrame:
    """word, definition: the Latin words of three to twenty letters inside a Japanese entry's description, each time they
    are there, with the entry's title."""
    words = F.regexp_extract_all(F.coalesce(F.col(description), F.lit("")), F.lit(r"\b[a-z][a-z\-']{2,}\b"), F.lit(0))
    return entries.filter(F.coalesce(F.col(title), F.lit("")) != "").select(F.explode(words).alias("word"), F.col(title).alias("definition")).filter(F.length("word") <= 20)


def first_variant(queries: DataFrame, latin: list[DataFrame], kana: DataFrame, old: str = "", new: str = "") -> DataFrame:
    """id, entry, kind, score of the oldest matcher: spellings in order, and of one spelling the Latin sources in order;
    the first that hits holds, with its entry of most gloss overlap; where none hits, the kana source."""
    q = queries.select("id", _tokens(F.col("gloss"), old, new).alias("tokens"), kana_key(_given(queries, "kana")).alias("kana"), F.array_distinct(F.flatten(F.transform(variants(F.col("lemma")), lambda v: stem_variants(latin_key(v))))).alias("keys"))
    keys = q.select("id", "tokens", F.posexplode("keys").alias("at", "key")).filter("key <> ''")
    sources = [prepared_entries(e, old, new).withColumn("nth", F.lit(i)) for i, e in enumerate(latin)]
    every = sources[0]
    for e in sources[1:]:
        every = every.unionByName(e)
    hit = _scored(keys.join(every, F.col("key") == F.col("ekey")), "latn", F.col("base_conf"), 0.15, 0.0, 1.0, F.struct("at", "nth"))
    told = hit.groupBy("id").agg(F.min_by(F.struct("entry", "kind", "score"), F.struct("step", -F.col("score"), F.col("ord"), F.col("entry"))).alias("r")).select("id", "r.*")
    other = prepared_entries(kana, old, new)
    by_kana = best(_scored(q.filter("kana <> ''").join(other, F.col("kana") == F.col("ekana")), "kana", F.lit(0.7), 0.2, 0.0, 1.0))
    return told.unionByName(by_kana.join(told.select("id"), "id", "left_anti"))


def exact_stage(q: DataFrame, e: DataFrame, ota: DataFrame | None = None, old: str = "", new: str = "") -> DataFrame:
    """Any key of the query is the entry's key, or the kana are the entry's, or a key is a Latin word inside a Japanese
    entry; the largest score of all."""
    return _once(q, ["keys", "kana", "tokens"], lambda x: _exact(x, e, ota, old, new))


def _exact(q: DataFrame, e: DataFrame, ota: DataFrame | None, old: str, new: str) -> DataFrame:
    keys = q.select("id", "tokens", F.explode("keys").alias("key"))
    found = _scored(keys.join(e, F.col("key") == F.col("ekey")), "latn", F.col("base_conf"), 0.10, 0.0, 1.0)
    by_kana = q.filter("kana <> ''").join(e, F.col("kana") == F.col("ekana"))
    found = found.unionByName(_scored(by_kana, "kana", F.col("base_conf") - 0.05, 0.15, 0.0, 1.0, 1))
    if ota is not None:
        inside = ota.select("word", "definition").distinct()
        inside = inside.select("word", F.concat(F.lit("ota:"), "definition").alias("entry"), F.lit(0).cast("long").alias("ord"), _tokens(F.col("definition"), old, new).alias("etokens"))
        found = found.withColumn("entry", F.col("entry").cast("string")).unionByName(_scored(keys.filter(F.length("key") >= 3).join(inside, F.col("key") == F.col("word")), "ota_reverse", F.lit(0.65), 0.20, 0.0, 0.95, 2))
    return found


def edit_stage(q: DataFrame, e: DataFrame, least_length: int = 5) -> DataFrame:
    """Keys within one edit: both sides spread to their one-deletion neighbourhoods, met by equality, then checked."""
    return best(_edit(q, e, least_length))


def _edit(q: DataFrame, e: DataFrame, least_length: int = 5) -> DataFrame:
    left = q.select("id", "tokens", F.explode("keys").alias("key")).filter(F.length("key") >= least_length).withColumn("near", F.explode(edit1_keys(F.col("key"))))
    right = e.filter(F.length("ekey") >= least_length - 1).withColumn("enear", F.explode(edit1_keys(F.col("ekey"))))
    pairs = left.join(right, F.col("near") == F.col("enear")).filter(F.levenshtein("key", "ekey", 1) == 1)
    return _scored(pairs, "fuzzy_edit1", F.col("base_conf") - 0.20, 0.20, 0.10, 0.90)


def gloss_stage(q: DataFrame, e: DataFrame, blocked: tuple[str, ...] = BLOCKED, en_weight: int = 1, ja_weight: int = 2, least_weight: int = 3, least_overlap: float = 0.18) -> DataFrame:
    """Glosses that share tokens with any part of a definition: shared weight (Japanese double) first, then the larger of
    recall and Jaccard."""
    return _once(q, ["tokens"], lambda x: _gloss(x, e, blocked, en_weight, ja_weight, least_weight, least_overlap))


def _gloss(q: DataFrame, e: DataFrame, blocked: tuple[str, ...], en_weight: int = 1, ja_weight: int = 2, least_weight: int = 3, least_overlap: float = 0.18) -> DataFrame:
    e = e.filter(~F.col("source").isin(*blocked)) if blocked else e
    # of entries with equal tokens only the first can be the best; the hash is first as it is quick to sort by
    rows = e.groupBy(F.xxhash64("etokens", "terms").alias("hash"), "etokens", "terms").agg(F.min(F.struct("ord", "entry")).alias("r"))
    flagged = F.concat(F.transform("terms", lambda t: F.struct(t.alias("etok"), F.lit(True).alias("term"))), F.transform(F.array_except("etokens", "terms"), lambda t: F.struct(t.alias("etok"), F.lit(False).alias("term"))))
    rows = rows.select("hash", "r.*", F.size("etokens").alias("n"), F.inline(flagged))
    weight = F.when(F.col("tok").rlike("[^\\x00-\\x7F]"), ja_weight).otherwise(en_weight)
    asked = q.select("id", F.size("tokens").alias("m"), F.explode("tokens").alias("tok")).withColumn("w", weight)
    # recall is the larger one, as both sides together have no fewer tokens than the entry; nor are more shared than asked
    pairs = asked.join(rows, (F.col("tok") == F.col("etok")) & (F.col("m") / F.col("n") >= least_overlap))
    told = pairs.groupBy("id", "entry", "ord", "hash", "n").agg(F.sum(F.when(F.col("term"), F.col("w")).otherwise(0)).alias("w"), F.count(F.lit(1)).alias("shared"))
    overlap = F.col("shared") / F.col("n")
    found = told.filter((F.col("w") >= least_weight) & (overlap >= least_overlap))
    return found.select("id", "entry", "ord", F.lit(0).alias("step"), F.lit("reverse_gloss").alias("kind"), F.round(F.least(F.lit(0.78), 0.50 + 0.25 * overlap), 6).alias("score"))


def primary_stage(q: DataFrame, e: DataFrame, blocked: tuple[str, ...] = BLOCKED, longest: int = 8) -> DataFrame:
    """The first Japanese run of the query's gloss (of eight letters at most), also without verbal endings and its kanji
    alone, is an indexed token or such a first run of a definition; short definitions and the run itself count more."""
    return best(_primary(q, e, blocked, longest))


def _primary(q: DataFrame, e: DataFrame, blocked: tuple[str, ...], longest: int = 8) -> DataFrame:
    e = e.filter(~F.col("source").isin(*blocked)) if blocked else e
    own = F.when(F.length("eprimary").between(1, longest), F.filter(gloss_lookup_variants(F.col("eprimary")), lambda x: F.length(x) <= longest)).otherwise(F.array().cast("array<string>"))
    index = e.select("entry", "ord", "base_conf", "long", F.explode(F.array_union("index", own)).alias("etok"))
    asked = q.filter(F.length("primary").between(1, longest)).select("id", "primary", F.posexplode(gloss_lookup_variants(F.col("primary"))).alias("step", "tok"))
    score = F.least(F.lit(0.72), F.col("base_conf") - 0.20 + F.when(F.col("long") > 80, 0.0).otherwise(0.05) + F.when(F.col("tok") == F.col("primary"), 0.04).otherwise(0.0))
    return asked.join(index, F.col("tok") == F.col("etok")).select("id", "entry", "ord", "step", F.lit("primary_ja").alias("kind"), F.round(score, 6).alias("score"))


def substring_stage(q: DataFrame, e: DataFrame, least_length: int = 6) -> DataFrame:
    """An entry's key is a substring (4 to 7 letters) of a long key."""
    return best(_substring(q, e, least_length))


def _substring(q: DataFrame, e: DataFrame, least_length: int = 6) -> DataFrame:
    left = q.select("id", "tokens", F.explode("keys").alias("key")).filter(F.length("key") >= least_length)
    left = left.withColumn("sub", F.explode(substrings(F.col("key")))).select("id", "tokens", "sub").distinct()
    pairs = left.join(e, F.col("sub") == F.col("ekey"))
    return _scored(pairs, "substring", F.col("base_conf") - 0.25, 0.25, 0.15, 0.70)


def cascade(queries: DataFrame, entries: DataFrame, manual: DataFrame | None = None, ota: DataFrame | None = None, blocked: tuple[str, ...] = BLOCKED, old: str = "", new: str = "") -> DataFrame:
    """id, entry, kind, score for all queries (nulls where nothing fits): the result of the first stage that has one, then
    of manual pairs (lemma, entry). Every stage is planned once and reads the prepared tables; the first stage of each
    query is an aggregate, so no stage runs again to tell what it left. A query without id stays unmatched; rows of one id
    share the first result of all."""
    columns = [c for c in ("lemma", "kana", "gloss") if c in queries.columns]
    contents, how = _contents(queries, columns)
    q, e = prepared_queries(contents, old, new), prepared_entries(entries, old, new)
    stages = [_exact(q, e, ota, old, new), _edit(q, e), _gloss(q, e, blocked), _primary(q, e, blocked), _substring(q, e)]
    if manual is not None:
        pairs = manual.select(F.rtrim("lemma").alias("__m"), F.col("entry")).groupBy("__m").agg(F.min("entry").alias("entry"))
        stages.append(contents.join(pairs, F.rtrim("lemma") == F.col("__m")).select("id", "entry", F.lit(0).cast("long").alias("ord"), F.lit(0).alias("step"), F.lit("manual").alias("kind"), F.lit(1.0).alias("score")))
    out = None
    for i, found in enumerate(stages):
        entry = F.col("entry").cast("string") if ota is not None else F.col("entry")
        found = _ranked(found).select("id", F.lit(i).alias("stage"), F.struct(entry.alias("entry"), "kind", "score", "step", "ord").alias("r"))
        out = found if out is None else out.unionByName(found)
    first = out.groupBy("id").agg(F.min_by(F.struct("r", "stage"), "stage").alias("f")).select("id", "f.*")
    rows = _dealt(queries, contents, first, columns, how, "left")
    rank = F.when(F.col("stage").isNotNull(), F.struct("stage", -F.col("r.score"), F.col("r.step"), F.col("r.ord"), F.col("r.entry")))
    told = F.when(F.col("id").isNotNull(), F.min_by("r", rank).over(Window.partitionBy("id")))
    return rows.select("id", told.alias("r")).select("id", "r.entry", "r.kind", "r.score")


def match_summary(matches: DataFrame, by: str = "kind") -> DataFrame:
    """by, n, percent of all rows, of those that matched."""
    total = matches.agg(F.count(F.lit(1)).alias("all"))
    return matches.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(total)).select(by, "n", F.round(100.0 * F.col("n") / F.col("all"), 4).alias("percent"))
