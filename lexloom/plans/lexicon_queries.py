"""Lexicon, fusion and linkage queries on the driver's tables, each with its equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import morphology, orthography
from lexloom.functions import tokens as tk
from lexloom.operators import counts, fusion, lexicon, linkage, search
from lexloom.plans.corpus_queries import _BW, _L, _WC, _WORDS, TOKENS, Query, _word_counts, _words, table

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_POS = [("the", "adn"), ("and", "cconj"), ("of", "postp"), ("in", "postp"), ("is", "cop"), ("to", "postp"), ("der", "adn"), ("die", "adn"), ("la", "adn"), ("le", "adn"), ("que", "sconj"), ("token", "n")]
_POS_SQL = "pos(lemma, p) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _POS) + ")"


@query(f"WITH {TOKENS}, {_POS_SQL}, t AS (SELECT form, count(*) AS n FROM forms GROUP BY form) SELECT form, n, CASE WHEN p IS NULL THEN [] ELSE [p] END AS poss FROM t LEFT JOIN pos ON form = lemma WHERE n >= 2")
def pos_lookup_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of speech of forms, empty where unknown."""
    c = counts.form_counts(table(spark, sf_dir, "documents"), "text").filter("n >= 2")
    pos = spark.createDataFrame(_POS, "lemma string, p string")
    return c.join(pos, F.col("form") == F.col("lemma"), "left").select("form", "n", F.when(F.col("p").isNull(), F.array().cast("array<string>")).otherwise(F.array("p")).alias("poss"))


@query(f"WITH {TOKENS}, {_POS_SQL} SELECT p AS pos, count(*) AS n, count(DISTINCT token) AS types FROM tok JOIN pos ON token = lemma GROUP BY p")
def gloss_lookup_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups under the form as written, and a histogram of what was found."""
    t = counts.token_rows(table(spark, sf_dir, "documents"), "text", "doc_id")
    return t.join(spark.createDataFrame(_POS, "lemma string, p string"), F.col("token") == F.col("lemma")).groupBy(F.col("p").alias("pos")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("token").alias("types"))


# What each part of speech must become, told one by one.
_TAGS = [
    ("vi", "VERB"), ("vd", "VERB"), ("vc", "VERB"), ("v", "VERB"), ("verb", "VERB"), ("n", "NOUN"), ("nl", "NOUN"), ("nmlz", "NOUN"), ("noun", "NOUN"), ("pron", "PRON"), ("int", "PRON"), ("propn", "PROPN"),
    ("adn", "DET"), ("determiner", "DET"), ("adv", "ADV"), ("cconj", "SCONJ"), ("sconj", "SCONJ"), ("padv", "SCONJ"), ("post", "POST"), ("auxv", "AUX"), ("cop", "AUX"), ("sfp", "PART"), ("pers", "PART"),
    ("intj", "INTJ"), ("advp", "ADP"), ("postp", "ADP"), ("parti", "ADP"), ("num", "NUM"), ("punct", "PUNCT"), ("vt", "_"), ("unknown", "_"),
]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _TAGS) + ") t(xpos, upos)")
def pos_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags mapped to universal ones, the later of two mappings holding."""
    return spark.createDataFrame([(a,) for a, _ in _TAGS], "xpos string").select("xpos", morphology.upos(F.col("xpos")).alias("upos"))


_LEMMA_WORDS = [("w_a", "sconj"), ("h_ine", "sconj"), ("ne[y]", "cop"), ("awa[n]", "sconj"), ("[u]", "intj"), ("ne'ampe", "n"), ("inkar'", "vi"), ("oka", "vi"), ("okay", "vi"), ("mat", "n"), ("maci", "n"), ("macihi", "n"), ("a=", "pers"), ("eci=", "pers"), ("ek", "vi"), ("arki", "vi")]
_LEMMA_RESULT = [
    ("w_a", "sconj", "wa", "Valency=0"), ("h_ine", "sconj", "hine", "Valency=0"), ("ne[y]", "cop", "ne", "Valency=+2"), ("awa[n]", "sconj", "awa", "Valency=0"), ("[u]", "intj", "u", "Valency=0"),
    ("ne''ampe", "n", "neanpe", "Valency=-1"), ("inkar''", "vi", "inkar", "Valency=+1"), ("oka", "vi", "an", "Number=Plur|Valency=+1"), ("okay", "vi", "an", "Number=Plur|Valency=+1"), ("mat", "n", "mat", "Valency=-1"),
    ("maci", "n", "mat", "Possessed=Yes|Valency=-1"), ("macihi", "n", "mat", "Possessed=Yes|Valency=-1"), ("a=", "pers", "a=", "Case=Erg|Clusivity=In|Number=Plur|Person=4|Valency=-1"),
    ("eci=", "pers", "eci=", "Number=Plur|Person=2|Valency=-1"), ("ek", "vi", "ek", "Number=Sing|Valency=+1"), ("arki", "vi", "ek", "Number=Plur|Valency=+1"),
]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}', '{d}')" for a, b, c, d in _LEMMA_RESULT) + ") t(word, pos, lemma, features)")
def lemmatize_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lemmas and features of words with possessive, plural and person tables."""
    words = spark.createDataFrame(_LEMMA_WORDS, "word string, pos string")
    poss = spark.createDataFrame(list(morphology.closed_possessives([("mat", "maci", "macihi"), ("ak", "aki", "akihi")]).items()), "form string, lemma string")
    plurals = spark.createDataFrame([(0, "an", "oka", "+1"), (1, "an", "okay", "+1"), (2, "ek", "arki", "+1")], "ord int, singular string, plural string, valency string")
    out = morphology.lemmatize(words, poss, plurals)
    return out.select("word", "pos", "lemma", morphology.feature_string(F.col("features")).alias("features"))


@query("WITH s AS (SELECT 0 AS src, left(p_name, 5) AS k, p_type AS v FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT 1, left(p_name, 5), p_brand FROM part WHERE p_partkey % 3 = 1 UNION ALL SELECT 2, left(p_name, 5), p_name FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY coalesce(v, '') = '', src, v) AS o FROM s) SELECT k, v, CAST(src AS INTEGER) AS source FROM r WHERE o = 1")
def gloss_coalesce_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source by priority that has a value."""
    p = table(spark, sf_dir, "part")
    k = F.left("p_name", F.lit(5)).alias("k")
    return fusion.coalesce_by_priority([p.filter("p_partkey % 3 = 0").select(k, F.col("p_type").alias("v")), p.filter("p_partkey % 3 = 1").select(k, F.col("p_brand").alias("v")), p.select(k, F.col("p_name").alias("v"))], "k", "v")


@query("WITH a AS (SELECT n_name AS k, 'affix' AS v FROM nation WHERE n_nationkey % 4 = 0), b AS (SELECT n_name AS k, 'manual' AS v FROM nation WHERE n_nationkey % 3 = 0), c AS (SELECT n_name AS k, 'wiki' AS v FROM nation WHERE n_nationkey % 2 = 0) SELECT n_name, coalesce(a.v, b.v, c.v) AS value, CASE WHEN a.v IS NOT NULL THEN 'special' WHEN b.v IS NOT NULL THEN 'manual' WHEN c.v IS NOT NULL THEN 'wiktionary' END AS rule FROM nation LEFT JOIN a ON n_name = a.k LEFT JOIN b ON n_name = b.k LEFT JOIN c ON n_name = c.k")
def gloss_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain of lookups, with the rule that hit."""
    n = table(spark, sf_dir, "nation")
    t = lambda m, v: n.filter(f"n_nationkey % {m} = 0").select(F.col("n_name").alias("k"), F.lit(v).alias("v"))
    return fusion.lookup_cascade(n.select("n_name"), "n_name", [("special", t(4, "affix")), ("manual", t(3, "manual")), ("wiktionary", t(2, "wiki"))])


@query("WITH a AS (SELECT p_partkey AS k, [p_brand] AS l, p_size AS f FROM part WHERE p_partkey % 2 = 0), b AS (SELECT p_partkey AS k, [p_type] AS l, CASE WHEN p_size > 25 THEN p_size * 2 ELSE 0 END AS f FROM part WHERE p_partkey % 3 = 0) SELECT coalesce(a.k, b.k) AS k, coalesce(a.l, []) || coalesce(b.l, []) AS l, coalesce(nullif(b.f, 0), a.f, 0) AS f FROM a FULL JOIN b ON a.k = b.k")
def upsert_merge_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists appended, values overwritten unless empty, new keys inserted."""
    p = table(spark, sf_dir, "part")
    a = p.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("k"), F.array("p_brand").alias("l"), F.col("p_size").alias("f"))
    b = p.filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("k"), F.array("p_type").alias("l"), F.when(F.col("p_size") > 25, F.col("p_size") * 2).otherwise(0).alias("f"))
    return fusion.upsert(a, b, "k", ["l"], ["f"]).na.fill(0, ["f"])


@query("WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) SELECT o_custkey, o_orderkey, o_orderpriority FROM o WHERE r = 1")
def overlay_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several overlays of a key the last holds."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return fusion.last_wins(o, "o_custkey", "o_orderkey")


@query(f"WITH {_WC}, {_BW}, x AS (SELECT w AS lemma, replace(w, 'mp', 'np') AS n FROM bw ANTI JOIN counted ON w = form), y AS (SELECT * FROM x ANTI JOIN (SELECT DISTINCT replace(form, 'mp', 'np') AS n FROM counted) k USING (n)) SELECT min(lemma) AS lemma FROM y GROUP BY n")
def anti_new_headwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the benchmark that documents have neither as they are nor normalized."""
    found = table(spark, sf_dir, "benchmark").select(F.explode(_words()).alias("lemma")).distinct()
    known = _word_counts(spark, sf_dir).select(F.col("form").alias("lemma"))
    return fusion.new_headwords(found, known, "lemma", F.replace("lemma", F.lit("mp"), F.lit("np")))


@query("SELECT c_custkey, c_name, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def star_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms with their parameters and languages, a star of left joins."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return c.select("c_custkey", "c_name", "n_name", "r_name")


@query("WITH k AS (SELECT c_custkey AS id, unnest([c_custkey * 7, c_custkey * 3, c_custkey]) AS key, unnest([1, 2, 3]) AS o FROM customer), t AS (SELECT s_suppkey AS key, s_nationkey AS n FROM supplier WHERE s_nationkey <> 0), h AS (SELECT id, o, key, n, row_number() OVER (PARTITION BY id ORDER BY n IS NULL, o) AS r FROM k LEFT JOIN t USING (key)) SELECT id, coalesce(n, 0) AS n, CASE WHEN n IS NOT NULL THEN key ELSE -1 END AS key FROM h WHERE r = 1")
def frequency_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value under the first of several keys that has one."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    t = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("n"))
    return fusion.fallback_lookup(c, F.array(F.col("id") * 7, F.col("id") * 3, F.col("id")), t, "id").na.fill(-1, ["key"])


_FORMS = f"""WITH {_WC}, t AS (SELECT form AS lemma, n AS frequency FROM counted WHERE n >= 3), l AS (SELECT DISTINCT a.lemma AS form, left(a.lemma, length(a.lemma) - 2) AS root FROM t a WHERE a.lemma LIKE '_%ed'),
ok AS (SELECT l.*, f.frequency AS fn FROM l JOIN t f ON f.lemma = l.form JOIN t r ON r.lemma = l.root WHERE l.form <> l.root AND l.form NOT IN (SELECT root FROM l)),
nested AS (SELECT root, list(form ORDER BY fn DESC, form) AS forms, sum(fn) AS s FROM ok GROUP BY root)
SELECT t.lemma, t.frequency, coalesce(forms, []) AS forms, CAST(t.frequency + coalesce(s, 0) AS BIGINT) AS rolled FROM t LEFT JOIN nested ON t.lemma = root WHERE t.lemma NOT IN (SELECT form FROM ok)"""


def _nested(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    terms = _word_counts(spark, sf_dir).filter("n >= 3").select(F.col("form").alias("lemma"), F.col("n").alias("frequency"))
    links = terms.filter("lemma like '_%ed'").select(F.col("lemma").alias("form"), F.expr("left(lemma, length(lemma) - 2)").alias("root"), F.lit("valency").alias("type"))
    return terms, fusion.nest_forms(terms, links)


@query(_FORMS)
def nested_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms nested in their roots, largest first, with rolled counts."""
    return _nested(spark, sf_dir)[1].select("lemma", "frequency", F.coalesce(F.transform("forms", lambda f: f["lemma"]), F.array().cast("array<string>")).alias("forms"), "rolled")


@query(f"WITH {_WC} SELECT form AS lemma, n AS frequency FROM counted WHERE n >= 3")
def flattened_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nesting undone."""
    return fusion.flatten_forms(_nested(spark, sf_dir)[1]).select("lemma", "frequency")


@query("WITH p AS (SELECT s_suppkey AS ord, n_name AS target, 'S' || (s_suppkey % 7) AS other, CASE WHEN s_suppkey % 2 = 0 THEN 'a' ELSE 'b' END AS type, round(s_acctbal / 10000, 4) AS conf, s_suppkey % 5 = 0 AS curated FROM supplier JOIN nation ON s_nationkey = n_nationkey), f AS (SELECT *, row_number() OVER (PARTITION BY target, other, type ORDER BY ord) AS r FROM p) SELECT n_name, list(other || ':' || type ORDER BY NOT curated, -conf, other, type) AS matches FROM nation JOIN f ON n_name = target WHERE r = 1 GROUP BY n_name")
def typed_correspondences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed pairs attached to entries, each once, curated first."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    pairs = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("ord"), F.col("n_name").alias("target"), F.concat(F.lit("S"), F.col("s_suppkey") % 7).alias("other"), F.when(F.col("s_suppkey") % 2 == 0, "a").otherwise("b").alias("type"), F.round(F.col("s_acctbal") / 10000, 4).alias("conf"), (F.col("s_suppkey") % 5 == 0).alias("curated"))
    out = fusion.correspondences(n.select("n_name"), pairs, "n_name").filter("matches is not null")
    return out.select("n_name", F.transform("matches", lambda m: F.concat_ws(":", m["lemma"], m["type"])).alias("matches"))


@query("SELECT lang, source, min(doc_id) AS doc_id FROM documents GROUP BY lang, source")
def dedup_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of each key."""
    return fusion.dedup_first(table(spark, sf_dir, "documents").select("lang", "source", "doc_id"), ["lang", "source"], "doc_id")


@query(f"WITH {_WC} SELECT form, list_sort(list(DISTINCT lemma)) AS sources FROM (SELECT form AS lemma, replace(replace(form, 'm', 'n'), 'p', 'h') AS form FROM counted WHERE n >= 2) d ANTI JOIN counted USING (form) GROUP BY form")
def derived_cognates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived forms that aren't words yet, with what they come from."""
    c = _word_counts(spark, sf_dir)
    w = c.filter("n >= 2").select(F.col("form").alias("lemma"))
    return fusion.derived_cognates(w, F.replace(F.replace("lemma", F.lit("m"), F.lit("n")), F.lit("p"), F.lit("h")), c.select(F.col("form").alias("lemma")))


@query("WITH h AS (SELECT source, lang, doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS r FROM documents WHERE contains(text, 'the')) SELECT source, lang, doc_id FROM h WHERE r = 1 ORDER BY doc_id, source, lang LIMIT 12")
def lookup_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search with each (source, name) once and a stop at 12."""
    return search.lookup(table(spark, sf_dir, "documents").select("source", "lang", "doc_id", "text"), "the", ["text"], "source", "lang", "doc_id").select("source", "lang", "doc_id")


@query("WITH v AS (SELECT DISTINCT doc_id, source, sha256(text) AS h FROM documents WHERE doc_id % 2 = 0) SELECT doc_id FROM documents d WHERE sha256(text) NOT IN (SELECT h FROM v)")
def incremental_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What isn't done yet, by a fingerprint of the inputs."""
    from lexloom.streaming.incremental import missing

    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return missing(d, d.filter("doc_id % 2 = 0"), "h").select("doc_id")


@query("SELECT c_custkey AS k, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN 0 WHEN c_custkey % 3 = 1 THEN c_custkey * 10 END, 0), c_custkey) AS v FROM customer")
def refresh_keep_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refreshed values, 0 and nothing keeping the old one."""
    from lexloom.streaming.incremental import refreshed

    c = table(spark, sf_dir, "customer")
    new = c.filter("c_custkey % 3 <> 2").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 3 == 0, 0).otherwise(F.col("c_custkey") * 10).alias("v"))
    return refreshed(c.select(F.col("c_custkey").alias("k"), F.col("c_custkey").alias("v")), new, "k", "v")


@query("SELECT x AS pattern, list_sort(y) AS words FROM (VALUES ('k{e,o}m{o,∅}', ['kemo', 'kem', 'komo', 'kom']), ('kes{pa,to}', ['kespa', 'kesto']), ('kotan', ['kotan'])) t(x, y)")
def brace_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """patterns with choices spelled out."""
    d = spark.createDataFrame([("k{e,o}m{o,∅}",), ("kes{pa,to}",), ("kotan",)], "pattern string")
    return d.select("pattern", F.array_sort(tk.expand_braces(F.col("pattern"))).alias("words"))


# --- lexicon ---

@query("WITH s AS (SELECT conv_id || '-' || turn AS sid, role, text, " + _WORDS + " AS ws FROM conversations), m AS (SELECT sid, unnest(ws) AS morpheme, role AS gloss, generate_subscripts(ws, 1) AS i FROM s), g AS (SELECT morpheme, gloss, count(*) AS n, min(sid || ':' || lpad(CAST(i AS VARCHAR), 6, '0')) AS o FROM m GROUP BY ALL), b AS (SELECT morpheme, count(*) AS occurrences, count(DISTINCT sid) AS sentences FROM m GROUP BY morpheme) SELECT b.*, (SELECT gloss FROM g WHERE g.morpheme = b.morpheme ORDER BY n DESC, o LIMIT 1) AS primary_gloss, (SELECT string_agg(gloss || ' (' || n || ')', ' || ' ORDER BY n DESC, o) FROM g WHERE g.morpheme = b.morpheme) AS glosses FROM b WHERE occurrences >= 3")
def lexicon_primary_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Morphemes with counted glosses, the primary one and the number of sentences."""
    c = table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("sid"), F.col("role").alias("gloss_en"), F.posexplode(_words()).alias("i", "morpheme"))
    c = c.withColumn("ord", F.concat_ws(":", "sid", F.lpad((F.col("i") + 1).cast("string"), 6, "0")))
    return lexicon.lexicon(c, "sid", "ord").filter("occurrences >= 3").select("morpheme", "occurrences", "sentences", "primary_gloss", "glosses")


def _tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", _words().alias("ws")).filter(F.size("ws") > 0)
    return d.select("doc_id", F.array_join(F.transform("ws", lambda w: F.concat_ws("-", w, F.length(w))), "||").alias("morpheme"), F.array_join(F.transform("ws", lambda w: F.when(F.length(w) % 3 == 0, "x").otherwise("x-y")), "||").alias("gloss_en"), F.array_join(F.transform("ws", lambda w: F.lit("j")), "||").alias("gloss_jp"))


@query(f"WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents), t AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS unit FROM w) SELECT doc_id, CAST(unit AS INTEGER) AS unit, p.part AS part, CASE WHEN p.part = 0 THEN word ELSE CAST(length(word) AS VARCHAR) END AS morpheme, CASE WHEN p.part = 0 THEN 'x' ELSE 'y' END AS gloss_en, 'j' AS gloss_jp FROM t, (VALUES (0), (1)) p(part) WHERE length(word) % 3 <> 0")
def align_units_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers of units and parts aligned, a Japanese gloss of one part going to all."""
    good, _ = lexicon.align(_tiers(spark, sf_dir), "morpheme", "gloss_en", "gloss_jp", "doc_id")
    return good.select("doc_id", "unit", "part", "morpheme", "gloss_en", "gloss_jp")


@query(f"WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents), t AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS unit FROM w) SELECT doc_id, CAST(unit AS INTEGER) AS unit, word || '-' || length(word) AS text, 'part_count_mismatch' AS reason FROM t WHERE length(word) % 3 = 0")
def align_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units that don't align, with a reason."""
    return lexicon.align(_tiers(spark, sf_dir), "morpheme", "gloss_en", "gloss_jp", "doc_id")[1]


@query("WITH g AS (SELECT p_brand, p_size, list_sort(list(DISTINCT p_type)) AS forms FROM part GROUP BY ALL) SELECT p_brand, list(p_size || ':' || array_to_string(forms, ',') ORDER BY p_size) AS glosses FROM g GROUP BY p_brand")
def grouped_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lemma -> gloss -> set of forms."""
    g = lexicon.grouped_forms(table(spark, sf_dir, "part"), "p_brand", "p_size", "p_type")
    return g.select("p_brand", F.transform("glosses", lambda x: F.concat_ws(":", x["p_size"], F.array_join(x["forms"], ","))).alias("glosses"))


# --- linkage ---

_KEYED = "q AS (SELECT s_suppkey AS id, lower(s_name) AS key FROM supplier), e AS (SELECT c_custkey AS entry, lower(replace(c_name, 'Customer', 'Supplier')) AS ekey FROM customer)"


@query("SELECT id, norm, list_contains(vs, norm) AS has FROM (VALUES (1, 'kamuy', ['kamuy', 'kamui']), (2, 'ci', ['ci', 'chi']), (3, 'iresu-kamuy', ['iresu-kamuy', 'iresukamuy', 'iresu-kamui', 'iresukamui'])) t(id, norm, vs)")
def normalize_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """modern spellings and variants of old ones."""
    d = spark.createDataFrame([(1, "kamui"), (2, "chi"), (3, "iresu-kamui")], "id int, lemma string")
    n = orthography.normalize_lemma(F.col("lemma"))
    return d.select("id", n.alias("norm"), F.array_contains(orthography.variants(F.col("lemma")), n).alias("has"))


_JAC = "len(list_intersect(list_distinct(a), list_distinct(b))) / len(list_distinct(a || b))"
_TOKS = "list_distinct(list_filter(list_transform(regexp_extract_all(%s, '[A-Za-z''\\-]{3,}'), lambda t: regexp_replace(lower(t), '^[^a-z0-9]+|[^a-z0-9]+$', '', 'g')), lambda t: t <> '' AND NOT list_contains([" + ", ".join("'" + w.replace("'", "''") + "'" for w in orthography.EN_STOP) + "], t)))"


@query(f"WITH b AS (SELECT item_id, {_TOKS % 'text'} AS a FROM benchmark), d AS (SELECT c.conv_id * 100 + c.turn AS entry, {_TOKS % 'text'} AS b FROM conversations c), p AS (SELECT item_id, entry, {_JAC} AS j FROM b, d WHERE len(list_intersect(a, b)) > 0) SELECT item_id, entry, round(j, 6) AS jaccard FROM p WHERE j >= 0.05")
def token_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-set similarity of passages through an inverted index."""
    b = table(spark, sf_dir, "benchmark").select("item_id", orthography.gloss_tokens_en(F.col("text")).alias("a"))
    d = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("entry"), orthography.gloss_tokens_en(F.col("text")).alias("b"))
    shared = b.select("item_id", F.size("a").alias("na"), F.explode("a").alias("t")).join(d.select("entry", F.size("b").alias("nb"), F.explode("b").alias("t")), "t").groupBy("item_id", "entry", "na", "nb").agg(F.count(F.lit(1)).alias("k"))
    j = F.col("k") / (F.col("na") + F.col("nb") - F.col("k"))
    return shared.filter(j >= 0.05).select("item_id", "entry", F.round(j, 6).alias("jaccard"))


@query("WITH q AS (SELECT DISTINCT p_brand || p_size AS key FROM part), e AS (SELECT DISTINCT p_brand || p_size AS ekey FROM part) SELECT key, ekey FROM q, e WHERE levenshtein(key, ekey) = 1")
def match_edit1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs within one edit, by one-deletion neighbourhoods."""
    p = table(spark, sf_dir, "part").select(F.concat("p_brand", "p_size").alias("key"))
    q = p.select("key").distinct().withColumn("near", F.explode(orthography.edit1_keys(F.col("key"))))
    e = p.select(F.col("key").alias("ekey")).distinct().withColumn("near", F.explode(orthography.edit1_keys(F.col("ekey"))))
    return q.join(e, "near").filter(F.levenshtein("key", "ekey", 1) == 1).select("key", "ekey").distinct()


@query("WITH q AS (SELECT DISTINCT p_name AS name, lower(regexp_replace(p_name, '[^A-Za-z]', '', 'g')) AS key FROM part), s AS (SELECT name, unnest(list_distinct(flatten(list_transform(range(4, 8), lambda l: list_transform(range(1, length(key) - l + 2), lambda i: substr(key, i, l)))))) AS sub FROM q WHERE length(key) >= 6), e AS (SELECT DISTINCT lower(t) AS ekey FROM (SELECT unnest(string_split(p_type, ' ')) AS t FROM part)) SELECT name, ekey FROM s JOIN e ON sub = ekey")
def match_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries whose key is a substring of a longer key."""
    p = table(spark, sf_dir, "part")
    q = p.select(F.col("p_name").alias("name"), F.lower(F.regexp_replace("p_name", "[^A-Za-z]", "")).alias("key")).distinct().filter(F.length("key") >= 6)
    s = q.select("name", F.explode(orthography.substrings(F.col("key"))).alias("sub"))
    e = p.select(F.explode(F.split("p_type", " ")).alias("t")).select(F.lower("t").alias("ekey")).distinct()
    return s.join(e, F.col("sub") == F.col("ekey")).select("name", "ekey")


# Prepared tables of the matcher's stages: lists of keys, tokens and first Japanese runs made from names and types.
_PREPARED = """q AS (SELECT p_partkey AS id, [lower(p_type), split_part(p_name, ' ', 2), split_part(p_name, ' ', 1)] AS keys, CASE WHEN p_size % 5 = 0 THEN 'ア' || p_size ELSE '' END AS kana,
 string_split(lower(p_name || ' ' || p_type || CASE WHEN p_size % 2 = 0 THEN ' 水' ELSE '' END), ' ') AS tokens, CASE p_size % 5 WHEN 0 THEN '満足スル' WHEN 1 THEN '水' WHEN 2 THEN '大きいの木' WHEN 3 THEN '' ELSE '一二三四五六七八九' END AS prim FROM part),
e AS (SELECT min(p_partkey) AS entry, CASE WHEN min(p_partkey) % 4 = 0 THEN 'asjp' ELSE 'own' END AS source, 0.80 + (min(p_partkey) % 3) / 100.0 AS base_conf, min(p_partkey) AS ord, split_part(p_name, ' ', 2) AS ekey, CASE WHEN min(p_partkey) % 2 = 0 THEN 'ア' || (min(p_partkey) % 50) ELSE '' END AS ekana,
 list_distinct(string_split(lower(p_name || ' ' || min(p_type) || ' ' || min(p_brand) || CASE WHEN min(p_partkey) % 3 = 0 THEN ' 水 満足' ELSE '' END), ' ')) AS etokens FROM part GROUP BY p_name, p_size),
jac AS (SELECT q.*, e.*, len(list_intersect(tokens, etokens)) / len(list_distinct(tokens || etokens)) AS overlap, len(list_intersect(tokens, etokens)) / len(etokens) AS recall FROM q, e)"""
_BEST = "SELECT id, entry, kind, score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, step, ord, entry) AS r FROM found) WHERE r = 1"


def _prepared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part")
    word = lambda c, i: F.lower(F.split(c, " ")[i])
    m = F.col("p_size") % 5
    q = p.select(
        F.col("p_partkey").alias("id"), F.array(F.lower("p_type"), word("p_name", 1), word("p_name", 0)).alias("keys"), F.when(m == 0, F.concat(F.lit("ア"), "p_size")).otherwise("").alias("kana"),
        F.split(F.lower(F.concat("p_name", F.lit(" "), "p_type", F.when(F.col("p_size") % 2 == 0, " 水").otherwise(""))), " ").alias("tokens"), F.when(m == 0, "満足スル").when(m == 1, "水").when(m == 2, "大きいの木").when(m == 3, "").otherwise("一二三四五六七八九").alias("primary"),
    )
    e = p.groupBy("p_name", "p_size").agg(F.min("p_partkey").alias("entry"), F.min("p_brand").alias("b"), F.min("p_type").alias("t"))
    n = F.col("entry")
    text = F.lower(F.concat("p_name", F.lit(" "), "t", F.lit(" "), "b", F.when(n % 3 == 0, " 水 満足").otherwise("")))
    e = e.select("entry", F.when(n % 4 == 0, "asjp").otherwise("own").alias("source"), (0.80 + (n % 3) / 100.0).alias("base_conf"), n.alias("ord"), word("p_name", 1).alias("ekey"), F.when(n % 2 == 0, F.concat(F.lit("ア"), n % 50)).otherwise("").alias("ekana"), F.array_distinct(F.split(text, " ")).alias("etokens"))
    return q, e.withColumn("terms", F.col("etokens")).withColumn("index", F.slice("etokens", 1, 8)).withColumn("eprimary", F.when(n % 3 == 0, "水").otherwise("")).withColumn("long", F.when(n % 2 == 0, 100).otherwise(20))


@query(f"WITH {_PREPARED}, ota AS (SELECT DISTINCT lower(p_type) AS word, p_brand AS title FROM part), found AS (SELECT DISTINCT id, CAST(entry AS VARCHAR) AS entry, ord, 0 AS step, 'latn' AS kind, round(least(1.0, base_conf + 0.10 * overlap), 6) AS score FROM jac WHERE list_contains(keys, ekey) UNION ALL SELECT id, CAST(entry AS VARCHAR), ord, 1, 'kana', round(least(1.0, base_conf - 0.05 + 0.15 * overlap), 6) FROM jac WHERE kana = ekana AND kana <> '' UNION ALL SELECT DISTINCT id, 'ota:' || title, 0, 2, 'ota_reverse', 0.65 FROM q JOIN ota ON list_contains(keys, word)) {_BEST}")
def match_exact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries under any key, the kana, or as a word inside a Japanese entry; the best of all."""
    q, e = _prepared(spark, sf_dir)
    words = linkage.ota_words(table(spark, sf_dir, "part").select(F.col("p_brand").alias("title"), F.concat(F.lit("訳 "), F.lower("p_type"), F.lit(" X。")).alias("description")))
    return linkage.exact_stage(q, e, words)


@query(f"WITH {_PREPARED}, s AS (SELECT id, entry, ord, greatest(recall, overlap) AS o, list_sum(list_transform(list_intersect(list_distinct(tokens), etokens), lambda t: CASE WHEN t IN ('水', '満足') THEN 2 ELSE 1 END)) AS w FROM jac WHERE source <> 'asjp'), found AS (SELECT id, entry, ord, 0 AS step, 'reverse_gloss' AS kind, round(least(0.78, 0.50 + 0.25 * o), 6) AS score FROM s WHERE w >= 3 AND o >= 0.18) {_BEST}")
def match_reverse_gloss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries whose definitions share enough weighted tokens with the gloss."""
    q, e = _prepared(spark, sf_dir)
    return linkage.gloss_stage(q.withColumn("tokens", F.array_distinct("tokens")), e)


@query(f"WITH {_PREPARED}, v(prim, tok, step) AS (VALUES ('満足スル', '満足スル', 0), ('満足スル', '満足', 1), ('水', '水', 0), ('大きいの木', '大きいの木', 0), ('大きいの木', '大', 1), ('大きいの木', '木', 2)), found AS (SELECT id, entry, ord, step, 'primary_ja' AS kind, round(least(0.72, base_conf - 0.20 + CASE WHEN entry % 2 = 0 THEN 0 ELSE 0.05 END + CASE WHEN v.tok = v.prim THEN 0.04 ELSE 0 END), 6) AS score FROM q JOIN v USING (prim), e WHERE source <> 'asjp' AND list_contains(etokens[1:8], v.tok)) {_BEST}")
def match_primary_gloss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries under the first Japanese run of the gloss, whole, without endings, or its kanji."""
    return linkage.primary_stage(*_prepared(spark, sf_dir))


@query("SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN 1 WHEN p_size % 3 = 1 THEN 2 WHEN p_size % 2 = 0 THEN 3 END AS entry, CASE WHEN p_size % 3 <= 1 THEN 'latn' WHEN p_size % 2 = 0 THEN 'kana' END AS kind, CASE WHEN p_size % 3 <= 1 THEN 0.85 WHEN p_size % 2 = 0 THEN 0.7 END AS score FROM part WHERE p_size % 3 <= 1 OR p_size % 2 = 0")
def match_first_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The oldest matcher: the first spelling that hits, the first source that has it, else the kana source."""
    m = F.col("p_size") % 3
    q = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.when(m == 0, "Chise").when(m == 1, "Kamui").otherwise("Zzz").alias("lemma"), F.when(F.col("p_size") % 2 == 0, "ポネ、x").otherwise("").alias("kana"), F.lit("").alias("gloss"))
    entry = "entry long, source string, base_conf double, ord long, lemma string, lemma_kana string, definition string"
    nakagawa = spark.createDataFrame([(1, "nakagawa", 0.85, 1, "cise", "", "house"), (9, "nakagawa", 0.85, 9, "chise", "", "late spelling")], entry)
    kayano = spark.createDataFrame([(8, "kayano", 0.85, 8, "cise", "", "second source"), (2, "kayano", 0.85, 2, "kamuy", "", "god")], entry)
    tamura = spark.createDataFrame([(3, "tamura", 0.85, 3, "pone", "ポネ", "bone")], entry)
    return linkage.first_variant(q, [nakagawa, kayano], tamura)


_STAGES = "CASE p_size % 7 WHEN 0 THEN 'latn' WHEN 1 THEN 'kana' WHEN 2 THEN 'fuzzy_edit1' WHEN 3 THEN 'reverse_gloss' WHEN 4 THEN 'primary_ja' WHEN 5 THEN 'substring' ELSE 'manual' END"


def _cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query a part, whose size decides which stage can find it: spelling, kana, one edit, gloss, first Japanese run,
    part of the headword, or the table of manual pairs."""
    m = F.col("p_size") % 7
    lemma = F.when(m == 0, "Chise").when(m == 1, "Qqq").when(m == 2, "kimunkamuj").when(m == 3, "Www").when(m == 4, "Xxx").when(m == 5, "retarsetabeh").otherwise("manualword ")
    gloss = F.when(m == 2, "a bear of mountains").when(m == 3, "a sacred white headed eagle").when(m == 4, "滿足スル。").when(m == 5, "white dog thing").otherwise("")
    q = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), lemma.alias("lemma"), F.when(m == 1, "ポネ").otherwise("").alias("kana"), gloss.alias("gloss"))
    rows = [
        (1, "own", 0.85, 1, "cise", "", "house"), (2, "own", 0.85, 2, "pone", "ポネ", "bone"), (3, "own", 0.85, 3, "kimunkamuy", "", "bear of mountains"), (4, "own", 0.85, 4, "kapacir", "", "sacred white eagle"),
        (5, "asjp", 0.85, 5, "asjpword", "", "sacred white headed eagle"), (6, "own", 0.85, 6, "ramu", "", "満足する。"), (7, "own", 0.85, 7, "seta", "", "dog"),
    ]
    e = spark.createDataFrame(rows, "entry long, source string, base_conf double, ord long, lemma string, lemma_kana string, definition string")
    manual = spark.createDataFrame([("manualword", 2)], "lemma string, entry long")
    return linkage.cascade(q, e, manual, old="滿", new="満")


@query(f"SELECT p_partkey AS id, CASE p_size % 7 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 6 WHEN 5 THEN 7 ELSE 2 END AS entry, {_STAGES} AS kind, CASE p_size % 7 WHEN 0 THEN 0.85 WHEN 1 THEN 0.8 WHEN 2 THEN 0.85 WHEN 3 THEN 0.75 WHEN 4 THEN 0.7 WHEN 5 THEN round(0.6 + 0.25 / 3, 6) ELSE 1.0 END AS score FROM part")
def match_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cascade of matching stages, each for what the ones before left, then manual pairs."""
    return _cascade(spark, sf_dir)


@query(f"SELECT {_STAGES} AS kind, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM part), 4) AS percent FROM part GROUP BY ALL")
def match_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many matched by which stage, in percent."""
    return linkage.match_summary(_cascade(spark, sf_dir))


@query()
def match_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of the benchmark against all documents as entries, by headword (their third word) and gloss."""
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.coalesce(F.get(_words(), F.lit(2)), F.lit("x")).alias("lemma"), F.col("text").alias("gloss"))
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("entry"), F.lit("documents").alias("source"), F.lit(0.85).alias("base_conf"), F.col("doc_id").alias("ord"), F.coalesce(F.get(_words(), F.lit(2)), F.lit("")).alias("lemma"), F.col("text").alias("definition"))
    return linkage.cascade(b, d)


@query()
def lookup_key_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """all lookup keys of frequent words."""
    c = _word_counts(spark, sf_dir).filter("n >= 5")
    return c.select("form", orthography.lookup_keys(F.col("form")).alias("keys"))
