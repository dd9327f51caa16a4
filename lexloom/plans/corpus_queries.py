"""Corpus queries on the documents and conversations tables, each with its equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.functions import tokens as tk
from lexloom.operators import counts, search
from lexloom.operators.ranking import with_totals
from lexloom.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The tokenizer in SQL: raw tokens, quotation marks at the ends, affixes.
_L = tk.LETTERS.replace("'", "''")
_S = tk.SIGNS.replace("'", "''")
_RAW = rf"\.\.\.(?:\.\.\.)?|[{_L}\[\]]+|\d+|[{_S}]|[^\s\d{_L}\[\]{_S}]+"
_P = "|".join(tk.PREFIXES)
_AFF = rf"^((?:{_P})=)?((?:{_P})=)?([a-z/\-]+)(=(?:{'|'.join(tk.SUFFIXES)}))?(.*)"
TOKENS = rf"""
raw_t AS (SELECT doc_id, lang, source, unnest(regexp_extract_all(text, '{_RAW}')) AS w FROM documents),
quoted_t AS (SELECT doc_id, lang, source, unnest(CASE WHEN length(w) >= 2 AND regexp_matches(w, '^([''’‘]?)([^''’‘]*)([''’‘]?)$')
  THEN list_filter([regexp_extract(w, '^([''’‘]?)([^''’‘]*)([''’‘]?)$', 1), regexp_extract(w, '^([''’‘]?)([^''’‘]*)([''’‘]?)$', 2), regexp_extract(w, '^([''’‘]?)([^''’‘]*)([''’‘]?)$', 3)], lambda x: x <> '') ELSE [w] END) AS w FROM raw_t),
marked_t AS (SELECT *, length(regexp_replace(w, '[^-=]', '', 'g')) AS m FROM quoted_t),
tok AS (SELECT doc_id, lang, source, unnest(list_filter(CASE
  WHEN m >= 2 AND regexp_matches(w, '{_AFF}') THEN [regexp_extract(w, '{_AFF}', 1), regexp_extract(w, '{_AFF}', 2), regexp_extract(w, '{_AFF}', 3), regexp_extract(w, '{_AFF}', 4), regexp_extract(w, '{_AFF}', 5)]
  WHEN m = 1 THEN CASE WHEN length(regexp_extract(w, '^([^-=]*)([-=])([^-=]*)$', 1)) > length(regexp_extract(w, '^([^-=]*)([-=])([^-=]*)$', 3))
    THEN [regexp_extract(w, '^([^-=]*)([-=])([^-=]*)$', 1), regexp_extract(w, '^([^-=]*)([-=])([^-=]*)$', 2) || regexp_extract(w, '^([^-=]*)([-=])([^-=]*)$', 3)]
    ELSE [regexp_extract(w, '^([^-=]*)([-=])([^-=]*)$', 1) || regexp_extract(w, '^([^-=]*)([-=])([^-=]*)$', 2), regexp_extract(w, '^([^-=]*)([-=])([^-=]*)$', 3)] END
  ELSE [w] END, lambda x: x <> '')) AS token FROM marked_t),
norm0 AS (SELECT *, regexp_replace(translate(token, '{tk._MARKED}', '{tk._PLAIN}'), '[^\x00-\x7F]', '', 'g') AS f0 FROM tok WHERE regexp_matches(token, '^[{_L}]+$')),
norm1 AS (SELECT *, regexp_replace(regexp_replace(f0, '([aiueo])''([aiueo])', '\1\2', 'g'), '([aiueo])''([aiueo])', '\1\2', 'g') AS f1 FROM norm0),
norm2 AS (SELECT *, replace(regexp_replace(f1, '^''|''$', '', 'g'), '_', '') AS f2 FROM norm1),
norm AS (SELECT doc_id, lang, source, token, replace(replace(regexp_replace(regexp_replace(f2, '^\[(.*?)\]$', '\1'), '\[.*?\]', '', 'g'), 'neampe', 'neanpe'), 'ampe', 'anpe') AS form FROM norm2),
forms AS (SELECT * FROM norm WHERE form <> '')
"""


def _counts(spark: SparkSession, sf_dir: str, *groups: str) -> DataFrame:
    return counts.form_counts(table(spark, sf_dir, "documents"), "text", *groups)


COUNTED = TOKENS + ", counted AS (SELECT form, count(*) AS n FROM forms GROUP BY form)"


@query(f"WITH {TOKENS} SELECT form, CAST(sum(n) AS BIGINT) AS frequency, string_agg(lang || ':' || n, '|' ORDER BY k) AS breakdown FROM (SELECT form, lang, count(*) AS n, list_position(['en', 'fr', 'de', 'es'], lang) AS k FROM forms GROUP BY form, lang) GROUP BY form")
def freq_token_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms with their frequency and its breakdown by language."""
    return counts.frequency_by(_counts(spark, sf_dir, "lang"), "lang", ["en", "fr", "de", "es"])


@query(f"WITH {COUNTED} SELECT form, CAST(sum(n) AS BIGINT) AS frequency FROM (SELECT regexp_replace(form, '^[-=]+|[-=]+$', '', 'g') AS form, n FROM counted) WHERE form <> '' GROUP BY form")
def freq_bare_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without affix markers, rolled up from the counts."""
    return counts.bare_rollup(_counts(spark, sf_dir).withColumnRenamed("n", "frequency"))


@query(f"WITH {TOKENS} SELECT (SELECT count(*) FROM documents) AS rows_seen, (SELECT count(*) FROM documents WHERE text <> '') AS rows_with_text, count(DISTINCT form) AS unique_tokens, count(DISTINCT nullif(regexp_replace(form, '^[-=]+|[-=]+$', '', 'g'), '')) AS unique_lemmas, (SELECT count(*) FROM documents WHERE lang = 'en') AS rows_en, (SELECT count(*) FROM documents WHERE lang = 'fr') AS rows_fr, (SELECT count(*) FROM documents WHERE lang NOT IN ('en', 'fr')) AS rows_other FROM forms")
def freq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows seen, rows with text, distinct tokens and lemmas, rows by language."""
    d = table(spark, sf_dir, "documents")
    per_row = d.agg(F.count(F.lit(1)).alias("rows_seen"), F.count_if(F.col("text") != "").alias("rows_with_text"), *[F.count_if(F.col("lang") == x).alias(f"rows_{x}") for x in ("en", "fr")], F.count_if(~F.col("lang").isin("en", "fr")).alias("rows_other"))
    types = _counts(spark, sf_dir).agg(F.count(F.lit(1)).alias("unique_tokens"), F.count_distinct(F.nullif(tk.bare(F.col("form")), F.lit(""))).alias("unique_lemmas"))
    return per_row.crossJoin(types)


@query(f"WITH {TOKENS} SELECT form, count(*) AS everything, count(*) FILTER (WHERE source NOT IN ('src1', 'src2', 'src3')) AS traditional, count(*) FILTER (WHERE source IN ('src4', 'src5')) AS archive FROM forms GROUP BY form")
def freq_by_source_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts in cohorts of sources, in one pass."""
    s = F.col("source")
    return counts.cohort_counts(_counts(spark, sf_dir, "source"), {"everything": F.lit(True), "traditional": ~s.isin("src1", "src2", "src3"), "archive": s.isin("src4", "src5")})


@query(f"WITH {COUNTED} SELECT form, n FROM counted WHERE n >= 2")
def freq_min2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms that occur twice or more."""
    return _counts(spark, sf_dir).filter("n >= 2")


@query(f"WITH {TOKENS} SELECT source, form, count(*) AS n FROM forms GROUP BY source, form HAVING count(*) >= 3")
def freq_by_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by source and form."""
    return _counts(spark, sf_dir, "source").filter("n >= 3")


@query(f"WITH {COUNTED}, clean AS (SELECT replace(form, 'mp', 'np') AS form, n FROM counted WHERE regexp_matches(form, '^[a-z]+$')) SELECT form, CAST(sum(n) AS BIGINT) AS n FROM clean GROUP BY form")
def freq_merged_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-case alphabetic forms, np for mp, counts merged."""
    return _counts(spark, sf_dir).filter(F.col("form").rlike(r"^[a-z]+\z")).select(F.replace("form", F.lit("mp"), F.lit("np")).alias("form"), "n").groupBy("form").agg(F.sum("n").alias("n"))


@query("SELECT source, list_sort(list(DISTINCT lang)) AS langs, count(*) AS docs FROM documents GROUP BY source")
def doc_language_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The set of languages of each source."""
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("langs"), F.count(F.lit(1)).alias("docs"))


@query(f"WITH {TOKENS} SELECT doc_id, count(*) AS tokens, count(*) FILTER (WHERE regexp_matches(token, '^[{_L}]+$')) AS words FROM tok GROUP BY doc_id")
def tokenize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and words of each text."""
    t = table(spark, sf_dir, "documents").select("doc_id", tk.tokenize(F.col("text")).alias("t")).filter(F.size("t") > 0)
    return t.select("doc_id", F.size("t").cast("long").alias("tokens"), F.size(F.filter("t", tk.is_word)).cast("long").alias("words"))


_WORDS = r"regexp_extract_all(lower(text), '[a-zà-ÿ]+')"


def _words(c: str = "text") -> F.Column:
    return F.regexp_extract_all(F.lower(c), F.lit("[a-zà-ÿ]+"), F.lit(0))


@query(f"WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents), hit AS (SELECT doc_id, ws, list_filter(range(0, len(ws) - 1), lambda i: ws[i + 1] = 'the' AND ws[i + 2] = 'and') AS found FROM w) SELECT doc_id, len(found) AS hits, list_transform(found, lambda i: CAST(i AS INTEGER)) AS starts FROM hit WHERE len(found) > 0")
def kwic_two_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where two keywords follow each other."""
    d = table(spark, sf_dir, "documents").select("doc_id", search.find([("the", None), ("and", None)], _words()).alias("starts"))
    return d.filter(F.size("starts") > 0).select("doc_id", F.size("starts").cast("long").alias("hits"), "starts")


@query(f"SELECT doc_id, text LIKE '%the and%' AS has_phrase, list_contains({_WORDS}, 'trash') AS has_word FROM documents WHERE text LIKE '%the and%' OR list_contains({_WORDS}, 'trash')")
def substring_and_word_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal substring and word-in-array predicates."""
    a, b = F.col("text").contains("the and"), F.array_contains(_words(), "trash")
    return table(spark, sf_dir, "documents").filter(a | b).select("doc_id", a.alias("has_phrase"), b.alias("has_word"))


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as sentences: conv_id is the book; idx numbers them 0, 1, ... in order of (conv_id, turn)."""
    c = with_totals(table(spark, sf_dir, "conversations"), [F.col("conv_id"), F.col("turn")], "at")
    return c.select(F.col("conv_id").alias("book"), (F.col("at") - 1).alias("idx"), F.col("text").alias("sentence"), _words().alias("words"))


@query(f"""WITH s AS (SELECT conv_id AS book, row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx, text AS sentence, {_WORDS} AS words FROM conversations),
n AS (SELECT max(idx) AS n FROM s),
hit AS (SELECT *, list_filter(range(0, len(words)), lambda i: words[i + 1] = 'the') AS found FROM s),
h AS (SELECT hit.*, b.words AS bw, a.words AS aw, b.sentence AS bs, a.sentence AS asn FROM hit CROSS JOIN n
  LEFT JOIN s b ON b.idx = hit.idx - 1 AND b.book = hit.book AND hit.idx >= 1 LEFT JOIN s a ON a.idx = hit.idx + 1 AND a.book = hit.book AND hit.idx + 1 <= n.n WHERE len(found) > 0)
SELECT book, idx, len(coalesce(bw, [])) + len(words) + len(coalesce(aw, [])) AS n_words, list_transform(found, lambda f: CAST(f + len(coalesce(bw, [])) AS BIGINT)) AS starts, md5(coalesce(bs, '') || ' ' || sentence || ' ' || coalesce(asn, '')) AS sentence_md5 FROM h""")
def concordance_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits with the sentences around them."""
    c = search.concordance(_sentences(spark, sf_dir), [("the", None)], k=1)
    return c.select("book", "idx", F.size("words").cast("long").alias("n_words"), F.transform("intervals", lambda i: i["start"].cast("long")).alias("starts"), F.md5("sentence").alias("sentence_md5"))


@query(f"WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents) SELECT doc_id, array_to_string(list_transform(ws, lambda x: CASE WHEN x = 'the' THEN '**' || x || '**' ELSE x END), ' ') AS shown FROM w WHERE list_contains(ws, 'the')")
def highlighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits marked in the running text."""
    d = table(spark, sf_dir, "documents").select("doc_id", _words().alias("ws"))
    d = d.withColumn("f", search.find([("the", None)], F.col("ws"))).filter(F.size("f") > 0)
    return d.select("doc_id", F.array_join(search.highlight(F.col("ws"), search.intervals(F.col("f"), 1)), " ").alias("shown"))


_PATTERNS = ["the", "of", "and", "in"]
_COLL = f"""WITH t AS (SELECT doc_id, unnest({_WORDS}) AS w, generate_subscripts({_WORDS}, 1) AS i FROM documents),
n AS (SELECT w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM t), c AS (SELECT p AS verb, w, count(*) AS k FROM n WHERE w IN ('the', 'of', 'and', 'in') AND p IS NOT NULL GROUP BY ALL),
wide AS (SELECT verb, coalesce(sum(k) FILTER (WHERE w = 'the'), 0)::BIGINT AS the, coalesce(sum(k) FILTER (WHERE w = 'of'), 0)::BIGINT AS of, coalesce(sum(k) FILTER (WHERE w = 'and'), 0)::BIGINT AS "and", coalesce(sum(k) FILTER (WHERE w = 'in'), 0)::BIGINT AS "in" FROM c GROUP BY verb HAVING sum(k) >= 3)"""


def _collocates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(_words().alias("ws"))
    ws2 = F.col("ws")
    pairs = F.filter(F.zip_with(F.slice(ws2, 1, F.size(ws2) - 1), F.slice(ws2, 2, F.size(ws2)), lambda p, w: F.struct(p.alias("verb"), w.alias("w"))), lambda x: x["w"].isin(_PATTERNS))
    long = rows.filter(F.size("ws") > 1).select(F.explode(pairs).alias("p")).select("p.*").groupBy("verb", "w").agg(F.count(F.lit(1)).alias("n"))
    return counts.wide_counts(long, "verb", "w", _PATTERNS, "n", least_total=3)


@query(_COLL + " SELECT * FROM wide")
def collocates_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words before four function words, one column each, with a least total."""
    return _collocates(spark, sf_dir)


@query(_COLL + """, d AS (SELECT sqrt(sum((the - of) ** 2)) AS d1, sqrt(sum((the - "and") ** 2)) AS d2, sqrt(sum((the - "in") ** 2)) AS d3, sqrt(sum((of - "and") ** 2)) AS d4, sqrt(sum((of - "in") ** 2)) AS d5, sqrt(sum(("and" - "in") ** 2)) AS d6 FROM wide)
SELECT a, b, round(d, 6) AS distance FROM (SELECT 'the' AS a, 'of' AS b, d1 AS d FROM d UNION ALL SELECT 'the', 'and', d2 FROM d UNION ALL SELECT 'the', 'in', d3 FROM d UNION ALL SELECT 'of', 'and', d4 FROM d UNION ALL SELECT 'of', 'in', d5 FROM d UNION ALL SELECT 'and', 'in', d6 FROM d)""")
def pairwise_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the four collocation vectors."""
    from lexloom.operators.analytics import column_distances

    return column_distances(_collocates(spark, sf_dir), _PATTERNS)


@query()
def kmeans_collocates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the collocates (their numbers are arbitrary)."""
    from lexloom.operators.analytics import clusters

    return clusters(_collocates(spark, sf_dir), _PATTERNS)


@query()
def pca_collocates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two components of the centred collocation counts."""
    from lexloom.operators.analytics import projected

    return projected(_collocates(spark, sf_dir), _PATTERNS)


@query()
def mds_collocates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four vectors in the plane."""
    from lexloom.operators.analytics import classical_scaling, column_distances

    at = classical_scaling(column_distances(_collocates(spark, sf_dir), _PATTERNS))
    return spark.createDataFrame([(k, *v) for k, v in at.items()], "word string, x double, y double")


@query()
def clustermap_collocates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merges of the four vectors after scaling each to 0 .. 1."""
    from lexloom.operators.analytics import average_linkage, column_distances, scaled_columns

    merges = average_linkage(column_distances(scaled_columns(_collocates(spark, sf_dir), _PATTERNS), _PATTERNS))
    return spark.createDataFrame(merges, "a string, b string, distance double")


def _gram_sql(n: int) -> str:
    return f"WITH w AS (SELECT {_WORDS} AS ws FROM documents), g AS (SELECT array_to_string(ws[i:i + {n - 1}], ' ') AS gram FROM (SELECT ws, unnest(range(1, len(ws) - {n - 2})) AS i FROM w)) SELECT gram, count(*) AS n FROM g GROUP BY gram HAVING count(*) >= 5"


@query(_gram_sql(2))
def bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of neighbouring words that occur five times or more."""
    return counts.ngrams(table(spark, sf_dir, "documents"), _words(), 2).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n >= 5")


@query(_gram_sql(5))
def fivegrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of five."""
    return counts.ngrams(table(spark, sf_dir, "documents"), _words(), 5).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n >= 5")


@query(f"WITH t AS (SELECT unnest({_WORDS}) AS w, conv_id, turn, generate_subscripts({_WORDS}, 1) AS i FROM conversations), g AS (SELECT w || ' ' || lead(w) OVER (ORDER BY conv_id, turn, i) AS gram FROM t) SELECT gram, count(*) AS n FROM g WHERE gram IS NOT NULL GROUP BY gram HAVING count(*) >= 2")
def bigrams_across(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs over the borders of turns too, as of one stream."""
    c = table(spark, sf_dir, "conversations")
    return counts.ngrams_across(c, ["conv_id", "turn"], _words(), 2).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")


@query(_gram_sql(2).replace(" HAVING count(*) >= 5", " ORDER BY count(*) DESC, gram LIMIT 20"))
def bigram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 most frequent pairs."""
    return sinks.most_common(counts.ngrams(table(spark, sf_dir, "documents"), _words(), 2).groupBy("gram").agg(F.count(F.lit(1)).alias("n")), limit=20)


@query(_gram_sql(2).replace("SELECT gram, count(*) AS n FROM g GROUP BY gram HAVING count(*) >= 5", "SELECT a.w AS first_word, b.w AS second_word, (SELECT count(*) FROM g WHERE gram = a.w || ' ' || b.w) AS n FROM (VALUES ('the'), ('of'), ('and'), ('in'), ('to')) a(w), (VALUES ('the'), ('of'), ('and'), ('in'), ('to')) b(w)"))
def bigram_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of pairs among given words, as a full matrix in long form."""
    names = ["the", "of", "and", "in", "to"]
    grams = counts.ngrams(table(spark, sf_dir, "documents"), _words(), 2)
    part = grams.select(F.substring_index("gram", " ", 1).alias("first_word"), F.substring_index("gram", " ", -1).alias("second_word")).filter(F.col("first_word").isin(names) & F.col("second_word").isin(names))
    n = part.groupBy("first_word", "second_word").agg(F.count(F.lit(1)).alias("n"))
    cells = spark.createDataFrame([(a, b) for a in names for b in names], "first_word string, second_word string")
    return cells.join(n, ["first_word", "second_word"], "left").na.fill(0, ["n"])


_WC = f"counted AS (SELECT w AS form, count(*) AS n FROM (SELECT unnest({_WORDS}) AS w FROM documents) GROUP BY w)"
_BW = f"bw AS (SELECT DISTINCT unnest({_WORDS}) AS w FROM benchmark)"


def _word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.explode(_words()).alias("form")).groupBy("form").agg(F.count(F.lit(1)).alias("n"))


def _covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "benchmark").select(F.explode(_words()).alias("w")).distinct()
    return _word_counts(spark, sf_dir).join(known, F.col("form") == F.col("w"), "left").withColumn("covered", F.col("w").isNotNull()).drop("w")


@query(f"WITH {_WC}, {_BW} SELECT count(*) AS types, CAST(sum(n) AS BIGINT) AS tokens, count(*) FILTER (WHERE w IS NOT NULL) AS covered_types, CAST(coalesce(sum(n) FILTER (WHERE w IS NOT NULL), 0) AS BIGINT) AS covered_tokens, round(100.0 * count(*) FILTER (WHERE w IS NOT NULL) / count(*), 6) AS type_percent, round(100.0 * coalesce(sum(n) FILTER (WHERE w IS NOT NULL), 0) / sum(n), 6) AS token_percent FROM counted LEFT JOIN bw ON form = w")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of the vocabulary and the text the benchmark's words cover."""
    c = counts.coverage(_covered(spark, sf_dir), F.col("covered"))
    return c.withColumn("type_percent", F.round("type_percent", 6)).withColumn("token_percent", F.round("token_percent", 6))


@query(f"WITH {_WC}, {_BW}, c AS (SELECT n, w FROM counted LEFT JOIN bw ON form = w) SELECT CAST(t AS INTEGER) AS threshold, count(*) AS types, CAST(sum(n) AS BIGINT) AS tokens, round(100.0 * count(w) / count(*), 6) AS type_percent, round(100.0 * coalesce(sum(n) FILTER (WHERE w IS NOT NULL), 0) / sum(n), 6) AS token_percent FROM c JOIN range(1, 21) r(t) ON n >= t GROUP BY t")
def coverage_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for types of at least 1 .. 20 occurrences."""
    c = counts.coverage_by_threshold(_covered(spark, sf_dir), F.col("covered"))
    return c.select("threshold", "types", "tokens", F.round("type_percent", 6).alias("type_percent"), F.round("token_percent", 6).alias("token_percent"))


@query(f"WITH {_WC}, {_BW} SELECT form, n FROM counted ANTI JOIN bw ON form = w ORDER BY n DESC, form LIMIT 20")
def uncovered_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent words that aren't covered."""
    return sinks.most_common(_covered(spark, sf_dir).filter("not covered").select("form", "n"), first="form", limit=20)


@query(f"WITH {_WC} SELECT form, n, CAST(sum(n) OVER (ORDER BY n DESC, form ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative, round(sum(n) OVER (ORDER BY n DESC, form ROWS UNBOUNDED PRECEDING) / sum(n) OVER (), 6) AS share FROM counted WHERE n >= 3")
def cumulative_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative counts by rank."""
    r = counts.ranked(_word_counts(spark, sf_dir).filter("n >= 3"), "n", "form")
    return r.select("form", "n", "cumulative", F.round("share", 6).alias("share"))


@query(f"WITH {_WC}, r AS (SELECT form, n, CAST(row_number() OVER (ORDER BY n DESC, form) AS INTEGER) AS rank FROM counted WHERE n >= 3) SELECT form, n, rank, (SELECT max(n) FROM r) / rank AS expected, round(log10(n + 1), 6) AS log_n FROM r")
def zipf_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks beside what Zipf's law expects."""
    r = counts.ranked(_word_counts(spark, sf_dir).filter("n >= 3"), "n", "form")
    return r.select("form", "n", "rank", "expected", F.round(F.log10(F.col("n") + 1), 6).alias("log_n"))


@query(f"WITH {_WC} SELECT length(form) AS letters, count(*) AS types FROM counted WHERE NOT regexp_matches(form, '[bdgzj]') GROUP BY ALL")
def word_length_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word lengths over types without certain letters."""
    return _word_counts(spark, sf_dir).filter(~F.col("form").rlike("[bdgzj]")).groupBy(F.length("form").cast("long").alias("letters")).agg(F.count(F.lit(1)).alias("types"))


@query(f"WITH {_WC}, l AS (SELECT unnest(['a', 'e', 'i', 'o', 'u', 'k', 's', 't', 'n', 'h', 'm', 'y', 'r', 'w', 'p', 'c']) AS letter) SELECT letter, CAST(sum(n) AS BIGINT) AS total FROM counted JOIN l ON contains(form, letter) GROUP BY letter")
def letter_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the words that hold a letter."""
    return counts.letter_presence(_word_counts(spark, sf_dir), "aeioukstnhmyrwpc")


@query(f"WITH {_WC} SELECT len(regexp_extract_all(form, '[aeiou]+')) AS groups, CAST(sum(n) AS BIGINT) AS tokens, count(*) AS types FROM counted GROUP BY ALL")
def vowel_group_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words by their number of vowel groups."""
    return _word_counts(spark, sf_dir).groupBy(F.size(F.regexp_extract_all("form", F.lit("[aeiou]+"), F.lit(0))).cast("long").alias("groups")).agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("types"))


_SYL = f"WITH {_WC}, s AS (SELECT n, unnest(regexp_extract_all(form, '[^aeiou]?[aeiou]')) AS syl FROM counted WHERE regexp_matches(form, '^[a-z]+$'))"


@query(_SYL + " SELECT syl, CAST(sum(n) AS BIGINT) AS tokens, count(*) AS types FROM s GROUP BY syl")
def open_syllable_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: open syllables by tokens and types."""
    s = _word_counts(spark, sf_dir).filter(F.col("form").rlike(r"^[a-z]+\z")).select("n", F.explode(F.regexp_extract_all("form", F.lit("[^aeiou]?[aeiou]"), F.lit(0))).alias("syl"))
    return s.groupBy("syl").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("types"))


@query(_SYL + ", c AS (SELECT CASE WHEN length(syl) = 2 THEN left(syl, 1) ELSE '' END AS onset, right(syl, 1) AS v, n FROM s) SELECT onset, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (WHERE v = '{v}'), 0) AS BIGINT) AS {v}" for v in "aeiou") + " FROM c GROUP BY onset")
def cv_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Onsets by vowels."""
    s = _word_counts(spark, sf_dir).filter(F.col("form").rlike(r"^[a-z]+\z")).select("n", F.explode(F.regexp_extract_all("form", F.lit("[^aeiou]?[aeiou]"), F.lit(0))).alias("syl"))
    s = s.select(F.when(F.length("syl") == 2, F.left("syl", F.lit(1))).otherwise("").alias("onset"), F.right("syl", F.lit(1)).alias("v"), "n")
    return counts.wide_counts(s, "onset", "v", list("aeiou"))


@query()
def syllable_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """words with their syllables, accent and southern form."""
    c = _counts(spark, sf_dir).filter(F.col("form").rlike(r"^[a-z]+\z"))
    return c.select("form", "n", tk.syllables(F.col("form")).alias("syllables"), tk.accent(F.col("form")).alias("accent"), tk.to_sakhalin(F.col("form")).alias("southern"))


@query(f"""WITH RECURSIVE {_WC}, {_BW}, m AS (SELECT w FROM bw WHERE length(w) > 1), reach AS (SELECT form, 0 AS place FROM counted UNION SELECT r.form, r.place + length(m.w) AS place FROM reach r JOIN m ON substr(r.form, r.place + 1, length(m.w)) = m.w)
SELECT form, n, form IN (SELECT form FROM reach WHERE place = length(form)) AS breaks FROM counted""")
def wordbreak_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words are sequences of known morphemes (here the benchmark's words of two letters or more)."""
    known = table(spark, sf_dir, "benchmark").select(F.explode(_words()).alias("m")).filter(F.length("m") > 1)
    return search.segmented(_word_counts(spark, sf_dir), "form", known, "m").select("form", "n", "breaks")


@query(f"WITH {_WC}, t AS (SELECT form, n FROM counted ORDER BY n DESC, form LIMIT 50) SELECT form, n, length(form) AS letters FROM t ORDER BY length(form) DESC, form LIMIT 10")
def longest_of_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest of the most frequent words."""
    top = _word_counts(spark, sf_dir).orderBy(F.desc("n"), "form").limit(50)
    return top.select("form", "n", F.length("form").cast("long").alias("letters")).orderBy(F.desc("letters"), "form").limit(10)


@query(f"WITH {_WC}, {_BW} SELECT coalesce(form, w) AS form, CASE WHEN w IS NULL THEN 'only_a' WHEN form IS NULL THEN 'only_b' ELSE 'both' END AS side FROM counted FULL JOIN bw ON form = w")
def set_compare_only_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents only, of the benchmark only, of both."""
    from lexloom.operators.fusion import compare_sets

    b = table(spark, sf_dir, "benchmark").select(F.explode(_words()).alias("form"))
    return compare_sets(_word_counts(spark, sf_dir), b, "form")


@query(f"WITH {_WC} SELECT '* {{{{l|ain|' || form || '}}}} (' || n || ')' AS line FROM counted WHERE n >= 3")
def wiki_frequency_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frequency list in wikitext."""
    return _word_counts(spark, sf_dir).filter("n >= 3").select(sinks.wiki_list(F.col("form"), F.col("n")).alias("line"))


@query("SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 250) AS BIGINT) AS chunk FROM documents")
def chunk_250(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 250 records."""
    return sinks.chunked(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"]).select("doc_id", F.col("chunk").cast("long").alias("chunk"))


@query("SELECT doc_id, CASE WHEN length(text) > 80 THEN left(text, 77) || '...' ELSE text END AS brief FROM documents")
def brief_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First letters with dots."""
    from lexloom.functions.orthography import shorten

    return table(spark, sf_dir, "documents").select("doc_id", shorten(F.col("text")).alias("brief"))


@query("SELECT source, doc_id, CAST(r AS INTEGER) AS place FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r BETWEEN 2 AND 4")
def slices_by_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slice of each source's rows."""
    w = Window.partitionBy("source").orderBy("doc_id")
    return table(spark, sf_dir, "documents").select("source", "doc_id", F.row_number().over(w).alias("place")).filter(F.col("place").between(2, 4))


@query("SELECT doc_id, lang, n_chars FROM documents ORDER BY md5('12:' || doc_id) LIMIT 10")
def random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of ten, by a hash under a seed."""
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").orderBy(F.md5(F.concat(F.lit("12:"), F.col("doc_id").cast("string")))).limit(10)


@query(f"""WITH w AS (SELECT conv_id AS book, conv_id || '-' || turn AS sent_id, replace(text, chr(10), ' ') AS text, {_WORDS} AS ws FROM conversations),
t AS (SELECT book, sent_id, text, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w), x AS (SELECT *, CASE w WHEN 'the' THEN 'adn' WHEN 'and' THEN 'cconj' WHEN 'of' THEN 'postp' WHEN 'in' THEN 'postp' WHEN 'is' THEN 'cop' WHEN 'that' THEN 'adn' WHEN 'this' THEN 'adn' ELSE 'n' END AS xpos FROM t),
l AS (SELECT book, sent_id, string_agg(array_to_string([CAST(i AS VARCHAR), w, replace(replace(regexp_replace(strip_accents(w), '[^\\x00-\\x7F]', '', 'g'), 'neampe', 'neanpe'), 'ampe', 'anpe'), CASE xpos WHEN 'adn' THEN 'DET' WHEN 'cconj' THEN 'SCONJ' WHEN 'postp' THEN 'ADP' WHEN 'cop' THEN 'AUX' ELSE 'NOUN' END, xpos, '_', '_', '_', '_', '_'], chr(9)), chr(10) ORDER BY i) AS ls FROM x GROUP BY book, sent_id)
SELECT book, sent_id, '# sent_id = ' || sent_id || chr(10) || '# text = ' || text || chr(10) || coalesce(ls || chr(10), '') AS line FROM w LEFT JOIN l USING (book, sent_id)""")
def conllu_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences as CoNLL-U blocks."""
    from lexloom.functions.morphology import literal_map, upos

    pos = literal_map({"the": "adn", "and": "cconj", "of": "postp", "in": "postp", "is": "cop", "that": "adn", "this": "adn"})
    t = F.transform(_words(), lambda w: F.struct(w.alias("form"), tk.normalize(w).alias("lemma"), upos(F.coalesce(F.element_at(pos, w), F.lit("n"))).alias("upos"), F.coalesce(F.element_at(pos, w), F.lit("n")).alias("xpos"), F.lit("_").alias("feats")))
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("book"), F.concat_ws("-", "conv_id", "turn").alias("sent_id"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"), t.alias("tokens"))
    return sinks.conllu_lines(c)


@query(f"WITH t AS (SELECT doc_id, unnest({_WORDS}) AS w, generate_subscripts({_WORDS}, 1) AS i FROM documents), n AS (SELECT w, lead(w) OVER (PARTITION BY doc_id ORDER BY i) AS nx, lead(w, 2) OVER (PARTITION BY doc_id ORDER BY i) AS ax FROM t) SELECT nx AS next_word, count(*) AS n, count(DISTINCT ax) AS after_types FROM n WHERE w = 'the' AND nx IS NOT NULL GROUP BY nx")
def next_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What follows a word, and how varied what follows that is."""
    n = search.neighbours(table(spark, sf_dir, "documents"), _words()).filter("token = 'the' and next is not null")
    return n.groupBy(F.col("next").alias("next_word")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("after_next").alias("after_types"))
