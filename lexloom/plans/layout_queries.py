"""Layout, wikitext, decision and incremental queries, each with its equivalent SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import orthography, textclean, textdiff
from lexloom.operators import decisions, fusion, layout
from lexloom.plans.corpus_queries import Query, table
from lexloom.sources import readers, sinks
from lexloom.streaming import incremental

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_CLEAN = "trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(%s, '(?is)<script\\b.*?</script>', ' ', 'g'), '(?is)<style\\b.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', '', 'g'), '&copy;', '©'), '&middot;', '·'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g'))"


@query("WITH x AS (SELECT page_id, regexp_extract_all(html, '(?is)<li\\b[^>]*>(.*?)</li>', 1) AS l FROM pages), y AS (SELECT page_id, unnest(l) AS raw, generate_subscripts(l, 1) - 1 AS pos FROM x) SELECT page_id, CAST(pos AS INTEGER) AS pos, " + _CLEAN % "raw" + " AS item FROM y")
def html_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List items of pages, cleaned."""
    return readers.html_items(table(spark, sf_dir, "pages"), "page_id", "html", "li")


@query("SELECT page_id, " + _CLEAN % "html" + " AS text FROM pages")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages without scripts, tags and entities."""
    return table(spark, sf_dir, "pages").select("page_id", textclean.strip_html(F.col("html")).alias("text"))


@query("WITH x AS (SELECT page_id, regexp_extract_all(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1) AS t, regexp_extract_all(html, '(?is)<p\\b[^>]*>(.*?)</p>', 1) AS d FROM pages), y AS (SELECT page_id, unnest(range(0, greatest(len(t), len(d)))) AS i, t, d FROM x) SELECT page_id, CAST(i AS INTEGER) AS pos, coalesce(" + _CLEAN % "t[i + 1]" + ", '') AS term, coalesce(" + _CLEAN % "d[i + 1]" + ", '') AS definition FROM y")
def html_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two kinds of elements in pairs (headings and paragraphs)."""
    p = table(spark, sf_dir, "pages")
    renamed = p.select("page_id", F.regexp_replace(F.regexp_replace("html", r"(?i)(</?)h1\b", "$1dt"), r"(?i)(</?)p\b", "$1dd").alias("html"))
    return readers.html_definitions(renamed, "page_id", "html").na.fill("", ["term", "definition"])


@query("SELECT p_partkey AS k, 0 AS \"row\", p_name AS c1, p_brand AS c2 FROM part")
def html_table_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of tables with two cells."""
    html = F.format_string("<table><TR><TH>only one</TH></TR></table><TABLE><tr class='x'><td>%s</td><td align=left> <b>%s</b></td></tr></TABLE>", "p_name", "p_brand")
    t = readers.html_tables(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), html.alias("html")), "k", "html")
    return t.select("k", (F.col("row") - 1).alias("row"), "c1", "c2")


@query("WITH x AS (SELECT page_id, regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1) AS h, regexp_extract_all(split_part(html, '<h1', 2), '(?is)<p\\b[^>]*>(.*?)</p>', 1) AS ps FROM pages) SELECT page_id, " + _CLEAN % "h" + " AS section, CAST(len(ps) AS BIGINT) AS items FROM x WHERE len(ps) > 0 AND h <> ''")
def html_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements with the last heading before them, counted by section."""
    e = readers.html_events(table(spark, sf_dir, "pages"), "page_id", "html", "h[1-6]", "p")
    return e.filter("section <> ''").groupBy("page_id", "section").agg(F.count(F.lit(1)).alias("items"))


@query("WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents), g AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^[A-D]') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS entry FROM l), h AS (SELECT *, row_number() OVER (PARTITION BY doc_id, entry ORDER BY n) AS k FROM g WHERE entry > 0) SELECT doc_id, CAST(entry AS BIGINT) AS entry, max(line) FILTER (WHERE k = 1) AS head, coalesce(string_agg(line, ' ' ORDER BY n) FILTER (WHERE k > 1), '') AS body FROM h GROUP BY doc_id, entry")
def islands_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries from head lines and what follows them."""
    lines = layout.lines_of(table(spark, sf_dir, "documents"), "doc_id", "text")
    return layout.islands(lines, "doc_id", "n", F.col("line").rlike("^[A-D]"))


@query("WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents), s AS (SELECT *, CASE WHEN regexp_matches(line, '^[A-D]') THEN left(line, 1) END AS h FROM l) SELECT doc_id, CAST(n AS INTEGER) AS n, coalesce(last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING), '') AS section FROM s")
def fill_down_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A section letter carried down to the lines below it."""
    lines = layout.lines_of(table(spark, sf_dir, "documents"), "doc_id", "text")
    out = layout.fill_down(lines, "doc_id", "n", F.when(F.col("line").rlike("^[A-D]"), F.left("line", F.lit(1))), "section")
    return out.select("doc_id", "n", F.coalesce("section", F.lit("")).alias("section"))


@query("WITH x AS (SELECT page_id, regexp_extract_all(html, '<p>|</p>') AS m, string_split_regex(html, '<p>|</p>') AS s FROM pages), y AS (SELECT page_id, unnest(range(0, len(m))) AS i, m, s FROM x) SELECT page_id, CAST(i AS INTEGER) AS nth, m[i + 1] AS match, length(s[i + 2]) AS letters FROM y")
def span_between_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies between one match and the next."""
    return layout.spans(table(spark, sf_dir, "pages"), "page_id", "html", "<p>|</p>").select("page_id", "nth", "match", F.length("span").cast("long").alias("letters"))


@query("SELECT e.event_id, coalesce(p.event_id, -1) AS before FROM (SELECT * FROM events WHERE event_type = 'purchase' OR event_type = 'error') e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') p ON e.user_id = p.user_id AND e.ts >= p.ts")
def asof_offset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row of another table at or before a place."""
    e = table(spark, sf_dir, "events")
    left = e.filter("event_type in ('purchase', 'error')").select("event_id", "user_id", "ts")
    right = e.filter("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("before"))
    return layout.as_of(left, right, "user_id", "ts", "ts", "before").select("event_id", F.coalesce("before", F.lit(-1)).alias("before"))


@query("WITH l AS (SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'), r AS (SELECT event_id AS h, user_id, value FROM events WHERE event_type = 'view'), d AS (SELECT l.event_id, h, abs(l.value - r.value) AS distance, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(l.value - r.value), h) AS k FROM l JOIN r USING (user_id)) SELECT event_id, h, round(distance, 6) AS distance FROM d WHERE k = 1")
def nearest_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest row of the same page."""
    e = table(spark, sf_dir, "events")
    left = e.filter("event_type = 'purchase'").select("event_id", "user_id", F.col("value").alias("y"))
    right = e.filter("event_type = 'view'").select("user_id", F.col("value").alias("y"), F.col("event_id").alias("h"))
    return layout.nearest(left, right, "user_id", "event_id", "y", "y", "h").select("event_id", "h", F.round("distance", 6).alias("distance"))


@query("SELECT p_partkey, CAST(CASE WHEN p_retailprice >= 900.5 THEN 1 ELSE 0 END + CASE WHEN p_retailprice >= 950 THEN 1 ELSE 0 END + CASE WHEN p_retailprice >= 1000 THEN 1 ELSE 0 END AS INTEGER) AS col, CASE WHEN p_size BETWEEN 1 AND 10 THEN 'corpus' WHEN p_size BETWEEN 11 AND 30 THEN 'dictionary' ELSE 'none' END AS kind FROM part")
def column_and_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns by borders, kinds by ranges."""
    p = layout.range_lookup(table(spark, sf_dir, "part"), "p_size", [(1, 10, "corpus"), (11, 30, "dictionary")], "kind")
    return p.select("p_partkey", layout.column_of(F.col("p_retailprice"), [900.5, 950.0, 1000.0]).cast("int").alias("col"), F.coalesce("kind", F.lit("none")).alias("kind"))


@query("SELECT c_nationkey AS volume, c_custkey AS page, coalesce(lead(c_custkey) OVER (PARTITION BY c_nationkey ORDER BY c_custkey), 999999) AS \"end\" FROM customer")
def page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries end where the next one begins."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("volume"), F.col("c_custkey").alias("page"), F.lit(999999).cast("long").alias("last"))
    return layout.page_ranges(c, "volume", "page", "page", "last").select("volume", "page", "end")


@query("""WITH RECURSIVE w AS (SELECT l_orderkey % 50 AS page, l_quantity * 10 AS y, l_extendedprice AS x, l_returnflag AS t FROM lineitem), d AS (SELECT DISTINCT page, y FROM w),
nx AS (SELECT a.page, a.y, min(b.y) AS ny FROM d a JOIN d b ON a.page = b.page AND b.y > a.y + 15 GROUP BY a.page, a.y), an AS (SELECT page, min(y) AS y FROM d GROUP BY page UNION ALL SELECT an.page, nx.ny AS y FROM an JOIN nx ON an.page = nx.page AND an.y = nx.y),
l AS (SELECT w.page, an.y, w.x, w.t FROM w ASOF JOIN an ON w.page = an.page AND w.y >= an.y) SELECT page, CAST(dense_rank() OVER (PARTITION BY page ORDER BY y) - 1 AS INTEGER) AS line, y, string_agg(t, ' ' ORDER BY x, t) AS text FROM l GROUP BY page, y""")
def clustered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of a page gathered into lines by their height."""
    w = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 50).alias("page"), (F.col("l_quantity") * 10).alias("y"), F.col("l_extendedprice").alias("x"), F.col("l_returnflag").alias("t"))
    return layout.cluster_lines(w, ["page"], "y", "x", "t", 15.0)


@query("""WITH r AS (SELECT p_brand AS k, p_partkey AS n, p_size % 3 AS m, p_name, p_type, sum(CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS block FROM part),
s AS (SELECT *, m = 0 OR (m = 1 AND block > 0) AS start FROM r), e AS (SELECT *, sum(CASE WHEN start THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY n) AS entry, sum(CASE WHEN start AND m = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY k, block ORDER BY n) AS sub,
CASE m WHEN 1 THEN '— ' || p_name ELSE p_type END AS body, last_value(CASE WHEN m = 0 THEN p_name END IGNORE NULLS) OVER (PARTITION BY k ORDER BY n) AS lemma FROM s)
SELECT k, CAST(entry AS BIGINT) AS entry, max(CASE WHEN start THEN CASE WHEN m = 0 THEN CAST(n + 1 AS VARCHAR) ELSE '' END END) AS id, max(lemma) AS lemma, CAST(max(CASE WHEN start THEN sub END) AS BIGINT) AS sub_index, string_agg(body, ' ' ORDER BY n) AS body FROM e WHERE entry > 0 GROUP BY k, entry""")
def inherited_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-entries that take their lemma from the entry above."""
    lines = table(spark, sf_dir, "part").select(F.col("p_brand").alias("k"), F.col("p_partkey").alias("n"), F.when(F.col("p_size") % 3 == 0, F.concat_ws("", F.col("p_partkey") + 1, F.lit(". "), "p_name", F.lit(". "), "p_type")).when(F.col("p_size") % 3 == 1, F.concat(F.lit("— "), "p_name")).otherwise(F.col("p_type")).alias("line"))
    return layout.inherited_entries(lines, "k", "n")


@query("""WITH r AS (SELECT p_brand AS k, p_partkey AS n, p_name || CASE WHEN p_size % 2 = 0 THEN ' 出所【X】' ELSE '' END AS t, coalesce(sum(CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS entry FROM part)
SELECT k, CAST(entry AS INTEGER) AS entry, string_agg(t, chr(10) ORDER BY n) AS text FROM r GROUP BY k, entry""")
def merged_continuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs merged until a closing mark."""
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("k"), F.col("p_partkey").alias("n"), F.concat("p_name", F.when(F.col("p_size") % 2 == 0, " 出所【X】").otherwise("")).alias("t"))
    return layout.merge_until(p, "k", "n", "t", F.col("t").rlike("^[a-z]+"), "出所【[^】]+】")


@query("WITH r AS (SELECT p_brand AS k, p_partkey AS n, p_size, p_type, lag(p_name) OVER w AS name, lag(p_size) OVER w AS before FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey)) SELECT k, n, name AS first, p_type AS second FROM r WHERE p_size % 2 = 0 AND before % 2 = 1")
def pending_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line and the translation that closes it."""
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("k"), F.col("p_partkey").alias("n"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("《"), "p_type", F.lit("》"))).otherwise(F.col("p_name")).alias("line"))
    return layout.pending_pairs(p, "k", "n", "line", r"《(.*?)》\s*$")


# --- cleaning, on literal samples ---


@query("SELECT * FROM (VALUES (1, ['to sit', 'a house; x(formal) home']), (2, ['water'])) t(id, glosses)")
def wiki_glosses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions of wikitext sections, cleaned."""
    rows = [(1, "===Verb===\n# to [[sit]]\n#* example\n# a [[house|house]]; {{lb|ain|x}}({{gloss|formal}}) home<ref>x</ref>\n# to [[sit]]"), (2, "# {{l|ain|wakka|water}}\n#: {{ux|ain|no}}")]
    return spark.createDataFrame(rows, "id int, text string").select("id", textclean.wiki_glosses_en(F.col("text")).alias("glosses"))


@query("SELECT * FROM (VALUES (1, ['山', '座る']), (2, ['水'])) t(id, glosses)")
def wiki_glosses_japanese(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Japanese definitions, templates resolved."""
    rows = [(1, "# [[すわる|座る]]（文語）、{{ふりがな|山|やま}}。\n#* 例"), (2, "# 水→[[x]]\n# {{quote|ain|x}}")]
    d = spark.createDataFrame(rows, "id int, text string")
    return d.select("id", textclean.markup_free(textclean.wiki_glosses_ja(F.col("text"))).alias("glosses"))


@query("SELECT * FROM (VALUES ('-pa', ['noun', 'suffix']), ('itak', ['verb'])) t(title, poss)")
def wiki_parts_of_speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of speech from templates, categories and hyphens."""
    rows = [("-pa", "{{head|ain|noun}}"), ("itak", "{{ain-verb}} x")]
    return spark.createDataFrame(rows, "title string, text string").select("title", textclean.wiki_pos(F.col("title"), F.col("text")).alias("poss"))


@query("SELECT * FROM (VALUES (1, 'ku=', 'I'), (1, 'itak', 'speak')) t(id, morpheme, gloss)")
def affix_compositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Morphemes of affix templates with their glosses."""
    d = spark.createDataFrame([(1, "{{affix|ain|ku{{=}}|itak|t1=I|t2=speak}}。")], "id int, text string")
    return d.select("id", F.explode(textclean.affix_parts(F.col("text"))).alias("p")).select("id", "p.*")


@query("SELECT * FROM (VALUES ('カムイ', 'kana'), ('kamuy', 'latin'), ('神の kamuy', 'jpn'), ('12 34', 'other')) t(line, class)")
def script_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by script."""
    d = spark.createDataFrame([("カムイ",), ("kamuy",), ("神の kamuy",), ("12 34",)], "line string")
    return d.select("line", textclean.script_class(F.col("line")).alias("class"))


@query("SELECT * FROM (VALUES ('xｸｼﾌﾟ', 'xㇰㇱㇷ゚', '1)herohki herohki', 'herohki')) t(a, small, b, once)")
def kana_and_lemma_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """small kana and doubled lemmas."""
    d = spark.createDataFrame([("xｸｼﾌﾟ", "1)herohki herohki")], "a string, b string")
    return d.select("a", orthography.small_kana(F.col("a")).alias("small"), "b", orthography.single_lemma(F.col("b")).alias("once"))


@query("SELECT * FROM (VALUES ('def（出典：A、p1）', 'A', 'def'), ('B', '', 'B')) t(x, cite, rest)")
def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations of definitions, and definitions without them."""
    d = spark.createDataFrame([("def（出典：A、p1）",), ("B",)], "x string").withColumn("cite", textclean.citation(F.col("x")))
    return d.select("x", "cite", F.when(F.col("cite") == "", F.col("x")).otherwise(textclean.strip_citation(F.col("x"), F.col("cite"))).alias("rest"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'exact_match' WHEN doc_id % 4 = 1 THEN 'normalized_match' WHEN doc_id % 4 = 2 AND doc_id % 8 <> 2 THEN 'judge' ELSE 'manual_review' END AS method, CASE WHEN doc_id % 4 <= 1 THEN 'a' WHEN doc_id % 4 = 2 AND doc_id % 8 <> 2 THEN 'b' ELSE '' END AS winner, CASE WHEN doc_id % 4 <= 1 THEN false WHEN doc_id % 4 = 2 AND doc_id % 8 <> 2 THEN doc_id % 3 = 0 ELSE true END AS review FROM documents")
def decision_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The better of two readings of a page, or a review."""
    m = F.col("doc_id") % 4
    d = table(spark, sf_dir, "documents").withColumn("b", F.when(m == 0, F.col("text")).when(m == 1, F.concat(F.lit("  "), "text", F.lit("\n"))).otherwise(F.concat("text", F.lit("x"))))
    judge = F.when((m == 2) & (F.col("doc_id") % 8 != 2), F.struct(F.lit("b").alias("winner"), F.when(F.col("doc_id") % 3 == 0, 0.5).otherwise(0.9).alias("confidence")))
    return decisions.decide(d, "text", "b", judge=judge).select("doc_id", "method", F.coalesce("winner", F.lit("")).alias("winner"), "review")


@query("SELECT event_type AS model, count(*) AS runs, count(value) AS known, round(avg(value), 6) AS mean_cost, round(avg(value) * 681, 4) AS estimate FROM events GROUP BY event_type")
def ocr_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and estimated costs by model."""
    c = decisions.costs(table(spark, sf_dir, "events"), 681, "event_type", "value")
    return c.select(F.col("event_type").alias("model"), "runs", "known", F.round("mean_cost", 6).alias("mean_cost"), F.round("estimate", 4).alias("estimate"))


@query("WITH a AS (SELECT c_nationkey AS k, c_name AS v, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n FROM customer), b AS (SELECT s_nationkey AS k, s_name AS v, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n FROM supplier) SELECT coalesce(a.k, b.k) AS k, CAST(coalesce(a.n, b.n) AS INTEGER) AS n, coalesce(a.v, '') AS a, coalesce(b.v, '') AS b FROM a FULL JOIN b ON a.k = b.k AND a.n = b.n WHERE coalesce(a.n, b.n) <= 6")
def side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of two readings next to each other."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("o"), F.col("c_name").alias("v"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("o"), F.col("s_name").alias("v"))
    return decisions.side_by_side(c, s, "k", "o", "v", 6).na.fill("", ["a", "b"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'E' WHEN o_orderkey % 3 = 0 THEN 'O' WHEN o_orderstatus <> 'F' THEN o_orderstatus ELSE '' END AS text, CASE WHEN o_orderkey % 5 = 0 THEN 'edited' WHEN o_orderkey % 3 = 0 THEN 'override' WHEN o_orderstatus <> 'F' THEN 'auto' ELSE 'unresolved' END AS resolution FROM orders")
def review_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edited text, then override, then the automatic choice."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("auto"))
    e = o.filter("o_orderkey % 5 = 0").select("o_orderkey", F.lit("E").alias("text"))
    v = o.filter("o_orderkey % 3 = 0").select("o_orderkey", F.lit("O").alias("text"))
    return decisions.resolve(o, e, v, "o_orderkey", "auto").na.fill("", ["text"])


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def events_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An addition: counts by tumbling windows, the same in batch and stream."""
    return incremental.windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type")


@query("SELECT '{\"lemma\":\"' || p_brand || '\"' || CASE WHEN p_size > 10 THEN ',\"forms\":[\"' || p_type || '\"]' ELSE '' END || '}' AS line FROM part")
def compact_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines in a fixed order without empty lists."""
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("lemma"), F.when(F.col("p_size") > 10, F.array("p_type")).otherwise(F.array().cast("array<string>")).alias("forms"))
    return sinks.compact_json(p, "lemma", "forms")


@query("SELECT '{\"custom_id\":\"' || item_id || '\",\"method\":\"POST\",\"body\":{\"model\":\"none\",\"messages\":[{\"role\":\"user\",\"content\":' || CAST(to_json('Translate: ' || text) AS VARCHAR) || '}]}}' AS line FROM benchmark")
def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request rows for texts, bodies only."""
    return sinks.request_lines(table(spark, sf_dir, "benchmark"), "item_id", F.concat(F.lit("Translate: "), "text"), "none")


@query("SELECT p_brand AS page, coalesce(string_agg(p_name, chr(10) ORDER BY p_partkey) FILTER (WHERE r IS NULL OR p_partkey < r), '') AS body, coalesce(string_agg(p_name, chr(10) ORDER BY p_partkey) FILTER (WHERE p_partkey > r), '') AS notes FROM (SELECT *, max(CASE WHEN p_size = 7 THEN p_partkey END) OVER (PARTITION BY p_brand) AS r FROM part) WHERE p_size <> 7 GROUP BY p_brand")
def footnote_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's body and its notes below the last rule."""
    lines = table(spark, sf_dir, "part").select(F.col("p_brand").alias("page"), F.col("p_partkey").alias("n"), F.when(F.col("p_size") == 7, "-----").otherwise(F.col("p_name")).alias("line"))
    return layout.split_at_last_rule(lines, "page", "n", "line")


@query("""WITH r AS (SELECT p_brand AS k, p_partkey AS n, p_size % 4 AS m, p_name, p_type, last_value(CASE WHEN p_size % 4 = 0 THEN p_partkey END IGNORE NULLS) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS num, last_value(CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN '訳' END IGNORE NULLS) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS tag FROM part),
t AS (SELECT k, num, tag, string_agg(CASE m WHEN 1 THEN p_type ELSE p_name END, ' ' ORDER BY n) AS said FROM r WHERE num IS NOT NULL GROUP BY k, num, tag) SELECT k, CAST(num AS INTEGER) AS num, list(tag || ':' || said ORDER BY tag) AS parts FROM t GROUP BY k, num""")
def tagged_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered turns with tagged lines."""
    p = table(spark, sf_dir, "part")
    line = F.when(F.col("p_size") % 4 == 0, F.concat_ws(". ", "p_partkey", "p_name")).when(F.col("p_size") % 4 == 1, F.concat(F.lit("【訳】"), "p_type")).otherwise(F.col("p_name"))
    t = layout.tagged_turns(p.select(F.col("p_brand").alias("k"), F.col("p_partkey").alias("n"), line.alias("line")), "k", "n", "line")
    return t.select("k", "num", F.transform(F.map_entries("parts"), lambda e: F.concat_ws(":", e["key"], e["value"])).alias("parts"))


@query("SELECT p_partkey, [p_brand] AS ja, CASE WHEN p_size > 40 THEN 'changed' ELSE p_type END AS v FROM part")
def array_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values replaced by a key that holds a list."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.array("p_brand").alias("ja"), F.col("p_type").alias("v"), "p_size")
    c = p.filter("p_size > 40").select("p_partkey", "ja", F.lit("changed").alias("v"))
    return fusion.override(p.drop("p_size"), c, ["p_partkey", "ja"], "v")


@query("SELECT a.s_suppkey AS a, b.s_suppkey AS b, a.s_nationkey AS origin FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey")
def variant_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different forms of one origin, in pairs."""
    return fusion.variant_pairs(table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "origin"), "s_suppkey", "origin")


@query("""SELECT * FROM (VALUES (1, '--- a' || chr(10) || '+++ b' || chr(10) || '@@ -1,2 +1,2 @@' || chr(10) || '-イタク' || chr(10) || '+イタㇰ' || chr(10) || ' x', ['- イタク', '+ イタㇰ', '  x'], 'イタㇰ' || chr(10) || 'x', 'イタク' || chr(10) || 'x'),
(2, '--- a' || chr(10) || '+++ b' || chr(10) || '@@ -1 +1 @@' || chr(10) || '-ｱ b' || chr(10) || '+ｱ c', ['  ｱ', '- b', '+ c'], 'ｱ b', 'ア b'), (3, '--- a' || chr(10) || '+++ b' || chr(10) || '@@ -0,0 +1 @@' || chr(10) || '+n', ['+ n'], NULL, NULL)) t(id, diff, words, restored, key)""")
def review_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of two readings, small kana restored from one, and sort keys."""
    d = spark.createDataFrame([(1, "イタク\nx", "イタㇰ\nx"), (2, "ｱ b", "ｱ c"), (3, None, "n")], "id int, a string, b string")
    return d.select("id", textdiff.unified_diff("a", "b").alias("diff"), textdiff.word_diff("a", "b").alias("words"), textdiff.restore_small_kana("a", "b").alias("restored"), textdiff.compatibility_key("a").alias("key"))
