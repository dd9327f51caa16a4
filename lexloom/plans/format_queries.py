"""Queries of readers, writers, filters and parsers: files are made from the tables, read back and held against SQL."""

from __future__ import annotations

import io
import json
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.config import env_file, settings
from lexloom.functions import entries, orthography, textclean, textdiff
from lexloom.functions import tokens as tk
from lexloom.operators import counts, decisions, fusion, layout, lexicon, search
from lexloom.operators.ranking import with_totals
from lexloom.plans.corpus_queries import Query, table
from lexloom.sources import readers, sinks
from lexloom.sources.workspace import folder
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


def _nations(spark: SparkSession, sf_dir: str) -> list:
    """The 25 rows of the smallest table, for files made on the driver."""
    return table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()


# --- files ---


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS text, CASE c_custkey % 4 WHEN 0 THEN 'sakhalin' WHEN 1 THEN 'hokkaido' ELSE 'other' END AS bucket FROM customer")
def read_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of JSON with blank ones between, and a field that is a list, a string or absent, told to a bucket."""
    at = folder(spark, "lines")
    m = F.col("c_custkey") % 4
    dialect = F.when(m == 0, ',"dialect":["北海道","樺太"]').when(m == 1, ',"dialect":"北海道南部"').when(m == 2, "").otherwise(',"dialect":"x"')
    line = F.concat(F.lit('{"id":"'), "c_custkey", F.lit('","text":"'), "c_name", F.lit('"'), dialect, F.lit("}\n"))
    sinks.write_lines(table(spark, sf_dir, "customer").select(line.alias("line")), f"{at}/a")
    told = counts.bucket_of(counts.string_or_list(F.col("dialect")), [("樺太", "sakhalin"), ("北海道", "hokkaido")])
    return readers.jsonl(spark, f"{at}/a").select("id", "text", told.alias("bucket"))


@query("SELECT 'region_' || n_regionkey AS story_id, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) AS ord, CAST(n_nationkey AS VARCHAR) AS story_sentence_id, n_name AS text FROM nation")
def read_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a list of records each, in order, named by the file."""
    at, rows = folder(spark, "stories"), _nations(spark, sf_dir)
    for region in sorted({r["n_regionkey"] for r in rows}):
        data = [{"story_sentence_id": str(r["n_nationkey"]), "text": r["n_name"]} for r in rows if r["n_regionkey"] == region]
        sinks.write_file(spark, f"{at}/region_{region}.json", json.dumps({"data": data}))
    return readers.json_data_list(spark, at).select("story_id", "ord", "story_sentence_id", "text")


@query("SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS ord, n_name AS key, [n_name, CAST(n_regionkey AS VARCHAR)] AS value FROM nation")
def read_json_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object whose keys are lemmas, in the file's order."""
    at = folder(spark, "map")
    sinks.write_file(spark, f"{at}/m.json", json.dumps({r["n_name"]: [r["n_name"], str(r["n_regionkey"])] for r in _nations(spark, sf_dir)}, ensure_ascii=False))
    return readers.json_map(spark, f"{at}/m.json", "array<string>")


@query("SELECT n_nationkey AS k, n_name AS name FROM nation")
def read_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One array of records over several lines."""
    at = folder(spark, "array")
    sinks.write_file(spark, f"{at}/a.json", json.dumps([{"k": r["n_nationkey"], "name": r["n_name"]} for r in _nations(spark, sf_dir)], indent=2))
    return readers.json_records(spark, f"{at}/a.json", "k int, name string")


@query("SELECT p_brand AS lemma, p_type AS gloss, min(p_partkey) AS id FROM part WHERE p_size % 7 <> 0 GROUP BY ALL")
def read_tsv_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headered tables of tabs and of commas; incomplete rows left out, repeated ones once."""
    at = folder(spark, "tsv")
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.when(F.col("p_size") % 7 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("p_type"))
    sinks.write_tsv(rows.filter("p_partkey % 2 = 0"), f"{at}/t")
    rows.filter("p_partkey % 2 = 1").write.option("header", True).csv(f"{at}/c")
    schema = "id long, lemma string, gloss string"
    both = readers.tsv(spark, f"{at}/t", schema).unionByName(readers.tsv(spark, f"{at}/c", schema, sep=","))
    return readers.complete_rows(both, ["lemma", "gloss"], ["lemma", "gloss"], ["id"]).select("id", "lemma", "gloss")


@query("SELECT 'book_' || n_regionkey AS book, n_name AS word, CAST(n_nationkey * 3 + 1 AS BIGINT) AS freq, CAST(row_number() OVER (ORDER BY n_nationkey DESC) AS INTEGER) AS place FROM nation")
def read_count_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of word and count for each book, without header or quoting; largest first."""
    at, rows = folder(spark, "books"), _nations(spark, sf_dir)
    for region in sorted({r["n_regionkey"] for r in rows}):
        sinks.write_file(spark, f"{at}/book_{region}.tsv", "".join(f"{r['n_name']}\t{r['n_nationkey'] * 3 + 1}\n" for r in rows if r["n_regionkey"] == region))
    c = readers.word_counts(spark, f"{at}/*.tsv").select("book", "word", "freq")
    return with_totals(c, [-F.col("freq"), F.col("word")], "place").select("book", "word", "freq", F.col("place").cast("int").alias("place"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation")
def read_after_preamble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows behind a preamble that ends with the header."""
    at = folder(spark, "preamble")
    sinks.write_file(spark, f"{at}/p.csv", "# a note\nanother, line\n\nid,name\n" + "".join(f"{r['n_nationkey']},{r['n_name']}\n" for r in _nations(spark, sf_dir)))
    rows = readers.after_preamble(spark, f"{at}/p.csv", "id,name")
    return rows.select(F.col("row")["id"].alias("id"), F.col("row")["name"].alias("name"))


@query("SELECT n_name AS a, CAST(n_nationkey AS VARCHAR) AS b FROM nation WHERE n_nationkey % 3 <> 0")
def read_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with at least as many fields as are needed."""
    at = folder(spark, "wide")
    sinks.write_file(spark, f"{at}/w.tsv", "".join(f"{r['n_name']}" + ("" if r["n_nationkey"] % 3 == 0 else f"\t{r['n_nationkey']}\t") + "\n" for r in _nations(spark, sf_dir)))
    return readers.rows_of_width(spark.read.text(f"{at}/w.tsv"), 3).select(F.col("cells")[0].alias("a"), F.col("cells")[1].alias("b"))


@query("SELECT n_name AS title, 'to see ' || n_name AS gloss FROM nation WHERE n_nationkey % 4 = 0")
def read_wiki_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump's pages of the main namespace with the language's heading, and their definitions."""
    at = folder(spark, "dump")
    pages = []
    for r in _nations(spark, sf_dir):
        heading = "==Ainu==" if r["n_nationkey"] % 2 == 0 else "==English=="
        text = f"{heading}\n===Verb===\n# to [[see|see]] {r['n_name']}\n#* no &amp;amp; no\n"
        pages.append(f"<page><title>{r['n_name']}</title><ns>{0 if r['n_nationkey'] % 4 in (0, 1) else 10}</ns><revision><id>1</id><text xml:space=\"preserve\">{text}</text></revision></page>")
    sinks.write_file(spark, f"{at}/dump.xml", "<mediawiki>\n" + "\n".join(pages) + "\n</mediawiki>\n")
    return readers.wiki_dump(spark, f"{at}/dump.xml").select("title", F.explode(textclean.wiki_glosses_en(F.col("text"))).alias("gloss"))


@query("SELECT 'r' || n_regionkey || '.txt' AS member, string_agg(n_name, chr(10) ORDER BY n_nationkey) AS text FROM nation GROUP BY n_regionkey")
def read_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files inside an archive."""
    at, data, rows = folder(spark, "zip"), io.BytesIO(), _nations(spark, sf_dir)
    with zipfile.ZipFile(data, "w") as z:
        for region in sorted({r["n_regionkey"] for r in rows}):
            z.writestr(f"r{region}.txt", "\n".join(r["n_name"] for r in rows if r["n_regionkey"] == region))
    sinks.write_bytes(spark, f"{at}/a.zip", data.getvalue())
    return readers.zip_members(spark, f"{at}/a.zip").select("member", "text")


@query("SELECT 'nations' AS sheet, CAST(n_nationkey + 2 AS INTEGER) AS \"row\", [n_name, '', CAST(n_regionkey AS VARCHAR)] AS cells FROM nation UNION ALL SELECT 'other', 1, ['only']")
def read_xlsx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sheets of a workbook, cells at their columns."""
    at, data, rows = folder(spark, "xlsx"), io.BytesIO(), _nations(spark, sf_dir)
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    cells = "".join(f'<row r="{i + 2}"><c r="A{i + 2}" t="s"><v>{i}</v></c><c r="C{i + 2}"><v>{r["n_regionkey"]}</v></c></row>' for i, r in enumerate(rows))
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="nations" sheetId="1" r:id="rId1"/><sheet name="other" sheetId="2" r:id="rId2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{r['n_name']}</t></si>" for r in rows) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{cells}</sheetData></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet {ns}><sheetData><row><c t="inlineStr"><is><t>only</t></is></c></row></sheetData></worksheet>')
    sinks.write_bytes(spark, f"{at}/a.xlsx", data.getvalue())
    return readers.xlsx_rows(spark, f"{at}/a.xlsx").select("sheet", "row", "cells")


@query("SELECT CAST(n_regionkey AS INTEGER) AS page, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) AS line, 'アイ' || 'ヌ ' || n_name AS text FROM nation")
def read_layout_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of a layout file gathered into lines by their height, near kana joined."""
    at, rows, seen = folder(spark, "bbox"), _nations(spark, sf_dir), {}
    pages = []
    for region in sorted({r["n_regionkey"] for r in rows}):
        words = []
        for r in (r for r in rows if r["n_regionkey"] == region):
            y = 20.0 * seen.setdefault(region, 0)
            seen[region] += 1
            words += [(0, 20, y, "アイ"), (22, 30, y + 1.5, "ヌ"), (40, 80, y + 0.5, r["n_name"])]
        pages.append(f'<page number="{region}">' + "".join(f'<word xMin="{a}" yMin="{y}" xMax="{b}" yMax="{y + 8}">{t}</word>' for a, b, y, t in reversed(words)) + "</page>")
    sinks.write_file(spark, f"{at}/w.xml", "<doc>" + "\n".join(pages) + "</doc>")
    w = readers.bbox_words(spark, f"{at}/w.xml")
    return layout.line_words(w, ["page"], "ymin", ["xmin", "xmax", "text"], 5.0).select("page", "line", entries.glued(F.col("words")).alias("text"))


@query("SELECT CAST(n_nationkey AS INTEGER) AS page, 'model_' || (n_nationkey % 2) AS model, n_name AS text FROM nation")
def read_page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of pages with a text by each model."""
    at = folder(spark, "pages")
    for r in _nations(spark, sf_dir):
        sinks.write_file(spark, f"{at}/page-{r['n_nationkey']:03d}/ocr/model_{r['n_nationkey'] % 2}.txt", r["n_name"])
    return readers.page_files(spark, f"{at}/page-*/ocr/*.txt")


@query("SELECT * FROM (VALUES ('ISO-8859-1', 'café ñandú'), ('Shift_JIS', 'アイヌ語 辞典'), ('UTF-8', 'kamuy 神')) t(encoding, text)")
def read_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in old encodings, and one with a byte order mark."""
    out, at = None, folder(spark, "old")
    for name, codec, text in (("ISO-8859-1", "iso-8859-1", "café ñandú"), ("Shift_JIS", "shift_jis", "アイヌ語 辞典"), ("UTF-8", "utf-8-sig", "kamuy 神")):
        sinks.write_file(spark, f"{at}/{name}.txt", text, codec)
        part = readers.encoded_text(spark, f"{at}/{name}.txt", name).select(F.lit(name).alias("encoding"), "text")
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT n_nationkey AS k, 3 AS pages, 'page two ' || n_name AS second, 'inside ' || n_name AS section FROM nation")
def text_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages between form feeds, and what lies between two markers."""
    text = F.concat(F.lit("page one BEGIN\fpage two "), "n_name", F.lit("\f*** START ***inside "), "n_name", F.lit("*** END *** after"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", text.alias("t"))
    pages = readers.form_feed_pages(F.col("t"))
    return n.select(F.col("n_nationkey").alias("k"), F.size(pages).alias("pages"), pages[1].alias("second"), readers.marked_section(F.col("t"), "*** START ***", "*** END ***").alias("section"))


@query("SELECT n_nationkey AS k, unnest([[n_name, CAST(n_regionkey AS VARCHAR)], ['x', 'y']]) AS pair FROM nation")
def pipe_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of Markdown with two pairs in a row."""
    text = F.concat(F.lit("| "), "n_name", F.lit(" | "), "n_regionkey", F.lit(" | x | y |\n|---|---|---|---|\nno row"))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.explode(readers.pipe_table(text)).alias("pair"))


@query("SELECT 'sheet' AS sheet, lower(n_name) AS lemma, 'gloss ' || n_nationkey AS gloss FROM nation WHERE regexp_matches(lower(n_name), '^[a-z]+$')")
def read_gloss_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets whose gloss column is told by its header; the Latin words of other cells are lemmas."""
    at = folder(spark, "sheets")
    rows = [r for r in _nations(spark, sf_dir) if r["n_name"].lower().isalpha()]
    sinks.write_file(spark, f"{at}/sheet.tsv", "no\tword\tEnglish gloss\n" + "".join(f"{r['n_nationkey']}\t神 {r['n_name'].lower()}\tgloss {r['n_nationkey']}\n" for r in rows))
    return readers.gloss_sheets(spark, at).select("sheet", "lemma", "gloss")


@query("SELECT n_nationkey AS k, CASE WHEN n_nationkey % 3 = 2 THEN '' ELSE n_name END AS term FROM nation")
def definition_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The term of a page by the first of two patterns that fits."""
    m = F.col("n_nationkey") % 3
    html = F.concat(F.when(m == 0, "<h1>").when(m == 1, "<b class=t>").otherwise("<i>"), "n_name", F.when(m == 0, "</h1>").when(m == 1, "</b> - ").otherwise("</i>"))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), readers.either_pattern(html, ["<h1>(.*?)</h1>", "<b[^>]*>(.*?)</b> -"]).alias("term"))


@query("SELECT CAST(doc_id % 2 AS INTEGER) AS split_ord, doc_id, lang FROM documents")
def chained_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test split before the training split, from folders of their own."""
    at, d = folder(spark, "splits"), table(spark, sf_dir, "documents").select("doc_id", "lang")
    for i, name in enumerate(("test", "train")):
        d.filter(F.col("doc_id") % 2 == i).write.parquet(f"{at}/{name}")
    return readers.chained(spark.read.parquet(f"{at}/test"), spark.read.parquet(f"{at}/train"))


@query("SELECT conv_id, turn, [role, text] AS words FROM conversations")
def stored_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus with nested fields, stored (as Parquet, never as code) and read back."""
    at = folder(spark, "corpus")
    table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array("role", "text").alias("words")).write.parquet(f"{at}/c")
    return spark.read.parquet(f"{at}/c")


_META = [("type: word-list",), ("title: Nations",), ("author:",), ("  en: A. Author",), ("year: 2020",), ("dialect:",), ("  name: north",), ("  paths:",), ("    - a",), ("    - b",), ("source: |",), ("  first line",), ("  second line",)]


@query("SELECT * FROM (VALUES " + ", ".join(f"({i}, '{x}')" for i, (x,) in enumerate(_META)) + ") t(n, line)")
def dictionary_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary's metadata file."""
    fields = {"type": "word-list", "title": "Nations", "author": {"en": "A. Author"}, "year": 2020, "dialect": {"name": "north", "paths": ["a", "b"]}, "source": "first line\nsecond line\n"}
    at = sinks.write_file(spark, f"{folder(spark, 'meta')}/metadata.yaml", "\n".join(sinks.metadata_lines(fields)) + "\n")
    return spark.read.text(at, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("n", "line"))


@query("SELECT * FROM (VALUES ('dpi', '300'), ('model', 'given'), ('threads', '6')) t(name, value)")
def run_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings of the command line, then of a file, then defaults."""
    import tempfile
    from pathlib import Path

    from lexloom.config import toml_section

    with tempfile.TemporaryDirectory() as d:  # files that the driver alone reads
        Path(d, "c.toml").write_text('[run]\nmodel = "file"\nthreads = 6\nother = 1\n')
        Path(d, ".env").write_text("# no\nexport dpi='300'\nmodel=env\n")
        file = env_file(Path(d, ".env")) | toml_section(Path(d, "c.toml"), "run")
    s = settings({"dpi": 150, "model": "default", "threads": 1}, file, {"model": "given", "threads": None})
    return spark.createDataFrame([(k, str(v)) for k, v in s.items()], "name string, value string")


@query("SELECT p_partkey, CASE p_brand WHEN 'Brand#1' THEN 'one' WHEN 'Brand#2' THEN 'two' ELSE p_brand END AS slug FROM part")
def citation_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table split by the short name of its citation, which is the citation itself where it has none; read back
    from the folders of the split."""
    at = folder(spark, "slugs")
    sinks.by_slug(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("p_brand"), {"Brand#1": "one", "Brand#2": "two"}).select("p_partkey", "slug").write.partitionBy("slug").parquet(f"{at}/s")
    return spark.read.schema("p_partkey long, slug string").parquet(f"{at}/s")


# --- tables ---


@query("SELECT a, min(b) AS gloss_in FROM (SELECT n_name AS a, CASE WHEN n_nationkey % 2 = 0 THEN n_name WHEN n_nationkey % 3 = 0 THEN 'third' ELSE '' END AS b FROM nation) GROUP BY a")
def sibling_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of several columns, present or not, that isn't empty."""
    n = table(spark, sf_dir, "nation").select("n_name", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise("").alias("gloss"), F.when(F.col("n_nationkey") % 3 == 0, "third").alias("meaning"))
    return n.select(F.col("n_name").alias("a"), readers.first_present(n, "gloss", "absent", "meaning").alias("gloss_in"))


_DOC_WORDS = "SELECT unnest(string_split_regex(text, '\\s+')) AS w FROM documents"


@query(f"SELECT w, count(*) AS n FROM ({_DOC_WORDS}) WHERE regexp_matches(w, '^[\\p{{Nd}}\\p{{P}}]+$') GROUP BY w")
def signs_only_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of digits and punctuation only."""
    w = table(spark, sf_dir, "documents").select(F.explode(F.split("text", r"\s+")).alias("w"))
    return w.filter(entries.signs_only(F.col("w"))).groupBy("w").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey FROM part WHERE (p_size > 1 OR p_partkey % 2 = 0) AND p_partkey % 5 <> 0")
def worthwhile_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms that occur more than once or have a gloss, and aren't numbers."""
    p = table(spark, sf_dir, "part").withColumn("lemma", F.when(F.col("p_partkey") % 5 == 0, F.col("p_size").cast("string")).otherwise(F.col("p_name")))
    return p.filter(entries.worth_keeping(F.col("lemma"), F.col("p_size"), F.when(F.col("p_partkey") % 2 == 0, F.array("p_type")).otherwise(F.array().cast("array<string>")))).select("p_partkey")


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size % 2 = 0 THEN 'answer ' || p_name END AS answer FROM part")
def batch_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of a batch, in any order and perhaps repeated, joined to what was asked by its id."""
    p = table(spark, sf_dir, "part")
    r = p.filter("p_size % 2 = 0").select(F.col("p_partkey").cast("string").alias("custom_id"), F.concat(F.lit("answer "), "p_name").alias("answer"), F.lit(1).alias("ord"))
    r = r.unionByName(r.withColumn("answer", F.lit("an earlier one")).withColumn("ord", F.lit(0)))
    return decisions.with_responses(p.select(F.col("p_partkey").cast("string").alias("id")), r, "id", "answer")


@query("WITH a AS (SELECT c_name, row_number() OVER (ORDER BY c_custkey) AS i FROM customer), b AS (SELECT s_name, row_number() OVER (ORDER BY s_suppkey DESC) AS i FROM supplier) SELECT c_name, s_name FROM a JOIN b USING (i)")
def zipped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables next to each other by place, as long as the shorter one."""
    c, s = table(spark, sf_dir, "customer").select("c_custkey", "c_name"), table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return decisions.zipped(c, s, [F.col("c_custkey")], [-F.col("s_suppkey")]).select("c_name", "s_name")


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 5 WHEN p_partkey % 3 = 1 THEN 1 ELSE 0 END AS at FROM part".replace(" AS at ", ' AS "at" '))
def entries_on_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where an entry begins a line of its page."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_partkey").alias("page"), F.col("p_name").alias("lemma"))
    m = F.col("p_partkey") % 3
    text = F.concat(F.when(m == 0, "one\n").when(m == 1, "").otherwise("one "), "p_name", F.lit(", a gloss"))
    pages = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("no"), text.alias("t"))
    return layout.entry_on_page(p, pages.select(F.col("no").alias("page"), "t"), "page", "lemma", "t").select("p_partkey", F.col("at").cast("int").alias("at"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def not_done_yet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a list of what exists doesn't have."""
    return incremental.missing(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey")), "c_custkey")


@query("SELECT CASE WHEN p_size % 3 = 0 THEN 'exact_match' WHEN p_size % 3 = 1 THEN 'normalized_match' ELSE 'manual_review' END AS method, count(*) AS pages, count(*) FILTER (WHERE p_size % 3 < 2) AS a, CAST(0 AS BIGINT) AS b, count(*) FILTER (WHERE p_size % 3 = 2) AS review FROM part GROUP BY ALL")
def decision_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How pages were decided."""
    m = F.col("p_size") % 3
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("x"), F.when(m == 0, F.col("p_name")).when(m == 1, F.concat(F.lit(" "), "p_name")).otherwise(F.concat("p_name", F.lit("z"))).alias("y"))
    return decisions.summary(decisions.decide(p, "x", "y"))


@query("SELECT p_brand AS lemma, count(DISTINCT g) AS glosses FROM (SELECT p_brand, unnest(string_split(p_name, ' ')) AS g FROM part) GROUP BY p_brand")
def gloss_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct glosses of a lemma, from lists."""
    return lexicon.distinct_glosses(table(spark, sf_dir, "part").select("p_brand", F.split("p_name", " ").alias("gs")), "p_brand", "gs").withColumnRenamed("p_brand", "lemma")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS place FROM orders")
def numeric_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that are strings, in the order of their numbers."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    return with_totals(o, [F.col("id").cast("long")], "place").select("id", F.col("place").cast("long").alias("place"))


@query("SELECT w, " + ", ".join(f"count(*) FILTER (WHERE k = {i}) AS c{i}" for i in range(4)) + " FROM (SELECT unnest(string_split(p_name, ' ')) AS w, p_partkey % 4 AS k FROM part) GROUP BY w")
def counter_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of four counters, with the count of each or 0."""
    w = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("w"), F.concat(F.lit("c"), F.col("p_partkey") % 4).alias("k"), F.lit(1).alias("n"))
    return counts.wide_counts(w, "w", "k", ["c0", "c1", "c2", "c3"])


@query("SELECT * FROM (VALUES (1, ['big', 'house']), (2, ['kamuy', 'mountain'])) t(id, tokens)")
def content_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of glosses without words that tell nothing."""
    d = spark.createDataFrame([(1, "The big House, of a one's house"), (2, "kamuy which have been the 'mountain'")], "id int, t string")
    return d.select("id", orthography.gloss_tokens_en(F.col("t")).alias("tokens"))


@query("SELECT coalesce(a.k, b.k) AS k, coalesce(b.v, a.v) AS right_wins, coalesce(a.v, b.v) AS left_wins FROM (SELECT p_partkey AS k, p_name AS v FROM part WHERE p_partkey % 2 = 0) a FULL JOIN (SELECT p_partkey AS k, p_type AS v FROM part WHERE p_partkey % 3 = 0) b ON a.k = b.k")
def merged_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two maps merged, the right one or the left one winning."""
    p = table(spark, sf_dir, "part")
    a, b = p.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("v")), p.filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("k"), F.col("p_type").alias("v"))
    part = lambda x, i: x.withColumn("ord", F.lit(i))
    right = fusion.last_wins(part(a, 0).unionByName(part(b, 1)), "k", "ord").select("k", F.col("v").alias("right_wins"))
    left = fusion.last_wins(part(b, 0).unionByName(part(a, 1)), "k", "ord").select(F.col("k").alias("k2"), F.col("v").alias("left_wins"))
    return right.join(left, F.col("k") == F.col("k2")).drop("k2")


@query("SELECT form, frequency, CAST(coalesce(sum(CASE WHEN k = 'en' THEN n END), 0) AS BIGINT) AS en, count(*) AS langs FROM (SELECT w AS form, sum(count(*)) OVER (PARTITION BY w) AS frequency, lang AS k, count(*) AS n FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents) GROUP BY w, lang) GROUP BY ALL HAVING frequency >= 3")
def parsed_breakdowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """counts by language packed into a string, and read out of it again."""
    w = table(spark, sf_dir, "documents").select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("form"))
    f = counts.frequency_by(w.groupBy("lang", "form").agg(F.count(F.lit(1)).alias("n")), "lang").filter("frequency >= 3")
    m = counts.parse_breakdown(F.col("breakdown"))
    return f.select("form", "frequency", F.coalesce(F.element_at(m, "en").cast("long"), F.lit(0).cast("long")).alias("en"), F.size(m).cast("long").alias("langs"))


# --- functions on rows whose results are told here, one by one ---


def _sql(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, list):
        return "[" + ", ".join(map(_sql, v)) + "]"
    if isinstance(v, bool) or not isinstance(v, str):
        return str(v)
    return "'" + v.replace("'", "''") + "'"


def function(name: str, doc: str, schema: str, rows: list[tuple], told) -> None:
    """A query of one function: rows are its arguments and, last, the result that must come out."""
    columns = [c.split()[0] for c in schema.split(",")]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        given = spark.createDataFrame([(i, *r[:-1]) for i, r in enumerate(rows)], f"id int, {schema}")
        return given.select("id", told(*[F.col(c) for c in columns]).alias("result"))

    run.__name__, run.__doc__ = name, doc
    QUERIES[name] = run
    SQL[name] = "SELECT * FROM (VALUES " + ", ".join(f"({i}, {_sql(r[-1])})" for i, r in enumerate(rows)) + ") t(id, result)"


_fields = lambda c, *names: F.array(*[F.coalesce(c[n].cast("string"), F.lit("")) for n in names])

function("fn_long_vowels", "F11: syllables of southern words joined.", "a array<string>", [(["ka", "a"], ["kaa"]), (["am"], ["’an"]), (["si", "o"], ["si", "’o"]), (["tu", "u", "u"], ["tuuu"]), (["", "kim"], ["kin"])], lambda a: tk.merge_long_vowels(a))
function("fn_remove_accent", "F16: letters without marks.", "a string", [("néno", "neno"), ("côsi", "cosi"), ("ñandú 神", "nandu "), ("", "")], tk.remove_accent)
function("fn_ascii_only", "F16: the same for all scripts, by compatibility decomposition.", "a string", [("néno", "neno"), ("ﬁn Å①", "fin A1"), ("神", "")], lambda a: textdiff.ascii_only(a))
function("fn_regional_spelling", "F22: a regional spelling to the modern one.", "a string", [("chikap", "cikap"), ("kamui", "kamuy"), ("shiri", "siri"), ("gaba", "kapa")], orthography.normalize_regional)
function("fn_l_to_i", "F23: l read as i.", "a string", [("lrankarapte", "irankarapte"), ("Lta", "Ita")], orthography.l_to_i)
function("fn_kana_key", "F25: the kana at the beginning.", "a string", [("アイヌ、人", "アイヌ"), ("  ポネ x", "ポネ"), ("abc", "")], orthography.kana_key)
function("fn_kana_and_gloss", "F29: kana and gloss run together.", "a string", [("イヨマ、槍", ["イヨマ", "槍"]), ("アペ", ["アペ", ""]), ("no kana", ["no kana", ""])], lambda a: _fields(orthography.kana_and_gloss(a), "kana", "gloss"))
function("fn_primary_gloss", "F29: the first Japanese run, and the keys it is sought under.", "a string", [("n. 満足スル。x", ["満足スル", "満足"]), ("水、the water", ["水"]), ("none", [])], lambda a: orthography.gloss_lookup_variants(orthography.primary_gloss(a)))
function("fn_modern_kanji", "F28: old forms of characters to new ones, by a table given.", "a string", [("國學", "国学"), ("水", "水")], lambda a: orthography.modern_kanji(a, "國學", "国学"))
function("fn_brief_gloss", "F30: what follows the part of speech.", "a string", [("Abe v.t. To see. More", "To see"), ("x n. fire; flame", "fire"), ("y" * 90, "y" * 77 + "...")], orthography.brief_gloss)
function("fn_english_or_not", "F32: marks taken off, and whether a token is a common English word.", "a string", [("thé", ["the", "true"]), ("kamúy", ["kamuy", "false"]), ("Fire", ["fire", "true"])], lambda a: F.array(F.lower(tk.remove_accent(a)), orthography.looks_english(tk.remove_accent(a)).cast("string")))
function("fn_resplit", "F33: a lemma field that holds kana and body too.", "a string, b string, c string", [("Abe, アベ, fire", "", "", ["Abe", "アベ", "fire"]), ("Abe", "アベ", "x", ["Abe", "アベ", "x"]), ("Ape, アペ", "", "the fire", ["Ape", "アペ", "the fire"])], lambda a, b, c: _fields(textclean.resplit(a, b, c), "lemma", "kana", "body"))
function("fn_bare_and_np", "F34: forms without affix marks, np for mp.", "a string", [("a=kor=", "a=kor"), ("-pa", "pa"), ("ampe=", "anpe")], lambda a: orthography.np_for_mp(tk.bare(a)))
function("fn_glosses_cohere", "F35: whether two glosses visibly agree.", "a array<string>, b array<string>", [(["火"], ["火事"], True), (["水"], ["火"], False), ([], ["火"], False)], lambda a, b: orthography.glosses_cohere(a, b, F.array().cast("array<string>"), F.array().cast("array<string>")))
function("fn_phrase_words", "F37: words of a phrase pattern.", "a string", [("N1 kes{pa,to} a=kor itak=an V2!", ["kespa", "kesto", "kor", "itak"]), ("hemanta ne?", ["hemanta", "ne"])], textclean.template_words)
function("fn_school_glosses", "F44: glosses of a school dictionary.", "a string", [("①水、(名) 川 ◆note", ["水", "川"]), ("火→参照", ["火"]), ("[x]1.山2.岳", ["山", "岳"])], textclean.brief_explanation)
function("fn_decompose", "F44: morphemes of an etymology.", "a string, b string", [("a=kor", "a=kor-pe", ["a", "kor", "pe"]), ("a=nu", "a=nu-an", ["nu", "an"]), ("cise", "cise", None), ("x", "y" * 12000 + "-z", ["y" * 12000, "z"])], textclean.decompose)
function("fn_latin_part", "F49: the romanised part of a mixed line, without footnote marks.", "a string", [("神の ku＝kor’ 。", "ku=kor'"), ("itak^24 an²⁴", "itak an"), ("？kamuy", "kamuy")], lambda a: textclean.strip_footnotes(textclean.latin_part(a)))
function("fn_utterance", "F50: a spoken line without bracketed notes, however nested.", "a string", [("[カナ [?] x] itak ＝an 。", "itak =an"), ("a [b [c [d [e] d] c] b] z", "a z"), ("「 kamuy 」", "「kamuy」")], textclean.utterance)
function("fn_head_and_latin", "F55: a head line that ends with Latin words.", "a string", [("カムイ kamuy", ["カムイ", "kamuy"]), ("アイヌ イタク aynu itak", ["アイヌ イタク", "aynu itak"]), ("神", ["", ""])], lambda a: F.coalesce(_fields(textclean.head_and_latin(a), "kana", "latn"), F.array(F.lit(""), F.lit(""))))
function("fn_detect_lemma", "F56: lemma and body of an entry paragraph; a word glued to a bracket goes back to the body.", "a string", [("ape 火。x", ["ape", "火。x"]), ("kamuy huci (神)", ["kamuy huci", "(神)"]), ("aynu itak(言葉)", ["aynu", "itak(言葉)"]), ("Big X", ["", ""])], lambda a: F.coalesce(_fields(textclean.detect_lemma(a), "lemma", "body"), F.array(F.lit(""), F.lit(""))))
function("fn_parenthesised", "F58: forms with their glosses in brackets.", "a string", [("ape（火）wakka（水）", ["ape:火", "wakka:水"]), ("none", [])], lambda a: F.transform(textclean.parenthesised(a), lambda x: F.concat_ws(":", x["form"], x["gloss"])))
function("fn_safe_name", "F62: names that a file may have.", "a string", [("a/b c:d", "a_b_c_d"), ("神 1.2-x", "神_1.2-x")], textclean.safe_name)
function("fn_headed_text", "F70: title, text and notes of a page.", "a string", [("T\n\n語り：X\n\nbody\n【注】n", ["T", "body", "n"]), ("T", ["T", "", ""])], lambda a: _fields(textclean.headed_text(a), "title", "content", "footnotes"))
function("fn_legacy_tokens", "P26: tokens of older counts.", "a string", [("Ku_kor", ["kukor"]), ("ámkir", []), ("a=kór", ["a=", "kr"]), ("12", [])], tk.legacy_clean)
function("fn_morpheme_notes", "P13: morphemes that are noise, refrains or Japanese, and marks resolved.", "a string", [("―", ["", "noise_token", "true"]), ("V2:hm", ["V2:hm", "refrain_marker", "true"]), ("かみ", ["かみ", "japanese_transcript_noise", "true"]), ("kor(?)", ["kor", "uncertain_form_marker_removed", "false"]), ("(a)kor", ["akor", "optional_segment_unwrapped", "false"])], lambda a: F.transform(_fields(lexicon.morpheme_with_note(a), "morpheme", "note", "drop"), lambda x: F.when(x == "―", "").otherwise(x)))
function("fn_topic_header", "P16: headings of topics.", "a string", [("天 文", True), ("天文。", False), ("abc", False), ("とても長い見出し文", False)], textclean.is_topic_header)
function("fn_junk_line", "P24: lines of a word list that aren't entries.", "a string", [("■見出し", True), ("アペ ape 火", False), ("例文：x", True), ("a.indd 3", True), ("単語", True)], entries.junk_line)
function("fn_tagged_entry", "F45: parts of speech and glosses of a tagged definition.", "a string", [("【自動】[x](a) 行く、歩く。☞y", ["vi", "|", "行く", "歩く"]), ("【名＋？/他動】水（出典：A、1）", ["n", "", "vt", "|", "水"]), ("no tag", []), ("【x】y", [])], lambda a: F.coalesce(F.concat(entries.tagged_entry(a)["poses"], F.array(F.lit("|")), entries.tagged_entry(a)["glosses"]), F.array().cast("array<string>")))
function("fn_list_line", "F46: a line of a word list.", "a string", [("アペ ape 火 【名】［x］", ["アペ", "ape", "火", "名", ""]), ("アン an ある 【自】", ["アン", "an", "ある", "自", ""]), ("no", ["", "", "", "", ""])], lambda a: F.coalesce(_fields(entries.list_line(a), "kana", "latin", "gloss", "pos", "note"), F.array(*[F.lit("")] * 5)))
function("fn_list_term", "F46: lists of a word list's row, tags in full.", "a string, b string, c string, d string", [("a pe", "火、 明かり", "【名・位名】", "（ x ）", ["ape", "火|明かり", "名詞|位置名詞", "x"])], lambda a, b, c, d: F.array(entries.list_term(a, b, c, d)["lemma"], F.array_join(entries.list_term(a, b, c, d)["glosses"], "|"), F.array_join(entries.list_term(a, b, c, d)["poses"], "|"), entries.list_term(a, b, c, d)["notes"]))
function("fn_split_tags", "F46: a line with two tags cut in two.", "a string", [("アペ ape 火【名】 アン an ある【自】", ["アペ ape 火【名】", "アン an ある【自】"]), ("one【名】", ["one【名】"])], lambda a: F.transform(entries.lines_with_one_tag(a), lambda x: F.trim(x)))
function("fn_column_entry", "F47: an entry of a column.", "a string", [("アペ ape 火 【名】 note ［more］", ["アペ", "ape", "火", "名", "note more"]), ("アン(x) an ある", ["アン(x)", "an", "ある", "", ""]), ("no entry", [""] * 5)], lambda a: _fields(entries.column_entry(a), "kana", "lemma", "gloss", "pos", "notes"))
function("fn_story_text", "F57: the repairs of a story's page.", "a string", [("12 h _ine [3]a =kor su y hetopo\n【注】n", "h_ine a=kor suy hetopo"), ("aynu\n\n\n\nitak 1968  20-8 next", "aynu\n\nitak"), ("k s apa", "ksapa")], entries.story_text)
function("fn_story_page", "F57: a story's page without doubts and stray lines.", "a string", [("a (?)b \n（萱野）\n12\nc", "a b\n\n\nc")], entries.story_page)
function("fn_story_title", "F57: a story's title.", "a string", [(" ウエペケㇾ 「 x 」（ y ） ", "ウエペケㇾ「x」（y）")], entries.story_title)
function("fn_tokenize", "F01-F03: sentences cut into words, affixes and signs.", "a string", [("hioy’oy", ["hioy’oy"]), ("aynu itak k=eyaypakasnu kor k=an!", ["aynu", "itak", "k=", "eyaypakasnu", "kor", "k=", "an", "!"]), ("a=sirkocotca p ne kusu an hine <ne>", ["a=", "sirkocotca", "p", "ne", "kusu", "an", "hine", "<", "ne", ">"]), ("u ne[y] rok awa[n]", ["u", "ne[y]", "rok", "awa[n]"])], lambda a: tk.tokenize(a))
function("fn_normalize", "F04: forms as they are looked up.", "a string", [("w_a", "wa"), ("__hine", "hine"), ("h_ine", "hine"), ("ne[y]", "ne"), ("awa[n]", "awa"), ("[u]", "u"), ("ne'ampe", "neanpe"), ("inkar'", "inkar"), ("’sekor", "sekor")], tk.normalize)
function("fn_accent", "F09: the accented syllable.", "a string", [("úsey", 0), ("tané", 1), ("konkane", 0), ("kuni", 1)], tk.accent)
function("fn_to_sakhalin", "F10: southern forms of northern words.", "a string", [("sat", "sah"), ("pirka", "pirika"), ("ikra", "isra"), ("kim", "kin")], tk.to_sakhalin)
function("fn_syllables", "F12: syllables of words.", "a string", [("konkane", ["kon", "ka", "ne"]), ("itak", ["i", "tak"]), ("pirka", ["pir", "ka"]), ("aynu", ["ay", "nu"])], tk.syllables)
function("fn_lookup_keys", "F24, F26: all keys of a headword, in order.", "a string", [("Chise", ["cise", "cis", "chise", "chis"]), ("=Kamuy2,", ["kamuy"])], orthography.lookup_keys)
function("fn_is_word", "P01: whether a token is a word.", "a string", [("k=", True), ("ne'ampe", True), ("12", False), ("<", False), ("hioy’oy", True)], tk.is_word)


_FOUND = [
    ([], [], [0]), ([], [("wakka", ["noun"])], [0]), ([("wakka", "noun")], [], []), ([("exa", None)], [("exact", ["noun"])], []),
    ([(None, "verb")], [("a", ["verb"]), ("b", ["verb"]), ("c", ["noun"]), ("d", ["verb"])], [0, 1, 3]), ([(None, None), (None, None)], [("a", []), ("b", []), ("c", [])], [0, 1]),
    ([(None, "noun"), (None, "noun")], [("a", ["noun"]), ("b", ["verb"]), ("c", ["noun"]), ("d", ["noun"])], [2]), ([("a", None), ("c", None)], [("a", []), ("b", []), ("c", [])], []),
]


@query("SELECT * FROM (VALUES " + ", ".join(f"({i}, {_sql(w)}{'::INTEGER[]' if not w else ''})" for i, (_, _, w) in enumerate(_FOUND)) + ") t(id, result)")
def fn_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where runs of keywords, by word or part of speech, begin."""
    out = None
    for i, (keywords, words, _) in enumerate(_FOUND):
        df = spark.createDataFrame([(i, words)], "id int, w array<struct<word:string,poss:array<string>>>")
        part = df.select("id", search.find(keywords, F.transform("w", lambda x: x["word"]), F.transform("w", lambda x: x["poss"])).alias("result"))
        out = part if out is None else out.unionByName(part)
    return out
