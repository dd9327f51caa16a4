"""Readers of the formats that corpora and dictionaries come in, all with explicit schemas."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions.textclean import strip_html

CORPUS_TEXT = "book string, title string, url string, pronoun string, author string, dialect string, text string, translation string, label string"
CORPUS_LINE = "id string, text string, translation string, collection_lv1 string, document string, dialect string, dialect_lv1 string, author string, published_at string, uri string"
GLOSSED_ROW = "story_sentence_id string, text string, morpheme string, gloss_en string, gloss_jp string, translation_en string, translation_jp string"
DICT_ENTRY = "source string, base_conf double, ord long, lemma string, lemma_kana string, definition string"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def _or_empty(spark: SparkSession, path: str, schema: str, read) -> DataFrame:
    return read() if exists(spark, path) else spark.createDataFrame([], schema)


def jsonl(spark: SparkSession, path: str, schema: str = CORPUS_LINE) -> DataFrame:
    """Lines of JSON; blank lines are skipped; lists read as their JSON text where the schema says string."""
    return spark.read.schema(schema).json(path)


def json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that are each an array of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def json_data_list(spark: SparkSession, path: str, schema: str = GLOSSED_ROW) -> DataFrame:
    """Files {"data": [...]}: a row for each record, with story_id (the file's stem) and ord (its place)."""
    whole = spark.read.schema(f"data array<struct<{_fields(schema)}>>").option("multiLine", True).json(path).withColumn("story_id", stem())
    return whole.select("story_id", F.posexplode("data").alias("ord", "r")).select("story_id", "ord", "r.*")


def _fields(schema: str) -> str:
    return ",".join(":".join(f.strip().split(" ", 1)) for f in schema.split(","))


def json_map(spark: SparkSession, path: str, value: str = "string") -> DataFrame:
    """Files {key: value}: rows (ord, key, value) in the file's order."""
    whole = spark.read.text(path, wholetext=True)
    entries = F.map_entries(F.from_json("value", f"map<string,{value}>"))
    return whole.select(F.posexplode(entries).alias("ord", "e")).select("ord", "e.key", "e.value")


def tsv(spark: SparkSession, path: str, schema: str, header: bool = True, quote: str = '"', sep: str = "\t", encoding: str = "UTF-8") -> DataFrame:
    """Tab-separated values; a path without files gives an empty table. quote="" reads signs as they are."""
    return _or_empty(spark, path, schema, lambda: spark.read.schema(schema).option("sep", sep).option("header", header).option("quote", quote).option("encoding", encoding).csv(path))


def word_counts(spark: SparkSession, path: str) -> DataFrame:
    """Tables of word and count without header or quoting, with the file's stem as book."""
    return tsv(spark, path, "word string, freq long", header=False, quote="").withColumn("book", stem())


def stem(c: Column | None = None) -> Column:
    return F.regexp_extract(F.input_file_name() if c is None else c, r"([^/]+?)(?:\.[^./]*)?$", 1)


def after_preamble(spark: SparkSession, path: str, header_starts: str, sep: str = ",") -> DataFrame:
    """Rows behind a preamble of unknown length: lines after the one that begins with `header_starts`, as name -> value."""
    whole = spark.read.text(path, wholetext=True).select(F.split("value", r"\r?\n").alias("lines"))
    at = F.array_position(F.transform("lines", lambda s: s.startswith(header_starts)), True)
    told = whole.filter(at > 0).select(F.split(F.element_at("lines", at.cast("int")), sep).alias("names"), F.slice("lines", at.cast("int") + 1, F.size("lines")).alias("rest"))
    rows = told.select("names", F.posexplode("rest").alias("ord", "line")).filter(F.trim("line") != "")
    return rows.select("ord", F.map_from_arrays("names", F.transform("names", lambda n, i: F.get(F.split("line", sep), i))).alias("row"))


def rows_of_width(lines: DataFrame, least: int, line: str = "value", sep: str = "\t") -> DataFrame:
    """cells (array) of lines with at least so many fields."""
    return lines.select(F.split(line, sep, -1).alias("cells")).filter(F.size("cells") >= least)


def wiki_dump(spark: SparkSession, path: str, heading: str = r"(?m)^==\s*(?:\{\{(?:L\|)?ain\}\}|\{\{ain\}\}|アイヌ語|Ainu)\s*==") -> DataFrame:
    """title, text of a dump's main-namespace pages that have a language's heading. Compressed files are read as they are."""
    schema = "title string, ns string, revision struct<text:struct<_VALUE:string>>"
    pages = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    return pages.filter(F.col("ns") == "0").select("title", F.col("revision.text._VALUE").alias("text")).filter(F.col("text").rlike(heading))


def bbox_words(spark: SparkSession, path: str) -> DataFrame:
    """page, ymin, xmin, xmax, text of a layout file (one `page` element per page with `word` elements)."""
    schema = "word array<struct<_xMin:double,_yMin:double,_xMax:double,_yMax:double,_VALUE:string>>"
    pages = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path).withColumn("page", F.monotonically_increasing_id())
    return pages.select("page", F.explode("word").alias("w")).select("page", F.col("w._yMin").alias("ymin"), F.col("w._xMin").alias("xmin"), F.col("w._xMax").alias("xmax"), F.col("w._VALUE").alias("text"))


def form_feed_pages(text: Column) -> Column:
    return F.split(text, "\f")


def marked_section(text: Column, begin: str, end: str) -> Column:
    """What lies between two markers."""
    return F.substring_index(F.substring_index(text, begin, -1), end, 1)


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """page, model, text of a tree page-NNN/ocr/<model>.txt."""
    whole = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    p = r"page-(\d+)/ocr/([^/]+)\.txt$"
    return whole.filter(F.col("file").rlike(p)).select(F.regexp_extract("file", p, 1).cast("int").alias("page"), F.regexp_extract("file", p, 2).alias("model"), F.col("value").alias("text"))


def encoded_text(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """path, text of whole files in another encoding, any that Python knows; a byte order mark goes, what can't be read
    becomes the replacement character."""

    @F.pandas_udf("string")
    def decoded(content: pd.Series) -> pd.Series:
        return content.map(lambda b: bytes(b).decode(encoding, "replace").removeprefix("\ufeff"))

    return spark.read.format("binaryFile").load(path).select("path", decoded("content").alias("text"))


# --- HTML, by expression ---


def html_tables(pages: DataFrame, key: str, html: str, cells: int = 2) -> DataFrame:
    """key, row, c1 .. cN of table rows with that many cells, cleaned."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row", "tr"))
    rows = rows.withColumn("td", F.regexp_extract_all("tr", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1))).filter(F.size("td") == cells)
    return rows.select(key, "row", *[strip_html(F.col("td")[i]).alias(f"c{i + 1}") for i in range(cells)])


def html_items(pages: DataFrame, key: str, html: str, tag: str) -> DataFrame:
    """key, pos, item: the cleaned contents of each element of a kind."""
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
    return pages.select(key, F.posexplode(found).alias("pos", "raw")).select(key, "pos", strip_html(F.col("raw")).alias("item"))


def html_definitions(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, pos, term, definition: dt and dd elements in pairs."""
    pick = lambda tag: F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
    return pages.select(key, F.posexplode(F.arrays_zip(pick("dt").alias("t"), pick("dd").alias("d"))).alias("pos", "p")).select(key, "pos", strip_html(F.col("p.t")).alias("term"), strip_html(F.col("p.d")).alias("definition"))


def html_events(pages: DataFrame, key: str, html: str, head: str = "h[1-6]", item: str = "li") -> DataFrame:
    """key, pos, section, item: items with the last heading before them, in document order."""
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<(?:{head}|{item})\b[^>]*>.*?</(?:{head}|{item})>"), F.lit(0))
    is_head = lambda e: e.rlike(rf"(?i)^<{head}\b")
    told = F.aggregate(
        found,
        F.struct(F.lit("").alias("section"), F.array().cast("array<struct<section:string,item:string>>").alias("out")),
        lambda s, e: F.struct(F.when(is_head(e), strip_html(e)).otherwise(s["section"]).alias("section"), F.when(is_head(e), s["out"]).otherwise(F.concat(s["out"], F.array(F.struct(s["section"].alias("section"), strip_html(e).alias("item"))))).alias("out")),
    )
    return pages.select(key, F.posexplode(told["out"]).alias("pos", "e")).select(key, "pos", "e.section", "e.item")


def pipe_table(text: Column, pair: int = 2) -> Column:
    """array<array<string>>: rows of a Markdown table without its rule, cut into groups of `pair` cells."""
    rows = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"^\s*\|") & ~s.rlike(r"^[\s|:\-]+$"))
    cells = F.transform(rows, lambda s: F.transform(F.split(F.regexp_replace(F.trim(s), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x)))
    return F.flatten(F.transform(cells, lambda c: F.transform(F.sequence(F.lit(0), F.floor(F.size(c) / pair).cast("int") - 1), lambda i: F.slice(c, i * pair + 1, pair))))


def first_present(df: DataFrame, *names: str) -> Column:
    """The first of these columns that the table has and that isn't empty."""
    there = [F.nullif(F.col(n), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*there, F.lit("")) if there else F.lit("")


def kanji_pairs(spark: SparkSession, path: str) -> tuple[str, str]:
    """Old and new forms of characters, as two strings of equal length, of a table of two columns without header."""
    rows = tsv(spark, path, "old string, new string", header=False, quote="").filter("length(old) = 1 and length(new) = 1").dropDuplicates(["old"]).orderBy("old").limit(100_000).collect()
    return "".join(r["old"] for r in rows), "".join(r["new"] for r in rows)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def gloss_sheets(spark: SparkSession, path: str, name: str = "(?i)gloss|meaning|english") -> DataFrame:
    """sheet, row, lemma, gloss of a folder of TSV sheets whose gloss column is told by its header: each Latin word of
    another cell is a lemma."""
    whole = spark.read.text(path, wholetext=True).select(stem().alias("sheet"), F.split("value", r"\r?\n").alias("ls"))
    head = F.split(F.col("ls")[0], "\t")
    at = F.array_position(F.transform(head, lambda h: h.rlike(name)), True)
    rows = whole.withColumn("g", at).filter("g > 0").select("sheet", "g", F.posexplode(F.slice("ls", 2, F.size("ls"))).alias("row", "line")).filter(F.trim("line") != "")
    rows = rows.withColumn("cells", F.split("line", "\t", -1))
    words = F.flatten(F.transform(F.filter("cells", lambda c, i: i + 1 != F.col("g")), lambda c: F.regexp_extract_all(c, F.lit(r"[A-Za-z][A-Za-z'=\-]+"), F.lit(0))))
    return rows.select("sheet", "row", F.explode(words).alias("lemma"), F.get("cells", F.col("g").cast("int") - 1).alias("gloss"))


def zip_members(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """path, member, text of the files in zip archives, one archive at a time in a task."""
    import io
    import zipfile

    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    out += [(p, m, z.read(m).decode(encoding, "replace")) for m in z.namelist() if not m.endswith("/")]
            yield pd.DataFrame(out, columns=["path", "member", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, member string, text string")


def chained(*parts: DataFrame) -> DataFrame:
    """The rows of several splits one after the other: split_ord (0 for the first), then their columns."""
    out = None
    for i, part in enumerate(parts):
        rows = part.withColumn("split_ord", F.lit(i))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def complete_rows(df: DataFrame, required: list[str], unique: list[str], order: list[str]) -> DataFrame:
    """Rows without null or empty required fields, the first of each combination of the unique ones."""
    whole = df
    for c in required:
        whole = whole.filter(F.col(c).isNotNull() & (F.col(c).cast("string") != ""))
    return whole.groupBy(*[F.col(c).alias(f"__{c}") for c in unique]).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")


def either_pattern(text: Column, patterns: list[str], group: int = 1) -> Column:
    """What the first pattern that is found captures; '' if none is."""
    hit = [F.when(text.rlike(p), F.regexp_extract(text, p, group)) for p in patterns]
    return F.coalesce(*hit, F.lit(""))


def xlsx_rows(spark: SparkSession, path: str) -> DataFrame:
    """path, sheet, row (from 1), cells (array<string>, blanks where a row has none) of the sheets of workbooks, one
    workbook at a time in a task. Numbers read as they are stored; formulas give their stored values."""

    def run(batches):
        import io
        import re
        import zipfile
        from xml.etree import ElementTree

        import pandas as pd

        def local(e, name):
            return [x for x in e.iter() if x.tag.rpartition("}")[2] == name]

        for pdf in batches:
            out = []
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    names = z.namelist()
                    shared = [("".join(t.text or "" for t in local(i, "t"))) for i in local(ElementTree.fromstring(z.read("xl/sharedStrings.xml")), "si")] if "xl/sharedStrings.xml" in names else []
                    rels = {r.get("Id"): r.get("Target") for r in local(ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")), "Relationship")}
                    for sheet in local(ElementTree.fromstring(z.read("xl/workbook.xml")), "sheet"):
                        target = rels[next(v for k, v in sheet.attrib.items() if k.endswith("}id"))].lstrip("/")
                        for n, row in enumerate(local(ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")), "row"), 1):
                            cells: list[str] = []
                            for at, c in enumerate(local(row, "c")):
                                letters = re.match("[A-Z]+", c.get("r") or "")
                                column = at
                                if letters:
                                    column = 0
                                    for ch in letters[0]:
                                        column = column * 26 + ord(ch) - 64
                                    column -= 1
                                text = "".join(t.text or "" for t in local(c, "t")) if c.get("t") == "inlineStr" else "".join(v.text or "" for v in local(c, "v"))
                                cells += [""] * (column - len(cells)) + [shared[int(text)] if c.get("t") == "s" and text else text]
                            out.append((p, sheet.get("name"), int(row.get("r") or n), cells))
            yield pd.DataFrame(out, columns=["path", "sheet", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, sheet string, row int, cells array<string>")
