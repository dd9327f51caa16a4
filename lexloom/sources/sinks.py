"""Writers of the formats that are handed on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.operators.ranking import with_totals


def write_tsv(df: DataFrame, path: str, header: bool = True, by: str | None = None) -> None:
    w = df.write.mode("overwrite").option("sep", "\t").option("header", header)
    (w.partitionBy(by) if by else w).csv(path)


def write_lines(df: DataFrame, path: str, line: str = "line", by: str | None = None) -> None:
    w = df.select(*([by] if by else []), line).write.mode("overwrite")
    (w.partitionBy(by) if by else w).text(path)


def with_dynamic_columns(parts: list[DataFrame], reason: str = "none") -> DataFrame:
    """All parts with the union of their columns, sorted by name. Without columns: one row that says why."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*sorted(out.columns)) if out.columns else out.sparkSession.createDataFrame([(reason,)], "reason string")


def most_common(counts: DataFrame, n: str = "n", first: str | None = None, limit: int | None = None) -> DataFrame:
    """Largest count first, ties in order of first appearance (or of all other columns)."""
    out = counts.orderBy(F.desc(n), *([first] if first else [c for c in counts.columns if c != n]))
    return out.limit(limit) if limit else out


def compact_json(df: DataFrame, *order: str) -> DataFrame:
    """One JSON object a row, keys in the order given, empty arrays and nulls left out."""
    kinds = dict(df.dtypes)
    cols = [F.when(F.size(c) > 0, F.col(c)).alias(c) if kinds[c].startswith("array") else F.col(c) for c in (order or df.columns)]
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "true"}).alias("line"))


def chunked(df: DataFrame, order: list[str], size: int = 250) -> DataFrame:
    """df with `chunk`: numbers of consecutive rows of a table in order of columns without nulls, by ranges of them."""
    return with_totals(df, [F.col(c) for c in order], "__at").withColumn("chunk", F.floor((F.col("__at") - 1) / size)).drop("__at")


def conllu_lines(sentences: DataFrame, book: str = "book", sent: str = "sent_id", text: str = "text", tokens: str = "tokens") -> DataFrame:
    """book, sent, line: a block for each sentence; tokens are array<struct<form,lemma,upos,xpos,feats>>; a blank line ends
    a block."""
    row = lambda t, i: F.concat_ws("\t", i + 1, t["form"], t["lemma"], t["upos"], t["xpos"], t["feats"], F.lit("_"), F.lit("_"), F.lit("_"), F.lit("_"))
    block = F.concat(F.array(F.concat(F.lit("# sent_id = "), F.col(sent)), F.concat(F.lit("# text = "), F.col(text))), F.transform(tokens, row), F.array(F.lit("")))
    return sentences.select(book, sent, F.array_join(block, "\n").alias("line"))


def wiki_list(word: Column, n: Column, language: str = "ain") -> Column:
    return F.format_string(f"* {{{{l|{language}|%s}}}} (%d)", word, n)


def request_lines(df: DataFrame, key: str, prompt: Column, model: str) -> DataFrame:
    """Rows of a batch request file: bodies only, nothing is sent."""
    body = F.struct(F.lit(model).alias("model"), F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content"))).alias("messages"))
    return df.select(F.to_json(F.struct(F.col(key).cast("string").alias("custom_id"), F.lit("POST").alias("method"), body.alias("body"))).alias("line"))


def by_slug(df: DataFrame, citation: Column, slugs: dict[str, str]) -> DataFrame:
    """df with `slug`: the short name of a citation, or the citation itself."""
    table = F.create_map(*[F.lit(x) for kv in slugs.items() for x in kv]) if slugs else None
    return df.withColumn("slug", F.coalesce(F.element_at(table, citation), citation) if table is not None else citation)


def metadata_lines(fields: dict, indent: int = 0) -> list[str]:
    """A metadata file of a dictionary in YAML: nested maps, lists of words, long texts as blocks; keys in order."""
    out, pad = [], "  " * indent
    for key, value in fields.items():
        if isinstance(value, dict):
            out += [f"{pad}{key}:", *metadata_lines(value, indent + 1)]
        elif isinstance(value, list):
            out += [f"{pad}{key}:", *(f"{pad}  - {v}" for v in value)]
        elif isinstance(value, str) and "\n" in value:
            out += [f"{pad}{key}: |", *(f"{pad}  {line}" for line in value.rstrip("\n").split("\n"))]
        else:
            out.append(f"{pad}{key}: {value}")
    return out


def write_file(spark, path: str, text: str, encoding: str = "utf-8") -> str:
    """One file made on the driver, of driver size (metadata, settings, small samples), through the cluster's file system."""
    return write_bytes(spark, path, text.encode(encoding))


def write_bytes(spark, path: str, data: bytes) -> str:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return path
