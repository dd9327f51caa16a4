"""Documents through toxicity, quality, near duplicates, secrets and packing.

Each stage takes (spark, docs, sf_dir) and works on all of docs, the rows that the stage before kept; all but the last
return the columns of documents. run() applies them to the documents of a folder, each stage's result written and read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import importance, ngram_join, packing, secret_scan, toxicity
from lexloom.llm.bloom import filled, has, spots
from lexloom.llm.llm_queries import secret_model, table, vocabulary
from lexloom.llm.tables import bound_batches, discard, keep, unused

#: A document goes if its toxicity reaches this.
TOXIC = 0.3
#: Near duplicates: words in a shingle, and the least similarity as a ratio.
WORDS, SIMILAR = 5, (80, 100)
WINDOW = 2048


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under TOXIC. Null and empty texts score by the share of such examples, so they stay; repeated
    rows share their fate; an empty table stays empty."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), threshold=TOXIC)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws; as many as rejection sampling would accept, so clean ones stay. Null
    and empty texts have weight 1; repeated rows share their fate; an empty table stays empty."""
    model = importance.fit(docs, table(spark, sf_dir, "labels"))
    return importance.keep_selected(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: that of the smallest doc_id, then of the smallest hash. Rows of
    one doc_id with different texts, and rows without doc_id, are documents of their own: where ids repeat, rows are told
    apart by a hash of doc_id and text. Of rows that are equal in both one stays. Documents without words stay. Texts of documents that may go
    move once, all others stay where they are: a Bloom filter tells them apart, as how many go isn't bounded."""
    own, may, gone = (unused(x, docs) for x in ("row", "may", "gone"))
    repeated = not docs.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").isEmpty()
    row = F.xxhash64("doc_id", "text")
    marked = docs.withColumn(own, row if repeated else F.coalesce(F.col("doc_id").cast("long"), row))
    joined = ngram_join.join(marked.select(own, "text"), WORDS, *SIMILAR, key=own)
    component = joined.filter("n_shingles > 0").groupBy(own).agg(F.min("component_id").alias("component"))
    ids = marked.groupBy(F.col(own).alias("r")).agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("rows"))
    found = keep(component.join(ids, F.col(own) == F.col("r")).select("component", "r", "id", "rows"), "components")
    discard(joined)
    stay = found.groupBy(F.col("component").alias("c")).agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "r"))["r"].alias("s"))
    told = found.join(stay, F.col("component") == F.col("c")).select(F.col("r").alias(gone), (F.col("r") != F.col("s")).alias("goes"), "rows")
    told = keep(told.filter("goes or rows > 1"), "told")
    discard(found)
    shared = spark.sparkContext.broadcast(filled(told, gone))

    def can(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(has(shared.value, x.to_numpy(), y.to_numpy()))

    bound_batches(spark)
    marked = marked.withColumn(may, F.pandas_udf(can, "boolean")(*spots(F.col(own))))
    on = F.col(own) == F.col(gone)
    left = marked.filter(may).join(told.filter("goes").select(gone).hint("shuffle_merge"), on, "left_anti")
    twice = told.filter("not goes").select(gone)
    if not twice.isEmpty():
        left = left.join(twice, on, "left_anti").unionByName(left.join(twice, on, "left_semi").dropDuplicates([own]))
    return marked.filter(~F.col(may)).unionByName(left).drop(own, may)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and n_chars counted anew; null texts keep theirs. Rows stay as they are, repeated
    ones too; an empty table stays empty."""
    out = secret_scan.redact(docs, secret_model(spark))
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))) if "n_chars" in docs.columns else out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in packed sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null
    and empty texts are a piece of one token; repeated rows are packed each; an empty table gives an empty result."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), WINDOW)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]
#: Stages learn models and tokenize, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, keep(stage(spark, docs, sf_dir), name)
        discard(before)  # no table that run() read itself, only what it kept
    return STAGES[-1][1](spark, docs, sf_dir)
