"""Choice between two readings of a page, overrides, and costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.textclean import same_but_space, small_kana_winner
from lexloom.operators.ranking import with_totals


def decide(pages: DataFrame, a: str, b: str, tie: str = "a", judge: Column | None = None, least_confidence: float = 0.8) -> DataFrame:
    """pages with method, winner, confidence, review: equal texts, texts equal but for white space, small-kana choice, the
    judge's answer (struct winner, confidence) if there is one, else review by hand."""
    x, y = F.col(a), F.col(b)
    small = small_kana_winner(x, y)
    j = judge if judge is not None else F.lit(None).cast("struct<winner:string,confidence:double>")
    method = F.when(x == y, "exact_match").when(same_but_space(x, y), "normalized_match").when(small.isNotNull(), "small_kana_heuristic").when(j.isNotNull(), "judge").otherwise("manual_review")
    out = pages.withColumn("method", method)
    m = F.col("method")
    out = out.withColumn("winner", F.when(m.isin("exact_match", "normalized_match"), tie).when(m == "small_kana_heuristic", small).when(m == "judge", j["winner"]))
    out = out.withColumn("confidence", F.when(m == "exact_match", 1.0).when(m == "normalized_match", 0.98).when(m == "small_kana_heuristic", 0.85).when(m == "judge", j["confidence"]))
    unsure = (m == "judge") & (F.col("confidence").isNull() | (F.col("confidence") < least_confidence))
    return out.withColumn("review", (m == "manual_review") | F.col("winner").isNull() | unsure)


def resolve(pages: DataFrame, edited: DataFrame, overrides: DataFrame, key: str, auto: str) -> DataFrame:
    """key, text, resolution: an edited text first, then an override, then the automatic choice."""
    j = pages.join(edited.select(F.col(key).alias("__e"), F.col("text").alias("__et")), F.col(key) == F.col("__e"), "left")
    j = j.join(overrides.select(F.col(key).alias("__o"), F.col("text").alias("__ot")), F.col(key) == F.col("__o"), "left")
    why = F.when(F.col("__et").isNotNull(), "edited").when(F.col("__ot").isNotNull(), "override").when(F.col(auto).isNotNull(), "auto").otherwise("unresolved")
    return j.select(key, F.coalesce("__et", "__ot", auto).alias("text"), why.alias("resolution"))


def summary(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("method").agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("winner") == "a").alias("a"), F.count_if(F.col("winner") == "b").alias("b"), F.count_if("review").alias("review"))


def costs(runs: DataFrame, pages: int, model: str = "model", cost: str = "cost", *measures: str) -> DataFrame:
    """model, runs, known, mean_cost, estimate for all pages, and means of further measures; nulls are unknown."""
    return runs.groupBy(model).agg(F.count(F.lit(1)).alias("runs"), F.count(cost).alias("known"), F.avg(cost).alias("mean_cost"), (F.avg(cost) * pages).alias("estimate"), *[F.avg(m).alias(f"mean_{m}") for m in measures])


def side_by_side(a: DataFrame, b: DataFrame, key: str, order: str, value: str, most: int | None = None) -> DataFrame:
    """key, n, a, b: the rows of two readings of a page next to each other by their place."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(order)
    x = a.select(key, F.row_number().over(w).alias("n"), F.col(value).alias("a"))
    y = b.select(key, F.row_number().over(w).alias("n"), F.col(value).alias("b"))
    out = x.join(y, [key, "n"], "full")
    return out.filter(F.col("n") <= most) if most else out


def with_responses(originals: DataFrame, responses: DataFrame, key: str, answer: str) -> DataFrame:
    """originals with the answer of each batch response of their id (the last of several), null where none came. A batch's
    responses come in any order, so they are joined by id, not by place."""
    last = responses.groupBy(F.col("custom_id").alias("__c")).agg(F.max_by(answer, "ord").alias(answer))
    return originals.join(last, F.col(key).cast("string") == F.col("__c"), "left").drop("__c")


def zipped(a: DataFrame, b: DataFrame, a_keys: list[Column], b_keys: list[Column]) -> DataFrame:
    """The rows of two tables next to each other by their place in order, as many as the shorter one has."""
    x, y = with_totals(a, a_keys, "__i"), with_totals(b, b_keys, "__j")
    return x.join(y, F.col("__i") == F.col("__j")).drop("__i", "__j")
