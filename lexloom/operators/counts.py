"""Frequencies of forms, by group and cohort, and what is drawn from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.binding import let
from lexloom.functions.tokens import bare, cut_token, is_word, normalize, raw_tokens, tokenize
from lexloom.operators.ranking import with_totals


def bucket_of(value: Column, rules: list[tuple[str, str]], other: str = "other") -> Column:
    """The name of the first rule (substring, name) that a string, or any string of an array, holds."""
    def holds(sub: str) -> Column:
        return F.exists(value, lambda x: F.coalesce(x.contains(sub), F.lit(False)))

    out = None
    for sub, name in rules:
        hit = holds(sub)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.coalesce(out, F.lit(other)) if out is not None else F.lit(other)


def string_or_list(raw: Column) -> Column:
    """array<string> of a field that holds a JSON list, a plain string or nothing."""
    none = F.array().cast("array<string>")
    return F.when(raw.isNull(), none).when(raw.startswith("["), F.coalesce(F.from_json(raw, "array<string>"), none)).otherwise(F.array(raw))


def token_rows(df: DataFrame, text: str, *carry: str, compat: bool = False) -> DataFrame:
    """carry, pos, token: one row for each token of each text."""
    return df.select(*carry, F.posexplode(tokenize(F.col(text), compat)).alias("pos", "token"))


def forms(tokens: DataFrame, *carry: str) -> DataFrame:
    """carry, form: the normalized words of a token table."""
    return tokens.filter(is_word(F.col("token"))).select(*carry, normalize(F.col("token")).alias("form")).filter(F.col("form") != "")


def form_counts(df: DataFrame, text: str, *groups: str, compat: bool = False) -> DataFrame:
    """groups, form, n: normalized words and their counts. How a raw token is cut depends on it alone, so raw tokens are
    counted first and each distinct one is cut and normalized once: the costly expressions see types, not tokens."""
    raw = df.select(*groups, F.explode(raw_tokens(F.coalesce(F.col(text), F.lit("")), compat)).alias("raw")).groupBy(*groups, "raw").agg(F.count(F.lit(1)).alias("n"))
    cut = raw.select(*groups, "n", F.explode(cut_token(F.col("raw"), compat)).alias("token"))
    told = cut.filter(is_word(F.col("token"))).select(*groups, normalize(F.col("token")).alias("form"), "n").filter(F.col("form") != "")
    return told.groupBy(*groups, "form").agg(F.sum("n").alias("n"))


def frequency_by(counted: DataFrame, group: str, names: list[str] | None = None) -> DataFrame:
    """form, frequency, breakdown of a table of counts (form, group, n): counts by group packed as name:n|name:n in the
    order of `names` (else sorted), zeros left out."""
    long = counted.groupBy("form", group).agg(F.sum("n").alias("n"))
    part = F.struct(*([F.array_position(F.array(*map(F.lit, names)), F.col(group)).alias("at")] if names else []), F.col(group).alias("g"), F.col("n").alias("n"))
    packed = F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: F.concat_ws(":", p["g"], p["n"])), "|")
    return long.groupBy("form").agg(F.sum("n").alias("frequency"), packed.alias("breakdown"))


def bare_rollup(frequencies: DataFrame) -> DataFrame:
    """form, frequency of forms without affix markers, from a table of counts, not from the texts again."""
    return frequencies.select(bare(F.col("form")).alias("form"), "frequency").filter("form <> ''").groupBy("form").agg(F.sum("frequency").alias("frequency"))


def parse_breakdown(packed: Column) -> Column:
    """map<string,string> of name:n|name:n."""
    return F.str_to_map(packed, F.lit(r"\|"), F.lit(":"))


def cohort_counts(counted: DataFrame, cohorts: dict[str, Column]) -> DataFrame:
    """form and, for each cohort, the counts of the rows that its condition holds for; one pass over (form, ..., n)."""
    return counted.groupBy("form").agg(*[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(name) for name, c in cohorts.items()])


def wide_counts(long: DataFrame, row: str, column: str, values: list[str], n: str = "n", least_total: int = 0) -> DataFrame:
    """One column for each value, missing counts 0; rows with a total under `least_total` left out."""
    out = long.groupBy(row).pivot(column, values).agg(F.sum(n)).na.fill(0, values)
    return out.filter(sum((F.col(f"`{v}`") for v in values), F.lit(0)) >= least_total) if least_total else out


def ngrams(df: DataFrame, tokens: Column, n: int, *carry: str) -> DataFrame:
    """carry, gram: all runs of n tokens within a row, joined by a space."""
    runs = let(tokens, lambda t: F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(1), F.size(t) - n + 1), lambda i: F.array_join(F.slice(t, i, n), " "))).otherwise(F.array().cast("array<string>")))
    return df.select(*carry, F.explode(runs).alias("gram"))


def ngrams_across(df: DataFrame, keys: list[str], tokens: Column, n: int) -> DataFrame:
    """gram: runs of n tokens of the stream of all rows in order of keys, over row borders too. Rows without tokens are
    dropped first. The rows are numbered in order, by ranges of the keys; the last n - 1 tokens of a row go to the n - 1
    rows after it, which takes one join on numbers: no task sorts or holds the stream."""
    rows = with_totals(df.select(*keys, tokens.alias("t")).filter(F.size("t") > 0), [F.col(k) for k in keys], "at").select("at", "t")
    tails = rows.select(F.explode(F.sequence(F.col("at") + 1, F.col("at") + (n - 1))).alias("to"), "at", F.slice("t", F.greatest(F.size("t") - (n - 2), F.lit(1)), n - 1).alias("tail"))
    held = tails.groupBy("to").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "tail"))), lambda x: x["tail"])).alias("b"))
    before = F.coalesce("b", F.array().cast("array<string>"))
    joined = rows.join(held, F.col("at") == F.col("to"), "left").select(F.concat(F.slice(before, F.greatest(F.size(before) - (n - 2), F.lit(1)), n - 1), "t").alias("all"))
    return ngrams(joined, F.col("all"), n)


def ranked(counts: DataFrame, n: str, tie: str, by: str | None = None) -> DataFrame:
    """counts with rank (from 1, largest first, ties by `tie`), cumulative, share and the Zipf expectation; within one
    group at a time where `by` is given, else by ranges over the whole table."""
    if by:
        w = Window.partitionBy(by)
        order = w.orderBy(F.desc(n), tie)
        upto = order.rowsBetween(Window.unboundedPreceding, 0)
        return counts.withColumn("rank", F.row_number().over(order)).withColumn("cumulative", F.sum(n).over(upto)).withColumn("share", F.col("cumulative") / F.sum(n).over(w)).withColumn("expected", F.first(n).over(order) / F.col("rank"))
    whole = counts.agg(F.sum(n).alias("__all"), F.max(n).alias("__most"))
    out = with_totals(counts, [-F.col(n), F.col(tie)], "rank", {"cumulative": n}).crossJoin(F.broadcast(whole))  # one row
    return out.withColumn("share", F.col("cumulative") / F.col("__all")).withColumn("expected", F.col("__most") / F.col("rank")).drop("__all", "__most")


def coverage(counts: DataFrame, covered: Column, n: str = "n") -> DataFrame:
    """types, tokens, covered_types, covered_tokens, and their shares in percent."""
    c = F.coalesce(covered, F.lit(False))
    out = counts.agg(F.count(F.lit(1)).alias("types"), F.sum(n).alias("tokens"), F.count_if(c).alias("covered_types"), F.sum(F.when(c, F.col(n)).otherwise(0)).alias("covered_tokens"))
    return out.withColumn("type_percent", 100.0 * F.col("covered_types") / F.col("types")).withColumn("token_percent", 100.0 * F.col("covered_tokens") / F.col("tokens"))


def coverage_by_threshold(counts: DataFrame, covered: Column, most: int = 20, n: str = "n") -> DataFrame:
    """threshold 1 .. most: coverage over types of at least that count. Counts beyond `most` fall together first."""
    c = F.coalesce(covered, F.lit(False))
    small = counts.groupBy(F.least(F.col(n), F.lit(most)).alias("k")).agg(F.count(F.lit(1)).alias("types"), F.sum(n).alias("tokens"), F.count_if(c).alias("ct"), F.sum(F.when(c, F.col(n)).otherwise(0)).alias("cn"))
    spread = small.select(F.explode(F.sequence(F.lit(1), F.col("k").cast("int"))).alias("threshold"), "types", "tokens", "ct", "cn")
    out = spread.groupBy("threshold").agg(*[F.sum(x).alias(x) for x in ("types", "tokens", "ct", "cn")])
    return out.select("threshold", "types", "tokens", (100.0 * F.col("ct") / F.col("types")).alias("type_percent"), (100.0 * F.col("cn") / F.col("tokens")).alias("token_percent"))


def letter_presence(counts: DataFrame, letters: str, form: str = "form", n: str = "n") -> DataFrame:
    """letter, total: the counts of the forms that hold a letter, however often."""
    held = F.array_intersect(F.split(F.col(form), ""), F.array(*map(F.lit, letters)))
    return counts.select(F.explode(held).alias("letter"), n).groupBy("letter").agg(F.sum(n).alias("total"))


def most_common_value(df: DataFrame, key: str, value: str, ord_: str) -> DataFrame:
    """key, value: the most frequent value, of equal ones the first to appear; empty values don't count ('' if none)."""
    c = df.filter(F.coalesce(F.col(value), F.lit("")) != "").groupBy(key, value).agg(F.count(F.lit(1)).alias("n"), F.min(ord_).alias("o"))
    best = c.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), F.col("o"))).alias(value))
    return df.select(key).distinct().join(best, key, "left").select(key, F.coalesce(value, F.lit("")).alias(value))


def packed_counts(df: DataFrame, key: str, value: str, ord_: str, name: str) -> DataFrame:
    """key, name: `v (n) || v2 (n2)`, largest first, ties by first appearance."""
    c = df.filter(F.coalesce(F.col(value), F.lit("")) != "").groupBy(key, value).agg(F.count(F.lit(1)).alias("n"), F.min(ord_).alias("o"))
    part = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "o", F.col(value).alias("v"))))
    return c.groupBy(key).agg(F.array_join(F.transform(part, lambda p: F.format_string("%s (%d)", p["v"], -p["m"])), " || ").alias(name))
