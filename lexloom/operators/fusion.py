"""Merging of dictionaries: sources by priority, upserts, overlays, nested forms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coalesce_by_priority(sources: list[DataFrame], key: str, value: str) -> DataFrame:
    """key, value, source (place in the list): the first source whose value isn't empty; keys with none keep an empty one."""
    tagged = [s.select(F.col(key), F.col(value), F.lit(i).alias("source")) for i, s in enumerate(sources)]
    empty = F.coalesce(F.col(value), F.lit("")) == ""
    both = reduce(DataFrame.unionByName, tagged)
    return both.groupBy(key).agg(F.min_by(F.struct(F.coalesce(value, F.lit("")).alias(value), "source"), F.struct(empty, F.col("source"), F.coalesce(value, F.lit("")))).alias("r")).select(key, "r.*")


def lookup_cascade(rows: DataFrame, key: str, tables: list[tuple[str, DataFrame]]) -> DataFrame:
    """rows with `value` and `rule` of the first table (name, (k, v)) that has the key; keys are unique in each table."""
    out, values, names = rows, [], []
    for i, (name, t) in enumerate(tables):
        out = out.join(t.select(F.col("k").alias(f"__k{i}"), F.col("v").alias(f"__v{i}")), F.col(key) == F.col(f"__k{i}"), "left")
        values.append(F.col(f"__v{i}"))
        names.append(F.when(F.col(f"__v{i}").isNotNull(), F.lit(name)))
    return out.select(*rows.columns, F.coalesce(*values).alias("value"), F.coalesce(*names).alias("rule"))


def upsert(old: DataFrame, new: DataFrame, key: str, lists: list[str] = (), values: list[str] = ()) -> DataFrame:
    """A full join on unique keys: lists are appended, values overwrite unless null or 0."""
    none = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    a, b = old.select(key, *[F.col(c).alias(f"__a_{c}") for c in (*lists, *values)]), new.select(key, *[F.col(c).alias(f"__b_{c}") for c in (*lists, *values)])
    j = a.join(b, key, "full")
    return j.select(key, *[F.concat(none(F.col(f"__a_{c}")), none(F.col(f"__b_{c}"))).alias(c) for c in lists], *[F.coalesce(F.nullif(F.col(f"__b_{c}"), F.lit(0)), F.col(f"__a_{c}")).alias(c) for c in values])


def last_wins(overlays: DataFrame, key: str, ord_: str) -> DataFrame:
    """One row for each key: that of the largest ord."""
    rest = [c for c in overlays.columns if c != key]
    return overlays.groupBy(key).agg(F.max_by(F.struct(*rest), ord_).alias("r")).select(key, "r.*")


def new_headwords(found: DataFrame, known: DataFrame, lemma: str, norm: Column) -> DataFrame:
    """Rows whose lemma is known neither as it is nor normalized; of several with one normalized form the first lemma."""
    fresh = found.withColumn("__n", norm).join(known.select(F.col(lemma).alias("__l")).distinct(), F.col(lemma) == F.col("__l"), "left_anti")
    fresh = fresh.join(known.select(norm.alias("__m")).distinct(), F.col("__n") == F.col("__m"), "left_anti")
    rest = [c for c in found.columns]
    return fresh.groupBy("__n").agg(F.min_by(F.struct(*rest), F.col(lemma)).alias("r")).select("r.*")


def fallback_lookup(rows: DataFrame, keys: Column, table: DataFrame, id_: str, value: str = "n") -> DataFrame:
    """id, value, key: the first of the keys (array, in order) with a value other than 0; 0 if none has."""
    tried = rows.select(id_, F.posexplode_outer(keys).alias("at", "key"))
    hit = tried.join(table.select(F.col("key").alias("k"), F.col(value).alias("v")).filter(F.col("v") != 0), F.col("key") == F.col("k"), "left")
    best = hit.groupBy(id_).agg(F.min_by(F.struct("v", "key"), F.struct(F.col("v").isNull(), F.col("at"))).alias("r"))
    return best.select(id_, F.coalesce("r.v", F.lit(0)).alias(value), F.when(F.col("r.v").isNotNull(), F.col("r.key")).alias("key"))


def nest_forms(terms: DataFrame, links: DataFrame, lemma: str = "lemma", n: str = "frequency") -> DataFrame:
    """terms with the rows that `links` (form, root, type, analysis) demotes nested in their root's `forms`, largest first,
    and `rolled`: own and nested counts. A link counts if both are terms, differ, and the form is not itself a root."""
    ok = links.filter("form <> root").join(terms.select(F.col(lemma).alias("form"), F.col(n).alias("fn")), "form").join(terms.select(F.col(lemma).alias("root")).distinct(), "root", "left_semi")
    ok = ok.join(links.select(F.col("root").alias("form")).distinct(), "form", "left_anti")
    nested = ok.groupBy("root").agg(F.sort_array(F.collect_list(F.struct((-F.col("fn")).alias("m"), F.col("form").alias("lemma"), "type"))).alias("fs"))
    nested = nested.select(F.col("root").alias("__r"), F.transform("fs", lambda f: F.struct(f["lemma"].alias("lemma"), (-f["m"]).alias("frequency"), f["type"].alias("type"))).alias("forms"))
    kept = terms.join(ok.select(F.col("form").alias("__f")).distinct(), F.col(lemma) == F.col("__f"), "left_anti")
    out = kept.join(nested, F.col(lemma) == F.col("__r"), "left").drop("__r")
    return out.withColumn("rolled", F.col(n) + F.coalesce(F.aggregate("forms", F.lit(0).cast("long"), lambda s, f: s + f["frequency"]), F.lit(0)))


def flatten_forms(terms: DataFrame, lemma: str = "lemma", n: str = "frequency") -> DataFrame:
    """The inverse: nested forms as rows of their own again; doing it twice changes nothing."""
    if "forms" not in terms.columns:
        return terms.drop("rolled")
    nested = terms.select(F.explode("forms").alias("f")).select(F.col("f.lemma").alias(lemma), F.col("f.frequency").alias(n))
    return terms.drop("forms", "rolled").unionByName(nested, allowMissingColumns=True)


def correspondences(terms: DataFrame, pairs: DataFrame, lemma: str = "lemma") -> DataFrame:
    """terms with `matches`: pairs (ord, target, other, type, conf, curated) that hit a term, each (target, other, type)
    once (the first), curated first, then by confidence and name."""
    hit = pairs.filter(F.coalesce("other", F.lit("")) != "").join(terms.select(F.col(lemma).alias("target")).distinct(), "target", "left_semi")
    once = hit.groupBy("target", "other", "type").agg(F.min_by(F.struct("curated", "conf"), "ord").alias("r"))
    item = F.struct((~F.col("r.curated")).alias("a"), (-F.coalesce("r.conf", F.lit(0.0))).alias("b"), F.col("other").alias("lemma"), "type", F.col("r.conf").alias("conf"), F.col("r.curated").alias("curated"))
    lists = once.groupBy(F.col("target").alias("__t")).agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: F.struct(x["lemma"].alias("lemma"), x["type"].alias("type"), x["conf"].alias("conf"), x["curated"].alias("curated"))).alias("matches"))
    return terms.join(lists, F.col(lemma) == F.col("__t"), "left").drop("__t")


def dedup_first(df: DataFrame, keys: list[str], ord_: str) -> DataFrame:
    """The first row of each key, by ord; null and empty arrays in keys are the same."""
    kinds = dict(df.dtypes)
    same = [F.coalesce(F.col(k), F.array().cast(kinds[k])).alias(f"__{i}") if kinds[k].startswith("array") else F.col(k).alias(f"__{i}") for i, k in enumerate(keys)]
    return df.select(*same, F.struct(*df.columns).alias("r")).groupBy(*[f"__{i}" for i in range(len(keys))]).agg(F.min_by("r", F.col(f"r.{ord_}")).alias("r")).select("r.*")


def compare_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, side: only_a, only_b or both."""
    x, y = a.select(F.col(key).alias("__a")).distinct(), b.select(F.col(key).alias("__b")).distinct()
    j = x.join(y, F.col("__a") == F.col("__b"), "full")
    return j.select(F.coalesce("__a", "__b").alias(key), F.when(F.col("__b").isNull(), "only_a").when(F.col("__a").isNull(), "only_b").otherwise("both").alias("side"))


def derived_cognates(words: DataFrame, derived: Column, known: DataFrame, lemma: str = "lemma") -> DataFrame:
    """form, sources: derived forms that aren't words already, with the lemmas they come from."""
    new = words.withColumn("form", derived).join(known.select(F.col(lemma).alias("__l")).distinct(), F.col("form") == F.col("__l"), "left_anti")
    return new.groupBy("form").agg(F.array_sort(F.collect_set(lemma)).alias("sources"))


def override(rows: DataFrame, changes: DataFrame, keys: list[str], value: str) -> DataFrame:
    """rows with `value` replaced where a change has equal keys (arrays compare as a whole)."""
    c = changes.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(value).alias("__new"))
    on = None
    for k in keys:
        on = F.col(k).eqNullSafe(F.col(f"__{k}")) if on is None else on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(c, on, "left").withColumn(value, F.coalesce("__new", value)).select(*rows.columns)


def variants_of_origin(rows: DataFrame, id_: str, origin: str) -> DataFrame:
    """id, origin, representative (the smallest id of the origin) and others (how many further rows the origin has): the
    variants of an origin as a class. Pairs are made by variant_pairs, from these, for origins of a size that is asked for."""
    first = rows.groupBy(F.col(origin).alias("__o")).agg(F.min(id_).alias("representative"), (F.count(F.lit(1)) - 1).alias("others"))
    return rows.join(first, F.col(origin) == F.col("__o")).filter("others > 0").select(id_, origin, "representative", "others")


def variant_pairs(rows: DataFrame, id_: str, origin: str) -> DataFrame:
    """a, b, origin: each row with each later one of its origin. The later ones of an origin are one sorted list a row
    takes a tail of, so the join is on origins, not on pairs; the result itself has all pairs. For large origins use
    variants_of_origin."""
    lists = rows.groupBy(F.col(origin).alias("__o")).agg(F.sort_array(F.collect_list(id_)).alias("ids")).filter(F.size("ids") > 1)
    tails = lists.select("__o", F.posexplode("ids").alias("at", "a"), "ids").select("__o", "a", F.slice("ids", F.col("at") + 2, F.size("ids")).alias("rest"))
    return tails.select("a", F.explode("rest").alias("b"), F.col("__o").alias(origin)).filter("a < b")
