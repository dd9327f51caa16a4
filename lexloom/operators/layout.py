"""Entries from line streams and pages: islands, fill-down, spans, nearest and as-of lookups, clusters of lines."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType


def lines_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, n, line of each text."""
    return df.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), r"\r?\n")).alias("n", "line"))


def islands(lines: DataFrame, key: str, n: str, is_head: Column, line: str = "line") -> DataFrame:
    """key, entry, head, body: a head line and the lines up to the next one; lines before the first head go."""
    w = Window.partitionBy(key).orderBy(n)
    part = lines.withColumn("entry", F.sum(F.when(is_head, 1).otherwise(0)).over(w)).filter("entry > 0")
    got = part.groupBy(key, "entry").agg(F.sort_array(F.collect_list(F.struct(n, line))).alias("ls"))
    return got.select(key, "entry", F.col("ls")[0][line].alias("head"), F.array_join(F.transform(F.slice("ls", 2, F.size("ls")), lambda x: x[line]), " ").alias("body"))


def fill_down(df: DataFrame, key: str, order: str, value: Column, name: str) -> DataFrame:
    return df.withColumn(name, F.last(value, ignorenulls=True).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def inherited_entries(lines: DataFrame, key: str, n: str, line: str = "line") -> DataFrame:
    """key, id, lemma, sub_index, body of numbered dictionary lines `12. Lemma. body`: a numbered line that begins with a
    dash takes the last lemma; a dash line without a number ends the entry, has id '' and counts on; others continue."""
    number, dash = r"^\s*(\d+)[.)]\s*(.*)$", r"^\s*[—-]"
    rest = F.regexp_extract(line, number, 2)
    sub = F.when(F.col(line).rlike(number), rest.rlike(dash)).otherwise(F.col(line).rlike(dash))
    numbered = F.col(line).rlike(number)
    w = Window.partitionBy(key).orderBy(n)
    lemma = F.when(numbered & ~sub, F.trim(F.when(rest.contains("."), F.substring_index(rest, ".", 1)).otherwise(rest)))
    body = F.when(numbered & ~sub, F.when(rest.contains("."), F.trim(F.regexp_extract(rest, r"^[^.]*\.(.*)$", 1))).otherwise(F.lit(""))).when(numbered, F.trim(F.regexp_replace(rest, "^[—\\- ]+", ""))).otherwise(F.trim(line))
    rows = lines.filter(F.trim(line) != "").withColumn("__lemma", F.last(lemma, True).over(w))
    start = numbered | (sub & F.col("__lemma").isNotNull())
    rows = rows.withColumn("__start", start).withColumn("__body", body).withColumn("__num", F.when(numbered, F.regexp_extract(line, number, 1)))
    rows = rows.withColumn("entry", F.sum(F.when(F.col("__start"), 1).otherwise(0)).over(w)).withColumn("block", F.sum(F.when(F.col("__num").isNotNull(), 1).otherwise(0)).over(w)).filter("entry > 0")
    rows = rows.withColumn("sub_index", F.sum(F.when(F.col("__start") & sub, 1).otherwise(0)).over(Window.partitionBy(key, "block").orderBy(n)))
    got = rows.groupBy(key, "entry").agg(F.sort_array(F.collect_list(F.struct(n, F.coalesce("__num", F.lit("")).alias("id"), "__lemma", "sub_index", "__body"))).alias("ls"))
    first = F.col("ls")[0]
    return got.select(key, "entry", first["id"].alias("id"), first["__lemma"].alias("lemma"), first["sub_index"].alias("sub_index"), F.trim(F.regexp_replace(F.array_join(F.transform("ls", lambda x: x["__body"]), " "), r"\s+", " ")).alias("body"))


def merge_until(paragraphs: DataFrame, key: str, n: str, text: str, looks_new: Column, complete: str) -> DataFrame:
    """key, entry, text: paragraphs joined until one holds the closing pattern and the next looks like a beginning. A new
    entry begins at a beginning behind a closing pattern somewhere since the last entry: the fold is over each key's
    paragraphs in order."""
    got = paragraphs.withColumn("__new", looks_new).groupBy(key).agg(F.sort_array(F.collect_list(F.struct(n, text, "__new"))).alias("ps"))
    fold = F.aggregate(
        "ps",
        F.struct(F.array().cast("array<string>").alias("out"), F.lit(None).cast("string").alias("buf")),
        lambda s, p: F.when(s["buf"].isNull(), F.struct(s["out"].alias("out"), p[text].alias("buf")))
        .when(p["__new"] & s["buf"].rlike(complete), F.struct(F.concat(s["out"], F.array(s["buf"])).alias("out"), p[text].alias("buf")))
        .otherwise(F.struct(s["out"].alias("out"), F.concat_ws("\n", s["buf"], p[text]).alias("buf"))),
        lambda s: F.when(s["buf"].isNull(), s["out"]).otherwise(F.concat(s["out"], F.array(s["buf"]))),
    )
    return got.select(key, F.posexplode(fold).alias("entry", "text"))


def spans(df: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    """key, nth, match, span: each match of a pattern and what lies between it and the next."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    return df.select(key, F.posexplode(F.transform(found, lambda m, i: F.struct(m.alias("match"), F.get(pieces, i + 1).alias("span")))).alias("nth", "s")).select(key, "nth", "s.match", "s.span")


def as_of(left: DataFrame, right: DataFrame, on: str, left_at: str, right_at: str, value: str) -> DataFrame:
    """left with `value` of the last right row at or before its place, within a key: one sort of both sides together,
    instead of a join of all earlier rows. Of right rows at one place the largest value counts."""
    a = left.select(F.col(on).alias("__k"), F.col(left_at).alias("__at"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"), F.lit(None).cast(right.schema[value].dataType).alias("__v"))
    b = right.groupBy(F.col(on).alias("__k"), F.col(right_at).alias("__at")).agg(F.max(value).alias("__v")).select("__k", "__at", F.lit(0).alias("__side"), F.lit(None).cast(a.schema["__row"].dataType).alias("__row"), "__v")
    w = Window.partitionBy("__k").orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, 0)
    return a.unionByName(b).withColumn("__v", F.last("__v", True).over(w)).filter("__side = 1").select("__row.*", F.col("__v").alias(value))


def nearest(left: DataFrame, right: DataFrame, on: str, id_: str, left_y: str, right_y: str, value: str, width: float | None = None) -> DataFrame:
    """id, value, distance: the right row of the same key that is nearest in y (ties: least value), of those within
    `width` if it is given. Both sides are sorted together once; the nearest row at or above and the nearest at or below
    are carried to each left row, so no pairs are made. Left rows without a right one are left out."""
    a = left.select(F.col(on).alias("__k"), F.col(left_y).cast("double").alias("__y"), F.col(id_).alias("__id"), F.lit(None).cast(right.schema[value].dataType).alias("__v"))
    b = right.filter(F.col(right_y).isNotNull()).groupBy(F.col(on).alias("__k"), F.col(right_y).cast("double").alias("__y")).agg(F.min(value).alias("__v"))
    both = a.unionByName(b.select("__k", "__y", F.lit(None).cast(left.schema[id_].dataType).alias("__id"), "__v"))
    seen = F.when(F.col("__id").isNull(), F.struct("__y", "__v"))
    # right rows come first among equals on the way down, and last on the way up, so both see rows at the same place
    down = Window.partitionBy("__k").orderBy("__y", F.col("__id").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("__k").orderBy("__y", F.col("__id").isNotNull()).rowsBetween(0, Window.unboundedFollowing)
    rows = both.withColumn("__a", F.last(seen, True).over(down)).withColumn("__b", F.first(seen, True).over(up)).filter(F.col("__id").isNotNull())
    told = lambda s: F.when(F.col(s).isNotNull(), F.struct(F.abs(F.col("__y") - F.col(f"{s}.__y")).alias("distance"), F.col(f"{s}.__v").alias("v")))
    out = rows.withColumn("m", F.least(told("__a"), told("__b"))).filter("m is not null")
    out = out.filter(F.col("m.distance") <= width) if width is not None else out
    return out.select(F.col("__id").alias(id_), F.col("m.v").alias(value), F.col("m.distance").alias("distance"))


def cluster_lines(words: DataFrame, keys: list[str], y: str, x: str, text: str, tolerance: float, moving: bool = False) -> DataFrame:
    """keys, line, y, text: words whose y is within the tolerance of a line's anchor, from the top; the anchor is the
    first y, or moves to the largest one. Which line a word is in depends on its y alone, so the pass over a page in order
    is over its distinct heights; words go to their lines by a join. A page that has a word without y is one line from
    there on, unless the anchor moves."""
    places = ArrayType(StructType([StructField(c, IntegerType()) for c in ("line", "first", "nth")]))

    @F.pandas_udf(places)
    def lines(pages: pd.Series, empty: pd.Series) -> pd.Series:
        def page(ys, lacks):  # places are told by number (-1: none), as pandas can't tell NaN and null
            line, first = (0, -1) if lacks else (-1, -1)
            out, firsts = [(0, -1)] if lacks else [], {0: -1}
            for n, at in enumerate(ys):
                anchor = ys[first] if first >= 0 else None
                # NaN is larger than all else
                if line < 0 or (anchor is not None and (at - anchor > tolerance or (at != at and anchor == anchor))):
                    line, first = line + 1, n
                elif moving:
                    first = n
                firsts[line] = first
                out.append((line, n))
            return [{"line": k, "first": firsts[k], "nth": n} for k, n in out]

        return pd.Series([page(ys, lacks) for ys, lacks in zip(pages, empty)])

    w = words.select(*keys, F.col(y).cast("double").alias("__y"), F.struct(F.col(x).cast("double").alias("x"), F.col(text).alias("t")).alias("__w"))
    pages = w.groupBy(*keys, "__y").agg(F.lit(0)).groupBy(*keys).agg(F.sort_array(F.collect_list("__y")).alias("__ys"), F.max(F.col("__y").isNull()).alias("__null"))
    names = [f"__k{i}" for i in range(len(keys))]
    told = pages.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "__ys", F.explode(lines("__ys", "__null")).alias("l"))
    told = told.select(*names, "l.line", F.get("__ys", F.col("l.first")).alias("anchor"), F.get("__ys", F.col("l.nth")).alias("at"))
    same = F.col("__y").eqNullSafe(F.col("at"))
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    found = w.join(told, same).groupBy(*keys, "line", F.col("anchor").alias("y")).agg(F.sort_array(F.collect_list("__w")).alias("ws"))
    return found.select(*keys, "line", "y", F.array_join(F.transform("ws", lambda v: v["t"]), " ").alias("text"))


def line_words(words: DataFrame, keys: list[str], y: str, columns: list[str], tolerance: float) -> DataFrame:
    """keys, line, words (array of the columns' structs, by the first of them): words whose y is within the tolerance of
    the line's first y. A line's anchor depends on the words before, so it is a fold over each page's words in order."""
    item = F.struct(F.col(y).cast("double").alias("y"), *columns)
    got = words.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("ws"))
    anchors = F.aggregate("ws", F.array().cast("array<double>"), lambda s, w: F.concat(s, F.array(F.when((F.size(s) == 0) | (w["y"] - F.element_at(s, -1) > tolerance), w["y"]).otherwise(F.element_at(s, -1)))))
    rows = got.select(*keys, F.explode(F.arrays_zip(anchors.alias("a"), F.col("ws").alias("w"))).alias("z")).select(*keys, F.col("z.a").alias("__a"), *[F.col(f"z.w.{c}").alias(c) for c in columns])
    lines = rows.groupBy(*keys, "__a").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("words"))
    return lines.withColumn("line", F.row_number().over(Window.partitionBy(*keys).orderBy("__a")) - 1).drop("__a")


def column_of(x: Column, borders: list[float]) -> Column:
    """The column (from 0) that a place lies in."""
    out = F.lit(0)
    for b in borders:
        out = out + F.when(x >= b, 1).otherwise(0)
    return out


def pending_pairs(lines: DataFrame, key: str, n: str, line: str, closing: str) -> DataFrame:
    """key, first, second: the last line before each line with a closing pattern and what the pattern's group holds; a
    line is used once."""
    w = Window.partitionBy(key).orderBy(n)
    rows = lines.filter(F.trim(line) != "").withColumn("__close", F.col(line).rlike(closing)).withColumn("__prev", F.lag(line).over(w)).withColumn("__was", F.coalesce(F.lag("__close").over(w), F.lit(True)))
    hit = rows.filter("__close").withColumn("__own", F.trim(F.regexp_replace(line, closing, "")))
    first = F.when(F.col("__own") != "", F.col("__own")).when(~F.col("__was"), F.col("__prev"))
    return hit.select(key, n, first.alias("first"), F.regexp_extract(line, closing, 1).alias("second")).filter(F.col("first").isNotNull())


def page_ranges(contents: DataFrame, volume: str, ord_: str, page: str, last: str) -> DataFrame:
    """contents with end: the next entry's page, or the volume's last one."""
    return contents.withColumn("end", F.coalesce(F.lead(page).over(Window.partitionBy(volume).orderBy(ord_)), F.col(last)))


def range_lookup(rows: DataFrame, at: str, ranges: list[tuple[int, int, str]], name: str) -> DataFrame:
    """rows with the name of the first range (low, high, name) that holds `at`; a literal table of ranges."""
    out = F.lit(None).cast("string")
    for low, high, what in reversed(ranges):
        out = F.when(F.col(at).between(low, high), what).otherwise(out)
    return rows.withColumn(name, out)


def split_at_last_rule(lines: DataFrame, page: str, n: str, line: str, rule: str = r"^[-─━_]{3,}$") -> DataFrame:
    """page, body, notes: the lines of a page before and after its last rule; without a rule all are body."""
    at = F.max(F.when(F.col(line).rlike(rule), F.col(n))).over(Window.partitionBy(page))
    marked = lines.withColumn("__at", at).filter(~F.col(line).rlike(rule))
    is_note = F.col("__at").isNotNull() & (F.col(n) > F.col("__at"))
    part = lambda cond: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(cond, F.struct(n, line)))), lambda x: x[line]), "\n")
    return marked.groupBy(page).agg(part(~is_note).alias("body"), part(is_note).alias("notes"))


def tagged_turns(lines: DataFrame, key: str, n: str, line: str, number: str = r"^(\d+)\.\s*(.*)$", tag: str = r"^【(.+?)】\s*(.*)$") -> DataFrame:
    """key, num, parts (map tag -> text, '' for the numbered line itself): numbered turns with tagged lines below them;
    lines without a tag continue the last one."""
    w = Window.partitionBy(key).orderBy(n)
    rows = lines.withColumn("num", F.last(F.when(F.col(line).rlike(number), F.regexp_extract(line, number, 1).cast("int")), True).over(w)).filter("num is not null")
    own = F.when(F.col(line).rlike(number), F.lit("")).when(F.col(line).rlike(tag), F.regexp_extract(line, tag, 1))
    rows = rows.withColumn("tag", F.last(own, True).over(w))
    said = F.when(F.col(line).rlike(number), F.regexp_extract(line, number, 2)).when(F.col(line).rlike(tag), F.regexp_extract(line, tag, 2)).otherwise(F.trim(line))
    each = rows.groupBy(key, "num", "tag").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(n, said.alias("t")))), lambda x: x["t"]), " ").alias("text"))
    return each.groupBy(key, "num").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("tag", "text")))).alias("parts"))


def page_block(text: Column, page: int) -> Column:
    """The block behind `<!-- page N -->` up to the next such mark."""
    return F.regexp_replace(F.regexp_extract(text, rf"(?s)<!-- page {page} -->(.*?)(?=<!-- page \d+ -->|\z)", 1), r"^\s+|\s+\z", "")


def entry_on_page(entries: DataFrame, pages: DataFrame, page: str, lemma: str, text: str) -> DataFrame:
    """entries with `at`: where `lemma,` begins a line of its page (0 if it doesn't)."""
    j = entries.join(pages.select(F.col(page).alias("__p"), F.col(text).alias("__t")), F.col(page) == F.col("__p"), "left")
    return j.withColumn("at", F.coalesce(F.position(F.concat(F.lit("\n"), F.col(lemma), F.lit(",")), F.concat(F.lit("\n"), F.col("__t"))), F.lit(0))).drop("__p", "__t")
