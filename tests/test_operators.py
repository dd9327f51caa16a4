"""Operators on small tables, oddities and empty input."""

import glob
import itertools
import os
import time

from pyspark.sql import functions as F

from lexloom.operators import analytics, counts, decisions, fusion, layout, lexicon, linkage
from lexloom.sources import readers, sinks
from lexloom.streaming import incremental


def test_frequency_breakdown_order_and_zeros(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 1), ("a", "x", 1), ("b", "y", 1)], "form string, g string, n long")
    got = {r["form"]: (r["frequency"], r["breakdown"]) for r in counts.frequency_by(df, "g", ["y", "x"]).collect()}
    assert got == {"a": (3, "y:1|x:2"), "b": (1, "y:1")}
    assert spark.range(1).select(counts.parse_breakdown(F.lit("y:1|x:2"))).first()[0] == {"y": "1", "x": "2"}
    assert counts.frequency_by(df.limit(0), "g").count() == 0


def test_form_counts_agree_with_tokens(spark):
    df = spark.createDataFrame([("A", "k=eyaypakasnu an! an =an ‘itak’"), ("B", None), ("B", "an")], "g string, t string")
    slow = counts.forms(counts.token_rows(df, "t", "g"), "g").groupBy("g", "form").count()
    assert {tuple(r) for r in counts.form_counts(df, "t", "g").collect()} == {tuple(r) for r in slow.collect()}


def test_string_or_list_buckets(spark):
    df = spark.createDataFrame([('["北海道", "樺太"]',), ("北海道",), (None,), ("x",)], "raw string")
    c = counts.bucket_of(counts.string_or_list(F.col("raw")), [("樺太", "sakhalin"), ("北海道", "hokkaido")])
    assert [r[0] for r in df.select(c).collect()] == ["sakhalin", "hokkaido", "other", "other"]


def test_ngrams_across_rows(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, ["c"]), (4, ["d", "e"])], "k long, t array<string>")
    got = sorted(r[0] for r in counts.ngrams_across(df, ["k"], F.col("t"), 3).collect())
    assert got == ["a b c", "b c d", "c d e"]


def test_most_common_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([("m", "x", 2), ("m", "y", 1), ("m", "", 0), ("n", "", 3)], "k string, v string, o int")
    assert {tuple(r) for r in counts.most_common_value(df, "k", "v", "o").collect()} == {("m", "y"), ("n", "")}


def test_alignment(spark):
    rows = [(1, "a-b||c", "X-Y||Z", "j||k"), (2, "a-b", "X", "j"), (3, "a||b", "X", ""), (4, "***||a(?)", "||q", "")]
    df = spark.createDataFrame(rows, "id int, morpheme string, gloss_en string, gloss_jp string")
    good, bad = lexicon.align(df, "morpheme", "gloss_en", "gloss_jp", "id")
    assert sorted((r["id"], r["morpheme"], r["gloss_en"], r["gloss_jp"], r["note"]) for r in good.collect()) == [(1, "a", "X", "j", ""), (1, "b", "Y", "j", ""), (1, "c", "Z", "k", ""), (4, "a", "q", "", "uncertain_form_marker_removed")]
    assert sorted((r["id"], r["reason"]) for r in bad.collect()) == [(2, "part_count_mismatch"), (3, "unit_count_mismatch")]


def test_nesting_and_flattening(spark):
    terms = spark.createDataFrame([("ki", 10), ("kihci", 3), ("kipa", 5)], "lemma string, frequency long")
    links = spark.createDataFrame([("kihci", "ki", "v"), ("kipa", "ki", "v"), ("x", "ki", "v")], "form string, root string, type string")
    nested = fusion.nest_forms(terms, links)
    r = nested.collect()
    assert len(r) == 1 and r[0]["rolled"] == 18 and [f["lemma"] for f in r[0]["forms"]] == ["kipa", "kihci"]
    assert {tuple(x) for x in fusion.flatten_forms(nested).collect()} == {tuple(x) for x in terms.collect()}


def test_linkage_cascade(spark):
    q = spark.createDataFrame([(1, "kamui", "god bear"), (2, "kotanx", "village place"), (3, "zzzzzz", "water drink cold"), (4, "qqq", "none such")], "id long, lemma string, gloss string")
    e = spark.createDataFrame([(10, "s", 0.85, 0, "kamuy", "god"), (11, "s", 0.85, 1, "kotan", "village"), (12, "s", 0.85, 2, "wakka", "cold water drink")], "entry long, source string, base_conf double, ord long, lemma string, definition string")
    got = {r["id"]: (r["entry"], r["kind"]) for r in linkage.cascade(q, e).collect()}
    assert got == {1: (10, "latn"), 2: (11, "fuzzy_edit1"), 3: (12, "reverse_gloss"), 4: (None, None)}
    manual = spark.createDataFrame([("qqq ", 12)], "lemma string, entry long")
    assert {r["id"]: r["kind"] for r in linkage.cascade(q, e, manual).collect()}[4] == "manual"


def test_islands_and_inheritance(spark):
    lines = spark.createDataFrame([("p", 0, "pre"), ("p", 1, "1. Abe. fire"), ("p", 2, "hot"), ("p", 3, "— sub one"), ("p", 4, "2. — with number"), ("p", 5, "3. Kotan. village")], "k string, n int, line string")
    got = [(r["head"], r["body"]) for r in layout.islands(lines, "k", "n", F.col("line").rlike(r"^\d")).orderBy("entry").collect()]
    assert got[0] == ("1. Abe. fire", "hot — sub one")
    sub = [(r["id"], r["lemma"], r["sub_index"]) for r in layout.inherited_entries(lines, "k", "n").orderBy("entry").collect()]
    assert sub == [("1", "Abe", 0), ("", "Abe", 1), ("2", "Abe", 1), ("3", "Kotan", 0)]


def test_clusters_keep_their_anchor(spark):
    w = spark.createDataFrame([(1, 0.0, 2.0, "b"), (1, 3.0, 1.0, "a"), (1, 5.0, 0.0, "c")], "page int, y double, x double, t string")
    fixed = [r["text"] for r in layout.cluster_lines(w, ["page"], "y", "x", "t", 3.0).orderBy("line").collect()]
    moving = [r["text"] for r in layout.cluster_lines(w, ["page"], "y", "x", "t", 3.0, moving=True).orderBy("line").collect()]
    assert fixed == ["a b", "c"] and moving == ["c a b"]


def test_as_of_and_nearest(spark):
    a = spark.createDataFrame([(1, "k", 5), (2, "k", 1), (3, "z", 9)], "id int, k string, t int")
    b = spark.createDataFrame([("k", 2, "p"), ("k", 5, "q")], "k string, t int, v string")
    assert {r["id"]: r["v"] for r in layout.as_of(a, b, "k", "t", "t", "v").collect()} == {1: "q", 2: None, 3: None}
    near = layout.nearest(a, b, "k", "id", "t", "t", "v", width=2.0)
    assert {r["id"]: r["v"] for r in near.collect()} == {1: "q", 2: "p"}


def test_decisions(spark):
    d = spark.createDataFrame([(1, "a", "a"), (2, "a b", "a  b "), (3, "イタク", "イタㇰ"), (4, "x", "y")], "p int, a string, b string")
    got = {r["p"]: (r["method"], r["winner"], r["confidence"], r["review"]) for r in decisions.decide(d, "a", "b").collect()}
    assert got == {1: ("exact_match", "a", 1.0, False), 2: ("normalized_match", "a", 0.98, False), 3: ("small_kana_heuristic", "b", 0.85, False), 4: ("manual_review", None, None, True)}


def test_scaling_keeps_distances(spark):
    d = spark.createDataFrame([("a", "b", 3.0), ("a", "c", 4.0), ("b", "c", 5.0)], "a string, b string, distance double")
    at = analytics.classical_scaling(d)
    dist = lambda x, y: sum((p - q) ** 2 for p, q in zip(at[x], at[y], strict=True)) ** 0.5
    assert abs(dist("a", "b") - 3) < 1e-6 and abs(dist("b", "c") - 5) < 1e-6
    assert analytics.average_linkage(d)[0] == ("a", "b", 3.0)


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"data": [{"text": "x", "morpheme": "m"}, {"text": "y"}]}')
    rows = readers.json_data_list(spark, str(tmp_path / "a.json")).collect()
    assert [(r["story_id"], r["ord"], r["text"]) for r in rows] == [("a", 0, "x"), ("a", 1, "y")]
    (tmp_path / "m.json").write_text('{"b": "1", "a": "2"}')
    assert [(r["ord"], r["key"]) for r in readers.json_map(spark, str(tmp_path / "m.json")).collect()] == [(0, "b"), (1, "a")]
    (tmp_path / "l.jsonl").write_text('{"text": "x", "dialect_lv1": ["A"]}\n\n{"text": "y", "dialect_lv1": "B"}\n')
    got = {r["text"]: r["dialect_lv1"] for r in readers.jsonl(spark, str(tmp_path / "l.jsonl")).collect()}
    assert got == {"x": '["A"]', "y": "B"}
    assert readers.tsv(spark, str(tmp_path / "none.tsv"), "a string").count() == 0
    (tmp_path / "w.tsv").write_text('"\t3\nkamuy\t2\n')
    assert {(r["word"], r["freq"], r["book"]) for r in readers.word_counts(spark, str(tmp_path / "w.tsv")).collect()} == {('"', 3, "w"), ("kamuy", 2, "w")}
    (tmp_path / "p.csv").write_text("about\nmore\nid,name\n1,a\n2,b\n")
    assert [r["row"]["name"] for r in readers.after_preamble(spark, str(tmp_path / "p.csv"), "id,").orderBy("ord").collect()] == ["a", "b"]
    (tmp_path / "d.xml").write_text("<m><page><title>t</title><ns>0</ns><revision><text>== アイヌ語 ==\nx</text></revision></page><page><title>u</title><ns>1</ns><revision><text>==アイヌ語==</text></revision></page></m>")
    assert [r["title"] for r in readers.wiki_dump(spark, str(tmp_path / "d.xml")).collect()] == ["t"]
    df = spark.createDataFrame([("x", "b1"), ("y", "b2")], "line string, book string")
    sinks.write_lines(df, str(tmp_path / "out"), by="book")
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def test_pipe_tables_and_first_present(spark):
    t = spark.range(1).select(readers.pipe_table(F.lit("| a | b | c | d |\n|---|---|---|---|\n| e | f | g | h |"))).first()[0]
    assert t == [["a", "b"], ["c", "d"], ["e", "f"], ["g", "h"]]
    df = spark.createDataFrame([("", "x")], "ainu string, lemma string")
    assert df.select(readers.first_present(df, "ainu", "Ainu", "lemma")).first()[0] == "x"


def test_file_stream_sees_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    seen = []
    run = lambda: incremental.file_stream(spark, str(tmp_path / "in"), "a string", lambda df, i: seen.extend(r["a"] for r in df.collect()), str(tmp_path / "cp"))
    (tmp_path / "in" / "1.json").write_text('{"a": "x"}\n')
    run()
    (tmp_path / "in" / "2.json").write_text('{"a": "y"}\n')
    run()
    assert seen == ["x", "y"]


def test_differences_and_unicode_forms(spark):
    from lexloom.functions import textdiff

    d = spark.createDataFrame([("イタク an", "イタㇰ am"), (None, "x")], "a string, b string")
    r = d.select(textdiff.restore_small_kana("a", "b").alias("k"), textdiff.word_diff("a", "b").alias("w"), textdiff.ascii_only("a").alias("u"), textdiff.compatibility_key(F.lit("Ａｱ")).alias("c"), textdiff.unescape_html(F.lit("&lt;&eacute;")).alias("h")).collect()
    assert r[0]["k"] == "イタㇰ an" and r[1]["k"] is None and "+ am" in r[0]["w"] and r[0]["u"] == " an" and r[0]["c"] == "aア" and r[0]["h"] == "<é"


def test_archives_and_sheets(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/y.txt", "hello")
    assert [(r["member"], r["text"]) for r in readers.zip_members(spark, str(tmp_path / "a.zip")).collect()] == [("x/y.txt", "hello")]
    (tmp_path / "s.tsv").write_text("word\tEnglish meaning\nkamuy, pase\tgod\n\n")
    assert {(r["lemma"], r["gloss"]) for r in readers.gloss_sheets(spark, str(tmp_path / "s.tsv")).collect()} == {("kamuy", "god"), ("pase", "god")}


def test_page_lookups(spark):
    t = "<!-- page 1 -->\nabe, fire\n<!-- page 2 -->\nkotan, village"
    assert spark.range(1).select(layout.page_block(F.lit(t), 1)).first()[0] == "abe, fire"
    e = spark.createDataFrame([(1, "abe"), (1, "x"), (3, "y")], "page int, lemma string")
    p = spark.createDataFrame([(1, "head\nabe, fire")], "page int, text string")
    assert {r["lemma"]: r["at"] > 0 for r in layout.entry_on_page(e, p, "page", "lemma", "text").collect()} == {"abe": True, "x": False, "y": False}
    turns = spark.createDataFrame([("k", 0, "1. hello"), ("k", 1, "【訳】 hi"), ("k", 2, "there"), ("k", 3, "2. bye")], "k string, n int, line string")
    assert {r["num"]: r["parts"] for r in layout.tagged_turns(turns, "k", "n", "line").collect()} == {1: {"": "hello", "訳": "hi there"}, 2: {"": "bye"}}


def test_clustered_lines_take_every_line_number(spark, tmp_path):
    from lexloom.plans import layout_queries

    rows = [(50, n, float(n), float(n), f"w{n}") for n in range(1, 8)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = layout_queries.clustered_lines(spark, str(tmp_path)).collect()
    assert sorted(r["text"] for r in got) == [f"w{n}" for n in range(1, 8)]


def test_lines_of_a_long_page(spark):
    # one page of 60,000 words at 20,000 heights: a fold that copies its lines with each word doesn't end in time
    w = spark.range(60_000).select(F.lit(1).alias("page"), (F.col("id") % 20_000).cast("double").alias("y"), F.col("id").cast("double").alias("x"), F.lit("w").alias("t"))
    began = time.time()
    got = layout.cluster_lines(w, ["page"], "y", "x", "t", 1.0).agg(F.count(F.lit(1)), F.sum(F.length("text")), F.max("line")).first()
    assert tuple(got) == (10_000, 60_000 * 2 - 10_000, 9_999)
    assert time.time() - began < 30


def test_lines_of_heights_that_are_no_numbers(spark):
    rows = [(None, 1.0, "a"), (1.0, 2.0, "b"), (2.0, 0.0, "c"), (float("nan"), 3.0, "d"), (float("nan"), 1.0, "e")]
    w = spark.createDataFrame([(p, *r) for p in (1, None) for r in rows[1:]] + [(2, *r) for r in rows[:3]], "page int, y double, x double, t string")
    got = layout.cluster_lines(w, ["page"], "y", "x", "t", 3.0).collect()
    assert sorted(((r["page"], r["line"], r["text"]) for r in got), key=repr) == sorted([(p, n, t) for p in (1, None) for n, t in ((0, "c b"), (1, "e d"))] + [(2, 0, "c a b")], key=repr)


def _repeated(spark, tmp_path, kinds):
    name = lambda n: F.translate((n + 10_000).cast("string"), "0123456789", "abcdefghij")
    kind = name(F.col("id") % kinds)
    spark.range(3000).select("id", kind.alias("lemma"), F.lit("").alias("kana"), F.concat(F.lit("bear of high mountains "), kind).alias("gloss")).write.parquet(f"{tmp_path}/q")
    spark.range(200).select(F.col("id").alias("entry"), F.lit("own").alias("source"), F.lit(0.85).alias("base_conf"), F.col("id").alias("ord"), name(F.col("id")).alias("lemma"), F.lit("").alias("lemma_kana"), F.lit("high mountains bear").alias("definition")).write.parquet(f"{tmp_path}/e")
    return spark.read.parquet(f"{tmp_path}/q"), spark.read.parquet(f"{tmp_path}/e")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exact_stage_broadcasts_no_queries(spark, tmp_path):
    q, e = _repeated(spark, tmp_path, 2000)
    out = linkage.exact_stage(linkage.prepared_queries(q), linkage.prepared_entries(e))
    assert "BroadcastExchange" not in _plan(out)
    assert {r["id"]: r["entry"] for r in out.collect()} == {i: i % 2000 for i in range(3000) if i % 2000 < 200}


def test_gloss_stage_matches_each_gloss_once(spark, tmp_path):
    q, e = _repeated(spark, tmp_path, 1)
    more = q.crossJoin(spark.range(100).select(F.col("id").alias("n"))).select((F.col("id") * 100 + F.col("n")).alias("id"), "lemma", "gloss")
    began = time.time()
    out = linkage.gloss_stage(linkage.prepared_queries(more), linkage.prepared_entries(e))
    # 300,000 equal glosses against 200 equal definitions are 180 million pairs of tokens
    assert out.agg(F.count_distinct("id"), F.max("entry"), F.min("score")).first()[:2] == (300_000, 0)
    assert time.time() - began < 40


def test_gloss_stage_reads_whole_definitions(spark, monkeypatch):
    words = ["".join(c) for c in itertools.product("bdfgk", "aeiou", "lmnrs")]
    q = spark.createDataFrame([(1, "x", " ".join(words[40:48])), (2, "x", "満足 神様"), (3, "x", " ".join(words[100:108])), (4, "x", " ".join(words[8:12]))], "id long, lemma string, gloss string")
    long = " ".join(words[8:48])
    kana = " ".join(chr(ord("あ") + i) * 3 for i in range(9)) + " 満足 神様"
    rows = [(11, "own", 0.85, 2, "y", long), (10, "own", 0.85, 1, "y", long), (10, "own", 0.85, 1, "y", long), (12, "own", 0.85, 3, "y", kana), (13, "own", 0.85, 4, "y", " ".join(words[50:95] + words[100:108])), (14, "asjp", 0.85, 0, "y", long)]
    e = spark.createDataFrame(rows, "entry long, source string, base_conf double, ord long, lemma string, definition string")
    # 8 of 40 and 2 of 11 tokens are shared, each after the first eight; 8 of 53 and 4 of 40 are too few
    want = [(1, 10, round(0.5 + 0.25 * 8 / 40, 6)), (2, 12, round(0.5 + 0.25 * 2 / 11, 6))]
    for few in (1000, 0):
        monkeypatch.setattr(linkage, "FEW", few)
        got = linkage.gloss_stage(linkage.prepared_queries(q), linkage.prepared_entries(e)).collect()
        assert sorted((r["id"], r["entry"], r["score"]) for r in got) == want, few


def test_match_reverse_gloss_reads_whole_definitions(spark, tmp_path):
    from lexloom.plans import lexicon_queries
    from oracle import difference

    names = [(1, " ".join(f"w{i}" for i in range(1, 13)), "Brand#1", "LARGE", 1), (4, "w9 w10 w11", "Brand#2", "W12", 1), (8, "w9 z1 z2 z3", "Brand#2", "W12", 1)]
    spark.createDataFrame(names, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/rows")
    os.rename(glob.glob(f"{tmp_path}/rows/*.parquet")[0], f"{tmp_path}/part.parquet")
    run = lambda: lexicon_queries.match_reverse_gloss(spark, str(tmp_path))
    assert sorted((r["id"], r["entry"], r["score"]) for r in run().collect()) == [(1, 1, 0.732143), (4, 1, 0.571429)]
    assert difference(run(), lexicon_queries.SQL["match_reverse_gloss"], str(tmp_path)) == ""


def test_cascade_broadcasts_no_queries(spark, tmp_path):
    q, e = _repeated(spark, tmp_path, 2000)
    assert "BroadcastExchange" not in _plan(linkage.cascade(q, e))


def test_cascade_of_repeated_and_missing_ids(spark, monkeypatch):
    q = spark.createDataFrame([(1, "Qqq", ""), (1, "Kamui", ""), (2, None, None), (None, "Kamui", ""), (3, "Kamui", ""), (3, "Kamui", "")], "id long, lemma string, gloss string")
    e = spark.createDataFrame([(7, "own", 0.85, 1, "kamuy", "god")], "entry long, source string, base_conf double, ord long, lemma string, definition string")
    want = [(1, 7), (1, 7), (2, None), (3, 7), (3, 7), (None, None)]
    for few in (1000, 0):
        monkeypatch.setattr(linkage, "FEW", few)
        got = linkage.cascade(q, e).collect()
        assert sorted(((r["id"], r["entry"]) for r in got), key=repr) == want, few


def test_match_summary_broadcasts_no_queries(spark, tmp_path):
    q, e = _repeated(spark, tmp_path, 2000)
    out = linkage.match_summary(linkage.cascade(q, e))
    assert _plan(out).count("BroadcastExchange") == 1  # the one row of the total
