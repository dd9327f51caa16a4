"""Column expressions on small literal samples."""

import pytest
from pyspark.sql import functions as F

from lexloom.functions import morphology, orthography, textclean, tokens
from lexloom.operators import search


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()[0]


TOKENS = {
    "hioy’oy": ["hioy’oy"],
    "aynu itak k=eyaypakasnu kor k=an!": ["aynu", "itak", "k=", "eyaypakasnu", "kor", "k=", "an", "!"],
    "a=sirkocotca p ne kusu an hine <ne>": ["a=", "sirkocotca", "p", "ne", "kusu", "an", "hine", "<", "ne", ">"],
    "u ne[y] rok awa[n]": ["u", "ne[y]", "rok", "awa[n]"],
    "": [],
    "  \n ": [],
    "12 ...": ["12", "..."],
    "‘itak’": ["‘", "itak", "’"],
}


def test_tokenize(spark):
    got = dict(values(spark, [(k,) for k in TOKENS], "s string", "s", tokens.tokenize(F.col("s"))))
    assert got == TOKENS


def test_tokenize_null_and_oddities(spark):
    assert one(spark, tokens.tokenize(F.lit(None).cast("string"))) == []
    assert one(spark, tokens.tokenize(F.lit("......"))) == ["......"]
    assert one(spark, tokens.tokenize(F.lit("......"), compat=True)) == ["......", "..."]
    assert one(spark, tokens.tokenize(F.lit("a=e=kamuyX"), compat=True)) == ["a=", "e=", "kamuy"]
    assert one(spark, tokens.tokenize(F.lit("a=e=kamuyX"))) == ["a=", "e=", "kamuy", "X"]


@pytest.mark.parametrize("word,want", [("w_a", "wa"), ("__hine", "hine"), ("h_ine", "hine"), ("ne[y]", "ne"), ("awa[n]", "awa"), ("[u]", "u"), ("ne'ampe", "neanpe"), ("inkar'", "inkar"), ("’sekor", "sekor"), ("néno", "neno"), ("côsi", "cosi")])
def test_normalize(spark, word, want):
    assert one(spark, tokens.normalize(F.lit(word))) == want


@pytest.mark.parametrize("word,want", [("úsey", 0), ("tané", 1), ("konkane", 0), ("kuni", 1)])
def test_accent(spark, word, want):
    assert one(spark, tokens.accent(F.lit(word))) == want


@pytest.mark.parametrize("word,want", [("sat", "sah"), ("pirka", "pirika"), ("ikra", "isra"), ("kim", "kin")])
def test_southern_forms(spark, word, want):
    assert one(spark, tokens.to_sakhalin(F.lit(word))) == want


W = "array<struct<word:string,poss:array<string>>>"
FIND = [
    ([], [], [0]),
    ([], [("wakka", ["noun"])], [0]),
    ([("wakka", "noun")], [], []),
    ([("hemanta", None)], [("wakka", ["noun"])], []),
    ([("exa", None)], [("exact", ["noun"])], []),
    ([(None, "verb")], [("a", ["verb"]), ("b", ["verb"]), ("c", ["noun"]), ("d", ["verb"])], [0, 1, 3]),
    ([("wakka", None), (None, "verb")], [("wakka", ["noun", "verb"]), ("wakka", ["verb"]), ("x", ["verb"])], [0, 1]),
    ([(None, None), (None, None)], [("a", []), ("b", []), ("c", [])], [0, 1]),
    ([(None, "noun"), (None, "noun")], [("a", ["noun"]), ("b", ["verb"]), ("c", ["noun"]), ("d", ["noun"])], [2]),
    ([("a", None), ("c", None)], [("a", []), ("b", []), ("c", [])], []),
]


@pytest.mark.parametrize("keywords,words,want", FIND)
def test_find(spark, keywords, words, want):
    df = spark.createDataFrame([(words,)], f"w {W}")
    c = search.find(keywords, F.transform("w", lambda x: x["word"]), F.transform("w", lambda x: x["poss"]))
    assert df.select(c.alias("f")).first()[0] == want


def test_concordance_context_is_all_or_nothing(spark):
    rows = [("a", 0, "s0", ["x"]), ("a", 1, "s1", ["y"]), ("b", 2, "s2", ["x", "z"])]
    df = spark.createDataFrame(rows, "book string, idx long, sentence string, words array<string>")
    got = {r["idx"]: r for r in search.concordance(df, [("x", None)], k=1).collect()}
    assert got[0]["words"] == ["x", "y"] and got[0]["sentence"] == " s0 s1"
    assert got[2]["words"] == ["x", "z"] and got[2]["intervals"][0]["start"] == 0
    assert search.concordance(df.limit(0), [("x", None)]).count() == 0


def test_upos(spark):
    want = {"vt": "_", "cconj": "SCONJ", "n": "NOUN", "zzz": "_", "verb": "VERB", "noun": "NOUN", "int": "PRON", "determiner": "DET", "post": "POST", "parti": "ADP"}
    assert dict(values(spark, [(p,) for p in want], "p string", "p", morphology.upos(F.col("p")))) == want
    assert one(spark, morphology.upos(F.lit("vt"), corrected=True)) == "VERB"


def test_closed_possessives_skip_empty_long_forms():
    assert morphology.closed_possessives([("aep", "aepi", ""), ("mat", "maci", "macihi")]) == {"aepi": "aep", "maci": "mat", "macihi": "mat"}


@pytest.mark.parametrize("old,new", [("shi", "si"), ("chise", "cise"), ("kamui", "kamuy"), ("Kamul", "Kamuy"), ("ainu", "aynu"), ("huchi", "huci"), ("tch", "cc"), ("bos", "pos"), ("Tsushi", "Cusi")])
def test_modern_spelling(spark, old, new):
    assert one(spark, orthography.normalize_lemma(F.lit(old))) == new


def test_keys_and_variants(spark):
    assert one(spark, orthography.variants(F.lit("Iresu-kamui")))[:2] == ["Iresu-kamuy", "Iresukamuy"]
    assert one(spark, orthography.latin_key(F.lit("=Kamuy2,"))) == "kamuy"
    keys = one(spark, orthography.lookup_keys(F.lit("Siyuk, Siwk")))
    assert "siyuk" in keys and "siwk" in keys and len(keys) == len(set(keys))
    assert set(one(spark, orthography.edit1_keys(F.lit("abc")))) == {"abc", "bc", "ac", "ab"}
    assert one(spark, orthography.substrings(F.lit("abcde"))) == ["abcd", "bcde", "abcde"]
    assert one(spark, orthography.gloss_tokens_en(F.lit("The big House, a one's house"))) == ["big", "house"]


def test_expansions(spark):
    assert sorted(one(spark, tokens.expand_braces(F.lit("k{e,o}m{o,∅}")))) == ["kem", "kemo", "kom", "komo"]
    assert one(spark, tokens.word_break(F.lit("kamuycise"), F.array(F.lit("kamuy"), F.lit("cise"))))
    assert not one(spark, tokens.word_break(F.lit("kamuyx"), F.array(F.lit("kamuy"))))
    assert one(spark, textclean.template_words(F.lit("N1 kes{pa,to} a=kor itak=an V2!"))) == ["kespa", "kesto", "kor", "ita" + "k"]


def test_nested_brackets_and_entities(spark):
    assert one(spark, F.trim(textclean.squeeze(textclean.strip_brackets(F.lit("a [b [c [d [e] d] c] b] z"))))) == "a z"
    assert one(spark, textclean.strip_brackets(F.lit("a [b [c] z ] y] x"))) == "a   y] x"
    assert one(spark, textclean.strip_brackets(F.lit("a [b [c] z"))) == "a [b   z"
    assert one(spark, textclean.strip_html(F.lit("<p>caf&eacute; &amp;lt; &#233;&#x1F642; &hellip;&nbsp;&bogus; &#0;</p>"))) == "café &lt; é🙂 … &bogus; &#0;"


def test_wikitext_templates(spark):
    en = textclean.wiki_glosses_en(F.lit("# {{qualifier|archaic|rare}} to [[go|walk]] ''far'' , {{m|ain|ku=|thing}}<ref name=a/>\n## no\n# &lt;x&gt; {{unknown|{{l|en|y}}}}"))
    assert one(spark, en) == ["archaic|rare to walk far, thing", "<x>"]
    ja = textclean.wiki_glosses_ja(F.lit("# {{noun form of|ain|ape|所属形}}、{{form of|ain|所属形|tr=x|mat}}\n# {{alternative form of|ain|cise|t=家}}。{{verb form of|ain|ek|複数形|t=来る}}\n# {{おくりがな2|食|た|べる|x}}...\n# {{quote|ain|z}}"))
    assert one(spark, textclean.markup_free(ja)) == sorted(["apeの所属形", "matの所属形", "家の別形", "来る", "食べる～"])


def test_layout_texts(spark):
    assert one(spark, textclean.strip_footnotes(F.lit("itak^24 an²⁴"))) == "itak an"
    assert one(spark, textclean.utterance(F.lit("[カナ [?] x] itak ＝an 。"))) == "itak =an"
    assert tuple(one(spark, textclean.item_start(F.lit("12. アイヌ")))) == (12, "アイヌ")
    assert one(spark, textclean.item_start(F.lit("3人の"))) is None
    assert tuple(one(spark, textclean.head_and_latin(F.lit("カムイ kamuy")))) == ("カムイ", "kamuy")
    assert tuple(one(spark, textclean.resplit(F.lit("Abe, アベ, fire"), F.lit(""), F.lit("")))) == ("Abe", "アベ", "fire")
    assert one(spark, textclean.small_kana_winner(F.lit("イタク"), F.lit("イタㇰ"))) == "b"
    assert one(spark, textclean.small_kana_winner(F.lit("イタク"), F.lit("イタカ"))) is None
    j = one(spark, textclean.judge_answer(F.lit('ok {"winner": "A", "confidence": 0.9}')))
    assert (j["winner"], j["confidence"], j["reason"]) == ("a", 0.9, "unspecified")
    assert one(spark, textclean.judge_answer(F.lit("none")))["reason"] == "invalid_json"
