"""Parsers of dictionary entries and story pages, and filters of lines and words, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexloom.functions.morphology import literal_map
from lexloom.functions.textclean import chain

# Parts of speech of one dictionary's entries.
ENTRY_TAGS = {
    "接尾": "sfx", "接頭": "pfx", "副助詞": "advp", "接続助詞": "sconj", "疑問": "int", "形式名詞": "nmlz", "動詞": "v", "自動": "vi", "他動": "vt",
    "複他動": "vd", "完動": "vc", "複他": "vd", "名": "n", "名詞": "n", "連体詞": "adn", "副詞": "adv", "接続詞": "cconj", "助詞": "post", "助動": "auxv",
    "副": "adv", "終助": "sfp", "接尾辞": "sfx", "接頭辞": "pfx", "間投": "intj", "後置副詞": "padv", "人接": "pers", "繋辞": "cop", "位名": "nl",
    "複数形": "v", "副助": "advp", "接助": "sconj", "疑問詞": "int", "形名": "nmlz", "他動語幹": "root", "自動語幹": "root", "他動語根": "root",
    "語構成要素": "root", "語根": "root", "名詞語根": "root", "代名": "pron", "連他動": "colloc", "後副": "padv", "接": "cconj", "連体": "adn",
    "格助": "postp", "助": "parti", "分離他動": "vt", "慣用句": "idiom", "数名": "n",
}
# Abbreviations of parts of speech in word lists.
LIST_TAGS = {
    "名": "名詞", "位名": "位置名詞", "代名": "代名詞", "形名": "形式名詞", "完": "完全動詞", "完動": "完全動詞", "自": "自動詞", "他": "他動詞", "副": "副詞",
    "後副": "後置副詞", "連体": "連体詞", "間投": "間投詞", "助動": "助動詞", "格助": "格助詞", "副助": "副助詞", "終助": "終助詞", "接助": "接続助詞",
    "接": "接続詞", "人接": "人称接辞", "接頭": "接頭辞", "接美": "接尾辞", "単": "単数形", "複": "複数形", "所": "所属形", "複他": "複他動詞",
    "疑問": "疑問詞", "代名？": "代名詞", "指定": "繋辞", "序動": "助動詞", "接尾": "接尾辞",
}
# What is no gloss in a tagged definition, in order; the forms of a line of a word list and of a column's entry.
NO_GLOSS = [("【(.*?)】", ""), ("（出典：.*?）", ""), (r"\[.*?\]", ""), (r"\(.*\)", ""), ("[☞☆].*", ""), (r"\{.*?\}", ""), ("｟テープ｠", "")]
LIST_LINE = r"^([^\p{IsLatin}]+)\s*([^\p{IsHiragana}\p{IsKatakana}\p{IsHan}\p{N}～]+)\s*([^【]+?)\s*(【.*)"
COLUMN_ENTRY = r"^([ァ-ヴーㇰ-ㇿ゠]+(?:\s*[(（][^)）]+[)）])?)\s+([A-Za-z][A-Za-z=~’'\-]*(?:[(（][^)）]+[)）])?)(?:\s+(.+))?$"
# What lines that aren't entries begin with.
JUNK = ("■", "＊", "※", "「", "単語", "単")
KANA = "ァ-ヴーㇰ-ㇿ゠"


def _named(c: Column, table: dict[str, str]) -> Column:
    return F.coalesce(F.element_at(literal_map(table), c), c)


def signs_only(word: Column) -> Column:
    """Whether a word is of digits and punctuation only."""
    return word.rlike(r"^[\p{Nd}\p{P}]+\z")


def worth_keeping(lemma: Column, frequency: Column, glosses: Column) -> Column:
    """Terms that occur more than once or have a gloss (array), and aren't numbers."""
    return ((F.coalesce(frequency, F.lit(0)) > 1) | (F.coalesce(F.size(glosses), F.lit(0)) > 0)) & ~lemma.rlike(r"^\d+\z")


def junk_line(line: Column) -> Column:
    """Headings, notes, example sentences and printers' marks of a word list."""
    out = F.left(line, F.lit(6)).contains("：") | line.contains(".indd")
    for mark in JUNK:
        out = out | line.startswith(mark)
    return out


def tagged_entry(definition: Column) -> Column:
    """struct(poses, glosses) of a definition with a 【tag】, else null: joined tags parted and named; glosses are the runs
    between punctuation that don't begin with ASCII, without sources, brackets and references."""
    tag = F.regexp_replace(F.regexp_extract(definition, "【(?:< )?(.*?)】", 1), r"\(?[?？]\)?", "")
    parts = F.transform(F.split(chain(definition, NO_GLOSS), r"[\p{P}①②③④⑤⑥⑦⑧⑨⑩]"), lambda g: F.trim(F.regexp_replace(g, r"(?U)^\s+|\s+\z", "")))
    told = F.struct(F.transform(F.split(tag, "[＋/+(]"), lambda t: _named(t, ENTRY_TAGS)).alias("poses"), F.filter(parts, lambda g: (g != "") & ~g.rlike(r"^[\x00-\x7F]")).alias("glosses"))
    return F.when((tag != "") & ~tag.rlike(r"^[\x00-\x7F]"), told)


def lines_with_one_tag(line: Column) -> Column:
    """array<string>: a line with several 【tags】 cut behind each of them; other lines as they are."""
    return F.when(F.regexp_count(line, F.lit("】")) > 1, F.regexp_extract_all(line, F.lit(r"(.*?【.*?】[^\p{IsKatakana}]*］?)\s*"), F.lit(1))).otherwise(F.array(line))


def list_line(line: Column) -> Column:
    """struct(kana, latin, gloss, pos, note) of a line `kana latin gloss 【pos】［note］`, without its spaces; else null."""
    p = LIST_LINE
    part = lambda i: F.replace(F.regexp_extract(line, p, i), F.lit(" "), F.lit(""))
    inside = lambda pattern: F.nullif(F.regexp_extract(part(4), pattern, 1), F.lit(""))
    return F.when(line.rlike(p), F.struct(part(1).alias("kana"), part(2).alias("latin"), part(3).alias("gloss"), inside("^【(.*)】").alias("pos"), inside("^［(.*)］").alias("note")))


def list_term(lemma: Column, glosses: Column, poses: Column, notes: Column) -> Column:
    """struct(lemma, glosses, poses, notes) of a row of a word list: lists parted, tags in full, brackets and spaces gone."""
    return F.struct(
        F.regexp_replace(lemma, r"(?U)\s+", "").alias("lemma"),
        F.transform(F.split(glosses, "[、，・]"), lambda g: F.replace(F.trim(g), F.lit(" "), F.lit(""))).alias("glosses"),
        F.transform(F.split(F.regexp_replace(poses, r"^[【】]+|[【】]+\z", ""), "[、・]"), lambda p: _named(F.trim(p), LIST_TAGS)).alias("poses"),
        F.regexp_replace(notes, r"(?U)\s+|（|）", "").alias("notes"),
    )


def glued(words: Column, gap: float = 4.0) -> Column:
    """A line of words (array<struct<xmin,xmax,text>>), from left to right with spaces; neighbouring kana nearer than `gap`
    are one word."""
    kana = rf"[{KANA}]"

    def step(s: Column, w: Column) -> Column:
        close = s["text"].rlike(rf"{kana}\z") & w["text"].rlike(f"^{kana}") & (w["xmin"] - s["end"] < gap)
        text = F.when(s["end"].isNull(), w["text"]).otherwise(F.concat(s["text"], F.when(close, "").otherwise(" "), w["text"]))
        return F.struct(text.alias("text"), w["xmax"].cast("double").alias("end"))

    return F.aggregate(F.array_sort(words), F.struct(F.lit("").alias("text"), F.lit(None).cast("double").alias("end")), step, lambda s: s["text"])


def column_entry(text: Column) -> Column:
    """struct(kana, lemma, gloss, pos, notes) of `kana lemma gloss 【pos】 notes ［more notes］`, else null."""
    p = COLUMN_ENTRY
    rest = F.trim(F.regexp_extract(text, p, 3))
    tagged = rest.rlike("【[^】]+】")
    gloss = F.when(tagged, F.trim(F.regexp_extract(rest, "^(.*?)【[^】]+】", 1))).otherwise(rest)
    notes = F.when(tagged, F.trim(F.regexp_extract(rest, "^.*?【[^】]+】(.*)$", 1))).otherwise("")
    notes = F.trim(F.regexp_replace(notes, "［([^］]+)］", " $1 "))
    return F.when(text.rlike(p), F.struct(F.trim(F.regexp_extract(text, p, 1)).alias("kana"), F.trim(F.regexp_extract(text, p, 2)).alias("lemma"), gloss.alias("gloss"), F.regexp_extract(rest, "【([^】]+)】", 1).alias("pos"), F.regexp_replace(notes, " +", " ").alias("notes")))


# Repairs of story pages, in order.
PAGE_REPAIRS = [(r"[（(][?？][）)]", ""), (r"(?m)^[（(][^）)]+[）)]$", ""), (r"(?m)^\d+$", "")]
TEXT_REPAIRS = [
    (r"\n{3,}", "\n\n"), (r"(?m)^\d+\s+", ""), (r"\[\d+\]", ""), (r"(?U)(\w)\s+_", "$1_"), (" =", "="), ("= ", "="),
    (r"([^aeiou])\s+y\s+([aeiou])", "$1 y$2"), (r"([aeiou])\s+y\s+([^aeiou])", "$1y $2"), (r"([^aeiou])\s+s\s+([aeiou])", "$1s$2"),
]
TITLE_REPAIRS = [(r"(?U)\s*「\s*", "「"), (r"(?U)\s*」\s*", "」"), (r"(?U)\s*（\s*", "（"), (r"(?U)\s*）\s*", "）")]


def story_page(page: Column) -> Column:
    """A page of a story without doubts, lines that are only a bracket or a number, and spaces at the ends of lines."""
    lines = F.array_join(F.transform(F.split(page, r"\r?\n"), lambda s: F.regexp_replace(s, r"(?U)^\s+|\s+$", "")), "\n")
    return chain(lines, PAGE_REPAIRS)


def story_text(content: Column) -> Column:
    """The text of a story: up to the next chapter's number and the notes, clitics and split syllables joined."""
    body = F.regexp_replace(F.split(content, r"\d+\s+\d+-\d+", 2)[0], r"^\s+|\s+\z", "")
    return chain(F.trim(F.regexp_replace(F.split(body, "【注】", 2)[0], r"^\s+|\s+\z", "")), TEXT_REPAIRS)


def story_title(title: Column) -> Column:
    return chain(F.trim(title), TITLE_REPAIRS)
