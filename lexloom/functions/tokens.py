"""Tokens of transcribed sentences, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the transcription: letters of words, single signs, personal affixes.
LETTERS = r"a-zA-Zâîûêôáíúéó=\-_'’"
SIGNS = r"<>.,‘\"“”"
PREFIXES = ["ku", "k", "en", "in", "ci", "c", "un", "a", "i", "an", "e", "eci", "ec"]
SUFFIXES = ["an", "as"]

WORD = rf"^[{LETTERS}]+\z"
RAW = rf"(?U)\.\.\.(?:\.\.\.)?|[{LETTERS}\[\]]+|\d+|[{SIGNS}]|[^\s\d{LETTERS}\[\]{SIGNS}]+"
AFFIXED = rf"^((?:{'|'.join(PREFIXES)})=)?((?:{'|'.join(PREFIXES)})=)?([a-z/\-]+)(=(?:{'|'.join(SUFFIXES)}))?(.*)"
QUOTED = r"^(['’‘]?)([^'’‘]*)(['’‘]?)\z"


def _full(a: Column) -> Column:
    return F.filter(a, lambda x: x != "")


def raw_tokens(text: Column, twice_six_dots: bool = False) -> Column:
    """Runs of letters, digits, single signs, dots in threes, and what else lies between white space. With
    `twice_six_dots` a run of six dots is followed by one of three, as a nested group of a split would give."""
    found = F.regexp_extract_all(text, F.lit(RAW), F.lit(0))
    if twice_six_dots:
        found = F.flatten(F.transform(found, lambda w: F.when(w == "......", F.array(w, F.lit("..."))).otherwise(F.array(w))))
    return found


def split_quotes(word: Column) -> Column:
    """One quotation mark at either end becomes a token of its own; a mark inside leaves the word whole."""
    parts = _full(F.array(*[F.regexp_extract(word, QUOTED, i) for i in (1, 2, 3)]))
    return F.when((F.length(word) >= 2) & word.rlike(QUOTED), parts).otherwise(F.array(word))


def split_affixes(word: Column, lose_rest: bool = False) -> Column:
    """Personal affixes apart from the stem. A word with one marker (= or -) is cut there, the marker staying with the
    shorter side (of equal ones the first). With more markers up to two prefixes, a stem and a suffix are taken; what
    follows them is a last token, or is lost with `lose_rest`."""
    marks = F.regexp_count(word, F.lit("[-=]"))
    groups = [F.regexp_extract(word, AFFIXED, i) for i in range(1, 5 if lose_rest else 6)]
    many = F.when(word.rlike(AFFIXED), _full(F.array(*groups))).otherwise(F.array(word))
    a, sep, b = (F.regexp_extract(word, r"^([^-=]*)([-=])([^-=]*)\z", i) for i in (1, 2, 3))
    one = F.when(F.length(a) > F.length(b), F.array(a, F.concat(sep, b))).otherwise(F.array(F.concat(a, sep), b))
    return F.when(marks >= 2, many).when(marks == 1, one).otherwise(F.array(word))


def cut_token(raw: Column, compat: bool = False) -> Column:
    """array<string>: the tokens of one raw token."""
    return _full(F.flatten(F.transform(split_quotes(raw), lambda w: split_affixes(w, compat))))


def tokenize(text: Column, compat: bool = False) -> Column:
    """array<string> of a sentence. `compat` keeps two oddities: the doubled six dots and the lost rest."""
    plain = r"^[^-='’‘]*\z"  # most tokens have nothing to cut
    cut = lambda w: F.when(w.rlike(plain), F.array(w)).otherwise(cut_token(w, compat))
    return _full(F.flatten(F.transform(raw_tokens(F.coalesce(text, F.lit("")), compat), cut)))


def is_word(word: Column) -> Column:
    return word.rlike(WORD)


def bare(form: Column) -> Column:
    """A form without - and = at its ends."""
    return F.regexp_replace(form, r"^[-=]+|[-=]+\z", "")


# Letters with marks and what is left of them in ASCII (compatibility decomposition), for Latin text.
_MARKED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿāēīōūÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝĀĒĪŌŪ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyyaeiouAAAAAACEEEEIIIINOOOOOUUUUYAEIOU"


def remove_accent(text: Column) -> Column:
    """Marked Latin letters become plain; what is then not ASCII goes."""
    return F.regexp_replace(F.translate(text, _MARKED, _PLAIN), r"[^\x00-\x7F]", "")


def normalize(word: Column) -> Column:
    """The form that is counted and looked up: no accents, no apostrophes between vowels or at the ends, no underscores,
    no bracketed additions (a word wholly in brackets keeps what is inside), np for mp in two words."""
    w = remove_accent(word)
    w = F.regexp_replace(w, r"(?<=[aiueo])'(?=[aiueo])", "")
    w = F.regexp_replace(w, r"^'|'\z", "")
    w = F.replace(w, F.lit("_"), F.lit(""))
    w = F.regexp_replace(w, r"^\[(.*?)\]\z", "$1")
    w = F.regexp_replace(w, r"\[.*?\]", "")
    return F.replace(F.replace(w, F.lit("neampe"), F.lit("neanpe")), F.lit("ampe"), F.lit("anpe"))


def legacy_clean(word: Column) -> Column:
    """array<string>: lower case without underscores; plain words stay, others lose all but ASCII and are split at
    affixes if they have any, else they go."""
    w = F.replace(F.lower(word), F.lit("_"), F.lit(""))
    ascii_only = F.regexp_replace(w, r"[^\x00-\x7F]", "")
    return F.when(w.rlike(r"^[a-z]+\z"), F.array(w)).when(ascii_only.rlike("[-=]"), _full(split_affixes(ascii_only, True))).otherwise(F.array().cast("array<string>"))


def syllables(word: Column) -> Column:
    """array<string>: an onset consonant, a vowel, and a coda where no vowel follows it."""
    return F.regexp_extract_all(word, F.lit(r"(?i)[^aiueoáíúéóâîûêô]?[aiueoáíúéóâîûêô](?:[^aiueoáíúéóâîûêô](?![aiueoáíúéóâîûêô]))?|[^aiueoáíúéóâîûêô]+"), F.lit(0))


def accent(word: Column) -> Column:
    """The accented syllable (from 0): the marked one, else the second if the first is open, else the first."""
    parts = syllables(word)
    marked = F.array_position(F.transform(parts, lambda s: s.rlike("[áéíóú]")), True) - 1
    return F.when(word.rlike("[áéíóú]"), marked).when(F.get(parts, F.lit(0)).rlike(r"[aiueoáíúéó]\z"), F.lit(1)).otherwise(F.lit(0)).cast("int")


def to_sakhalin(word: Column) -> Column:
    """A southern form from a northern one: codas p, t, k become h (s after i), r takes its vowel again, m becomes n."""
    last, before = (lambda s: F.right(s, F.lit(1))), (lambda s: F.substring(s, F.length(s) - 1, F.lit(1)))
    head = lambda s: F.left(s, F.length(s) - 1)
    turn = lambda s: (
        F.when(~s.rlike("^[a-zA-Z]") | (F.length(s) <= 1), s)
        .when(last(s).isin("p", "t", "k"), F.concat(head(s), F.when(before(s) == "i", "s").otherwise("h")))
        .when(last(s) == "r", F.concat(s, before(s)))
        .when(last(s) == "m", F.concat(head(s), F.lit("n")))
        .otherwise(s)
    )
    return F.array_join(F.transform(syllables(word), turn), "")


def merge_long_vowels(parts: Column) -> Column:
    """Syllables of southern words: a bare vowel that repeats the vowel before it joins its syllable; a syllable that then
    begins with a vowel gets an apostrophe before it, and m at the end becomes n."""
    joined = F.aggregate(
        F.filter(parts, lambda s: s != ""),
        F.array().cast("array<string>"),
        lambda out, s: F.when(
            (F.size(out) > 0) & s.rlike("^[aiueo]$") & (F.right(F.element_at(out, -1), F.lit(1)) == s),
            F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.concat(F.element_at(out, -1), s))),
        ).otherwise(F.concat(out, F.array(s))),
    )
    return F.transform(joined, lambda s: F.regexp_replace(F.when(s.rlike("^[aiueo]"), F.concat(F.lit("’"), s)).otherwise(s), r"m\z", "n"))


def southern_syllables(word: Column) -> Column:
    """array<string>: the syllables of a southern word, without affix marks, in lower case."""
    return merge_long_vowels(syllables(F.replace(F.lower(word), F.lit("="), F.lit(""))))


def word_break(word: Column, morphemes: Column) -> Column:
    """Whether a word is a sequence of morphemes (array<string>): a pass over its positions that keeps those reached."""
    reach = F.aggregate(
        F.sequence(F.lit(1), F.length(word)),
        F.array(F.lit(0)),
        lambda ok, i: F.when(F.exists(ok, lambda j: F.array_contains(morphemes, F.substring(word, j + 1, i - j))), F.concat(ok, F.array(i))).otherwise(ok),
    )
    return F.when(F.length(word) > 0, F.array_contains(reach, F.length(word))).otherwise(F.lit(True))


def expand_braces(pattern: Column, most: int = 8) -> Column:
    """array<string>: `k{e,o}m{o,∅}` stands for all its choices, ∅ for nothing; at most `most` groups."""
    group = r"^([^{}]*)\{([^{}]*)\}(.*)\z"
    out = F.array(pattern)
    for _ in range(most):
        out = F.flatten(
            F.transform(
                out,
                lambda p: F.when(
                    p.rlike(group),
                    F.transform(F.split(F.regexp_extract(p, group, 2), ","), lambda c: F.concat(F.regexp_extract(p, group, 1), F.when(F.trim(c) == "∅", "").otherwise(F.trim(c)), F.regexp_extract(p, group, 3))),
                ).otherwise(F.array(p)),
            )
        )
    return out
