"""Old and new spellings, lookup keys and gloss tokens, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the orthographies. Longer strings come first.
DIGRAPHS = [("tch", "cc"), ("Tch", "Cc"), ("TCH", "CC"), ("ch", "c"), ("Ch", "C"), ("CH", "C"), ("sh", "s"), ("Sh", "S"), ("SH", "S")]
TS = [("ts", "c"), ("Ts", "C"), ("TS", "C")]
VOICED = ("bBdDgGzZjJ", "pPtTkKsScC")
MACRONS = [("ā", "aa"), ("ē", "ee"), ("ī", "ii"), ("ō", "oo"), ("ū", "uu"), ("Ā", "AA"), ("Ē", "EE"), ("Ī", "II"), ("Ō", "OO"), ("Ū", "UU")]
ALPHABET = "aceèhiklmnoprstuwy'-"
# Beginnings of stems, longest first.
STEM_PREFIXES = ("yayko", "yaykoy", "ikoy", "ako", "aki", "ane", "ami", "asi", "yay", "yai", "uko", "uwe", "sir", "esi", "eko", "eu", "an", "ae", "ai", "ar", "ko", "ku", "e", "i", "a")
# English words that tell nothing.
EN_STOP = (
    "a", "an", "and", "the", "to", "of", "is", "it", "in", "on", "for", "as", "or", "by", "with", "from", "this", "that", "be", "are", "was", "were",
    "him", "her", "his", "he", "she", "they", "them", "we", "our", "you", "your", "i", "my", "me", "do", "did", "does", "not", "no", "any", "some",
    "all", "but", "if", "when", "where", "what", "who", "which", "have", "has", "had", "been", "being", "one's", "ones",
    "n", "v", "vt", "vi", "adj", "adv", "conj", "prep", "interj", "part", "pron", "ph",
)
# Japanese words that tell nothing.
JA_STOP = ("の", "に", "を", "は", "が", "と", "で", "から", "まで", "や", "そして", "また", "など", "こと", "もの", "ため", "ある", "いる", "する", "なる", "れる", "られる", "せる", "させる")
KANA_HEAD = "^[ァ-ヴーㇰ-ㇿ・]+"


def _replaced(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def _glides(c: Column, vowels: str, others: str) -> Column:
    c = F.regexp_replace(c, rf"([{vowels.replace('i', '').replace('I', '')}])i(?=\z|[^{others}])", "$1y")
    return F.regexp_replace(c, rf"([{vowels.replace('u', '').replace('U', '')}])u(?=\z|[^{others}])", "$1w")


def l_to_i(c: Column) -> Column:
    return F.translate(c, "lL", "iI")


def normalize_lemma(lemma: Column, devoice: bool = True, codas: bool = True) -> Column:
    """Missionary spelling to modern: l to i, macrons doubled, digraphs, voiced to voiceless, glides in codas."""
    c = _replaced(_replaced(l_to_i(lemma), MACRONS), DIGRAPHS + TS)
    c = F.translate(c, *VOICED) if devoice else c
    return _glides(c, "aeiouAEIOU", "aeiouAEIOUyYwW") if codas else c


def normalize_regional(lemma: Column) -> Column:
    """A regional spelling to modern: as normalize_lemma without l, macrons and ts; glides after small letters only."""
    return _glides(F.translate(_replaced(lemma, DIGRAPHS), *VOICED), "aeiou", "aeiouAEIOU")


def variants(lemma: Column) -> Column:
    """array<string> of spellings to try, most standard first: modern, without hyphens, without glides, voiced, as printed."""
    base, plain, voiced = normalize_lemma(lemma), normalize_lemma(lemma, codas=False), normalize_lemma(lemma, devoice=False)
    joined = lambda c: F.replace(c, F.lit("-"), F.lit(""))
    return F.array_distinct(F.array(base, joined(base), plain, joined(plain), voiced, lemma, joined(lemma)))


def latin_key(c: Column) -> Column:
    """The key under which Latin headwords meet: small letters without marks at the end, = at the ends, or numbers."""
    c = F.regexp_replace(F.trim(F.lower(c)), "[,.;:'’`\"]+\\z", "")
    return F.regexp_replace(F.regexp_replace(c, r"^=+|=+\z", ""), r"[¹²³⁴⁵⁶⁷⁸⁹⁰0-9]+\z", "")


def kana_key(c: Column) -> Column:
    return F.regexp_extract(F.trim(F.coalesce(c, F.lit(""))), KANA_HEAD, 0)


def prefix_stems(key: Column) -> Column:
    """array<string>: what is left behind each known beginning, of three letters or more."""
    stem = lambda p: F.regexp_replace(F.right(key, F.length(key) - len(p)), r"^['\-]+", "")
    each = [F.when(key.startswith(p) & (F.length(stem(p)) >= 3) & F.lit(ALPHABET).contains(F.left(stem(p), F.lit(1))), stem(p)) for p in STEM_PREFIXES]
    return F.array_distinct(F.array_compact(F.array(*each)))


def stem_variants(key: Column) -> Column:
    """array<string>: the key, without a last vowel after a consonant, without a possessive ending, the head and tail of
    a hyphenated word, the rest behind a head of one letter, and the stems behind known beginnings."""
    head, tail = F.element_at(F.split(key, "-"), 1), F.element_at(F.split(key, "-"), -1)
    rest = F.regexp_extract(key, r"^[^-]-(.+)\z", 1)
    endings = [F.when(key.endswith(s) & (F.length(key) >= 4), F.left(key, F.length(key) - 2)) for s in ("ha", "hi", "hu", "he", "ho")]
    some = [
        key,
        F.when(key.rlike(r"^.+[^aeiou][aeiou]\z"), F.left(key, F.length(key) - 1)),
        *endings,
        F.when(key.contains("-") & (F.length(head) >= 2), head),
        F.when(key.contains("-") & (F.length(tail) >= 2), tail),
        F.when(rest != "", rest),
        F.when(rest != "", F.replace(rest, F.lit("-"), F.lit(""))),
    ]
    return F.concat(F.array_compact(F.array(*some)), prefix_stems(key))


def alternatives(lemma: Column) -> Column:
    """array<string>: a headword that lists spellings, parted at commas, semicolons and words for `or`."""
    return F.filter(F.transform(F.split(lemma, r"\s*(?:,|;| or | atau | ou )\s*"), lambda x: F.trim(x)), lambda x: x != "")


def lookup_keys(lemma: Column) -> Column:
    """array<string> of all keys to try, in order, each once."""
    spelled = F.flatten(F.transform(alternatives(lemma), variants))
    return F.filter(F.array_distinct(F.flatten(F.transform(spelled, lambda v: stem_variants(latin_key(v))))), lambda x: x != "")


def modern_kanji(c: Column, old: str = "", new: str = "") -> Column:
    """Old character forms to new by a table of two strings of equal length, given as a parameter."""
    return F.translate(c, old, new) if old else c


def gloss_tokens_en(text: Column) -> Column:
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[A-Za-z'\-]{3,}"), F.lit(0))
    return F.array_except(F.transform(found, lambda t: F.regexp_replace(F.lower(t), r"^[',.;:!?\"]+|[',.;:!?\"]+\z", "")), F.array(*map(F.lit, [*EN_STOP, ""])))


def gloss_tokens_ja(text: Column, single: list[str] | None = None, old: str = "", new: str = "") -> Column:
    """array<string>: runs of Japanese of two letters or more that aren't stop words, and single ones that are listed."""
    runs = F.regexp_extract_all(modern_kanji(F.coalesce(text, F.lit("")), old, new), F.lit("[一-鿿ぁ-ゖァ-ヺ]+"), F.lit(0))
    return F.array_distinct(F.filter(runs, lambda r: F.when(F.length(r) >= 2, ~r.isin(*JA_STOP)).otherwise(r.isin(single or []))))


def gloss_tokens(text: Column) -> Column:
    return F.array_union(gloss_tokens_en(text), gloss_tokens_ja(text))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all tokens of two sets; 0 where either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def kana_and_gloss(field: Column) -> Column:
    """struct(kana, gloss) of a field that runs a kana headword and its gloss together."""
    s = F.trim(F.coalesce(field, F.lit("")))
    rest = F.regexp_replace(F.regexp_replace(s, KANA_HEAD + r"[、,，\s]*", ""), r"^[ 、,，.。;:\t]+|[ 、,，.。;:\t]+\z", "")
    kana = F.regexp_extract(s, KANA_HEAD, 0)
    return F.struct(F.when(kana == "", s).otherwise(kana).alias("kana"), F.when(kana == "", F.lit("")).otherwise(rest).alias("gloss"))


def primary_gloss(text: Column, old: str = "", new: str = "") -> Column:
    """The first run that begins with a kanji or hiragana."""
    run = F.regexp_extract(modern_kanji(F.coalesce(text, F.lit("")), old, new), "[一-鿿ぁ-ゖ][一-鿿ぁ-ゖァ-ヺ・]*", 0)
    return F.regexp_replace(run, r"[・、,，.。 ]+\z", "")


def gloss_lookup_variants(primary: Column) -> Column:
    """array<string>: the gloss, without verbal endings, and its runs of kanji."""
    short = F.regexp_replace(primary, r"(?:する|スル|した|シタ|な|ナ|の|ノ|い|イ|ル)+\z", "")
    return F.array_distinct(F.filter(F.concat(F.array(primary, short), F.regexp_extract_all(primary, F.lit("[一-鿿]+"), F.lit(0))), lambda x: x != ""))


def brief_gloss(body: Column, most: int = 80) -> Column:
    """What follows the first part of speech up to a full stop or semicolon, else all; on one line, cut with dots."""
    m = F.regexp_extract(F.coalesce(body, F.lit("")), r"\b(?:n|v|vt|vi|v\.t|v\.i|adj|adv|conj|prep|interj|part|pron|a)\b\.?\s+(.+?)\s*[.;]", 1)
    text = F.trim(F.replace(F.when(m != "", m).otherwise(F.coalesce(body, F.lit(""))), F.lit("\n"), F.lit(" ")))
    return shorten(text, most)


def shorten(text: Column, most: int = 80) -> Column:
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most - 3)), F.lit("..."))).otherwise(text)


def edit1_keys(key: Column) -> Column:
    """array<string>: the key and all it gives by one deletion; two words within one edit share one of these."""
    cut = F.transform(F.sequence(F.lit(1), F.length(key)), lambda i: F.concat(F.substring(key, F.lit(1), i - 1), F.substring(key, i + 1, F.length(key))))
    return F.array_distinct(F.concat(F.array(key), F.when(F.length(key) > 0, cut).otherwise(F.array().cast("array<string>"))))


def substrings(key: Column, low: int = 4, high: int = 7) -> Column:
    """array<string>: all distinct substrings of these lengths."""
    def of(n: int) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.length(key) - n + 1), lambda i: F.substring(key, i, F.lit(n)))
        return F.when(F.length(key) >= n, cut).otherwise(F.array().cast("array<string>"))

    parts = [of(n) for n in range(low, high + 1)]
    return F.array_distinct(F.concat(*parts))


def glosses_cohere(ja_a: Column, ja_b: Column, en_a: Column, en_b: Column) -> Column:
    """Whether two rows' glosses (arrays) visibly agree: one Japanese gloss holds the other or shares a letter of the East
    Asian range with it, or the English ones share a content word."""
    east = lambda g: F.filter(F.split(g, ""), lambda c: F.ascii(c) > 0x2E80)
    stop = "to the a an of in on at for one's someone's be is are do does it その ~".split()
    words = lambda a: F.array_except(F.flatten(F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda g: F.transform(F.split(F.replace(F.lower(g), F.lit("~"), F.lit(" ")), r"\s+"), lambda w: F.regexp_replace(w, r"^[.,;()'\"\-]+|[.,;()'\"\-]+\z", "")))), F.array(*map(F.lit, [*stop, ""])))
    none = F.array().cast("array<string>")
    ja = F.exists(F.coalesce(ja_a, none), lambda x: F.exists(F.coalesce(ja_b, none), lambda y: (x != "") & (y != "") & (x.contains(y) | y.contains(x) | F.arrays_overlap(east(x), east(y)))))
    return F.coalesce(ja, F.lit(False)) | F.coalesce(F.arrays_overlap(words(en_a), words(en_b)), F.lit(False))


# Half-width katakana that stand for small ones; two-letter ones first.
HALF_WIDTH = [("ﾌﾟ", "ㇷ゚"), ("ｸ", "ㇰ"), ("ｼ", "ㇱ"), ("ｽ", "ㇲ"), ("ﾄ", "ㇳ"), ("ﾇ", "ㇴ"), ("ﾊ", "ㇵ"), ("ﾋ", "ㇶ"), ("ﾌ", "ㇷ"), ("ﾍ", "ㇸ"), ("ﾎ", "ㇹ"), ("ﾑ", "ㇺ"), ("ﾗ", "ㇻ"), ("ﾘ", "ㇼ"), ("ﾙ", "ㇽ"), ("ﾚ", "ㇾ"), ("ﾛ", "ㇿ")]


def small_kana(c: Column) -> Column:
    return _replaced(c, HALF_WIDTH)


def single_lemma(c: Column) -> Column:
    """Without a leading number with a bracket, and said once if said twice."""
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(c, r"^\d+\)[ʼ']*\s*", "")), r"^(\S+)\s+\1\z", "$1"))


def np_for_mp(c: Column) -> Column:
    return F.replace(c, F.lit("mp"), F.lit("np"))


# English words that are no headwords.
ENGLISH = (
    "the", "and", "of", "to", "in", "is", "for", "with", "from", "this", "that", "as", "an", "by", "or", "on", "at", "be", "are", "was", "were",
    "head", "hair", "body", "hand", "foot", "eye", "ear", "nose", "mouth", "see", "use", "name", "type", "var", "etc", "old", "new",
    "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "man", "woman", "child", "tree", "water", "fire", "wind",
)


def looks_english(word: Column) -> Column:
    return F.lower(word).isin(*ENGLISH)
