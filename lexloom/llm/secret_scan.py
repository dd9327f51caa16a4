"""Secret scans with native expressions only: candidates by pattern, false positives removed by a random forest.

A candidate is a private key block, a password in a URL, the value of a secret's name (`NAME=value`, `name: "value"`,
`"name": "value"`, however spaced), a token of a known form, or a long run of token characters with a digit in it. Each
has features of itself (length, kinds of characters, transitions between kinds and between letters, distinct characters,
entropy, coverage by dictionary words, placeholders, known forms) and of its place (path, URL, assignment, quotes,
neighbouring words). A random forest (pyspark.ml) learns from labelled findings; its trees become one literal array that a
column expression walks, so scanning is a projection: no shuffle, no Python on executors.

The dictionary is a parameter: any words; `vocabulary_words` takes those of a public vocabulary file. They become a Bloom
filter and a table of log odds of neighbouring letters, literals of fixed size.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.bpe_fst import _bytes
from lexloom.llm.tables import discard, keep

# Java regular expressions. No part of them looks back or ahead over text that it could meet again, so scans are linear.
#: A secret's name, whatever is before it; the end of the name, a closing quote, a sign of assignment, an opening quote.
NAMED = r"(?i:password|passwd|passphrase|pwd|secret|api[_-]?key|access[_-]?key|private[_-]?key|auth[_-]?key|token|credentials?)[A-Za-z0-9_]{0,40}+[\"']?\s{0,40}+(?::=|=>|[:=])\s{0,40}+[\"']?"
VALUE = r"[^\s\"'<>;,&]{5,}[^\s\"'<>;,&.)}\]]"
#: A URL up to its user's password, and the password.
URL = r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,20}+://[^\s:/@\"']{0,60}+:"
URL_VALUE = r"[^\s@\"'/]{4,}(?=@)"
#: The forms of well-known tokens, with a digit or not.
FORM = r"(?:(?:AKIA|ASIA)[A-Z0-9]{12,}+|(?:gh[pousr]_|github_pat_|xox[baprs]-|sk-|sk_live_|rk_live_|AIza|glpat-|npm_|hf_)[A-Za-z0-9_-]{12,}+|eyJ[A-Za-z0-9_-]{10,}+(?:\.[A-Za-z0-9_-]{6,}+){1,2})"
#: A private key with its headers.
BLOCK = r"-----BEGIN [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----[^-]*+(?:-(?!----END)[^-]*+){0,400}+-----END [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
#: A run of token characters with a digit, of any length, that isn't itself the name of a value; '=' only at its end.
RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+(?![\"']?=[\"']?[^\s\"'=]{6})={0,2}"
CANDIDATE = f"{BLOCK}|{URL}{URL_VALUE}|{NAMED}{VALUE}|(?<![A-Za-z0-9_]){FORM}|{RUN}"
#: What of a match stands before the candidate and isn't part of it.
HEAD = rf"^(?:{URL}(?=[^\s@\"'/]{{4}})|{NAMED}(?=[^\s\"'=]{{4}}))"
#: Characters before and after a candidate that are looked at.
NEAR = 60
MASK = "[SECRET]"
TREES, DEPTH, SEED = 24, 8, 2
#: Labelled findings made by labelled_findings(); bits of the dictionary's Bloom filter.
FINDINGS, BITS = 9000, 1 << 18

#: Words that the rule for findings builds names from (and the dictionary, if none is given), words that name secrets, and
#: words that name harmless codes.
DICTIONARY = "about access account admin after application archive backup client cluster common config connection content control count create data default delete demo document download east element error example export feature field file filter format function global group header image import index input instance internal item label language layer length level library link list local location login main manager master matrix message method model module name network node number object option order output package page parameter partition path plugin point policy production profile project property query record region release report request resource response result review sample schema script search section server service session setting share simple source stage start status storage stream string structure style system table target template test text time title tracker type unique update user value version view west window worker".split()
SECRET_WORDS = "token secret password passwd passphrase pwd apikey api_key api-key access_key private credential credentials auth authorization bearer".split()
HARMLESS_WORDS = "commit sha sha1 sha256 md5 checksum digest hash etag uuid guid isbn order invoice phone tel card account version revision build id ref page path file href src image img cite doi version serial".split()
PLACEHOLDER = r"(?i)x{4,}|example|your|dummy|change|placeholder|sample|test|\*{3,}|1234|0{5,}|abcdef"

NAMES = ["length", "digits", "upper", "lower", "signs", "class_changes", "transitions", "distinct", "entropy", "dictionary", "hex", "all_digits", "form", "placeholder", "in_path", "url_user", "assigned", "quoted", "secret_word", "harmless_word", "uuid", "words_before"]


def vocabulary_words(path: str) -> list[str]:
    """The words of a public .tiktoken vocabulary: tokens of four small letters or more that begin with a space."""
    tokens = (base64.b64decode(line.split()[0]) for line in _bytes(path).splitlines() if line.strip())
    return sorted(t[1:].decode() for t in tokens if re.fullmatch(rb" [a-z]{4,}", t))


def lexicon(words: Iterable[str]) -> dict:
    """bits: a Bloom filter (two bits a word); pairs: log odds of a small letter after another, against even chance."""
    bits, pairs = np.zeros(BITS, bool), np.ones((26, 26))
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=42)  # as the engine's xxhash64 of one string
        bits[[h % BITS, (h >> 32) % BITS]] = True
        small = [ord(c) - 97 for c in w if "a" <= c <= "z"]
        for a, b in zip(small, small[1:], strict=False):
            pairs[a, b] += 1
    odds = np.log(pairs / pairs.sum(1, keepdims=True) * 26)
    return {"bits": np.packbits(bits, bitorder="little").view("<i8").tolist(), "pairs": odds.round(4).ravel().tolist()}


def _one(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0)


def features(cand: Column, before: Column, after: Column, known: str) -> Column:
    """array<double> of NAMES; works on columns and inside higher-order functions. `known` is a lexicon as JSON."""
    n = F.greatest(F.length(cand), F.lit(1)).cast("double")
    kinds = lambda p: F.regexp_count(cand, F.lit(p)) / n
    chars = F.split(cand, "")
    shares = F.transform(F.array_distinct(chars), lambda ch: F.size(F.filter(chars, lambda x: x == ch)) / n)
    near = F.lower(F.right(before, F.lit(40)))
    low = F.lower(cand)
    held = json.loads(known)
    bits, odds = F.from_json(F.lit(json.dumps(held["bits"])), "array<bigint>"), F.from_json(F.lit(json.dumps(held["pairs"])), "array<double>")
    has = lambda at: F.getbit(F.get(bits, (at / 64).cast("int")), (at % 64).cast("int")) == 1
    mask = F.lit(BITS - 1).cast("long")
    in_dictionary = lambda h: has(h.bitwiseAND(mask)) & has(F.shiftright(h, 32).bitwiseAND(mask))
    parts = F.regexp_extract_all(cand, F.lit(r"[A-Z]?[a-z]{3,}|[A-Z]{4,}"), F.lit(0))
    covered = F.aggregate(parts, F.lit(0), lambda s, w: s + F.when(in_dictionary(F.xxhash64(F.lower(w))), F.length(w)).otherwise(0))
    pairs = F.regexp_extract_all(low, F.lit("(?=([a-z]{2}))"), F.lit(1))
    likely = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.coalesce(F.get(odds, (F.ascii(p) - 97) * 26 + F.ascii(F.right(p, F.lit(1))) - 97), F.lit(0.0)))
    values = [
        n,
        kinds("[0-9]"), kinds("[A-Z]"), kinds("[a-z]"), kinds("[^A-Za-z0-9]"),
        kinds("[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])|[^A-Za-z0-9](?=[A-Za-z0-9])"),
        likely / F.greatest(F.size(pairs), F.lit(1)),
        F.size(F.array_distinct(chars)) / n,
        -F.aggregate(shares, F.lit(0.0), lambda s, p: s + p * F.log2(p)),
        covered / n,
        _one(cand.rlike("^(0x)?[0-9a-fA-F]+$")), _one(cand.rlike("^[0-9_=/+-]+$")),
        _one(cand.rlike(f"^(?:{FORM}|-----BEGIN)")), _one(cand.rlike(PLACEHOLDER)),
        _one(before.rlike(r"[/\\.][A-Za-z0-9_.-]*$|https?:\S*$|\S/\S*$") | cand.rlike("/.*/.*/")),
        _one(before.rlike(r"://[^\s:/@]*:$") & after.rlike("^@")),
        _one(before.rlike(r"[A-Za-z0-9_)\]\"']\s{0,40}(=|:|=>|:=)\s{0,40}[\"']?$")),
        _one(before.rlike("[\"']$") & after.rlike("^[\"']")),
        _one(near.rlike(rf"({'|'.join(SECRET_WORDS)})[a-z0-9_]*[^a-z0-9]{{0,40}}$")),
        _one(near.rlike(rf"(^|[^a-z])({'|'.join(HARMLESS_WORDS)})([^a-z][^a-z]{{0,5}}|\s+[a-z]+\s+)$")),
        _one(cand.rlike("^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$")),
        F.regexp_count(before, F.lit(r"[A-Za-z]{3,}")).cast("double"),
    ]
    return F.array(*[v.cast("double") for v in values])


def _pick(seed: int, values: list[str], salt: str = "") -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), "id"), F.lit(len(values))) + 1).cast("int"))


def labelled_findings(spark: SparkSession, n: int = FINDINGS) -> DataFrame:
    """before, candidate, after, label: findings made by rule, half secrets and half look-alikes (digests, ids, paths,
    numbers, placeholders, compound names), in the words and assignments that such strings stand in. They stand for a
    reviewed table of findings, which fit() takes just as well; the tables at hand have none."""
    hexes = F.concat(F.sha2(F.concat(F.lit("a"), F.col("id")), 256), F.sha2(F.concat(F.lit("b"), F.col("id")), 256))
    b64 = F.translate(F.regexp_replace(F.base64(F.unhex(hexes)), r"[\r\n]", ""), "+/", "Qz")
    cut = lambda c, k: F.substring(c, 1, k)
    digits = F.substring(F.regexp_replace(hexes, "[^0-9]", ""), 1, 30)
    upper = F.upper(F.regexp_replace(b64, "[^A-Za-z0-9]", "K"))
    two = lambda s: F.concat_ws("_", _pick(s, DICTIONARY), _pick(s + 1, DICTIONARY), _pick(s + 2, DICTIONARY), F.substring(digits, 1, 2))
    secret_name = F.concat(_pick(3, ["", "", "my_", "db_", "prod_", "user.", "export ", "{\"", "AWS_"]), _pick(4, ["token", "secret", "password", "api_key", "access_key", "auth_token", "client_secret", "TOKEN", "API_KEY", "SECRET_ACCESS_KEY", "apiKey", "token_2"]))
    assign = _pick(5, [" = \"", "=\"", ": \"", " = '", "=", ": ", ":", " := \"", "\": \"", "\": \"", "   = ", "    : \"", "=>'"])
    letters = F.translate(b64, "0123456789", "kLmNpQrStV")
    real = [w for w in DICTIONARY if not re.search(PLACEHOLDER, w)]
    pass_words = F.concat(_pick(16, real), F.substring(digits, 3, 2), _pick(17, ["", "!", "#", "$"]), _pick(18, real), _pick(19, ["!", "", "9", "?"]))
    words = F.concat_ws(" ", *[_pick(20 + i, [*DICTIONARY, "the", "and", "of", "for", "in", "le", "der", "el", "thing", "once", "ander"]) for i in range(4)])
    harmless = _pick(6, ["commit ", "sha256: ", "sha1 = ", "md5 ", "checksum: ", "etag \"", "uuid ", "id: ", "id=", "order ", "version ", "call ", "", "", "see ", "ref ", "card ", "phone "])
    place = _pick(7, ["https://host/", "/usr/lib/", "path: /data/", "src=\"/img/", "./build/", "docs/"])
    uuid = F.concat_ws("-", F.substring(hexes, 1, 8), F.substring(hexes, 9, 4), F.substring(hexes, 13, 4), F.substring(hexes, 17, 4), F.substring(hexes, 21, 12))
    fake = F.concat(_pick(8, ["your", "my", "example", "test", "sample", "dummy", "changeme", "placeholder", "replace_me", "xxxxxxxx", "insert"]), _pick(26, ["_", "-", "", "."]), _pick(27, ["api_key", "token", "secret", "password", "key", "value", "xxxxxxxx", "access"]), _pick(28, ["_here", "_1234", "123456", "-000000000", "", "_xxxx", "1234567890"]))
    fake = F.when(fake.rlike(PLACEHOLDER), fake).otherwise(F.concat(F.lit("your_"), fake))
    kinds = [  # (label, before, candidate, after)
        (1, F.concat(secret_name, assign), cut(hexes, 40), 1), (1, F.concat(secret_name, assign), cut(hexes, 32), 1), (1, F.concat(secret_name, assign), cut(b64, 40), 1),
        (1, F.concat(secret_name, assign), F.concat(F.lit("ghp_"), cut(b64, 36)), 1), (1, _pick(9, ["key ", "use ", "id = \"", "with ", ""]), F.concat(F.lit("AKIA"), cut(upper, 16)), 0),
        (1, F.concat(secret_name, assign), F.concat(F.lit("sk-"), cut(b64, 48)), 1), (1, _pick(9, ["Authorization: Bearer ", "bearer ", "auth ", "curl -H token:"]), F.concat(F.lit("eyJ"), cut(b64, 60)), 0),
        (1, F.concat(_pick(11, ["password", "passwd", "pwd", "secret"]), assign), F.concat(cut(b64, 7), F.lit("!9"), F.substring(b64, 20, 4)), 1), (1, F.concat(secret_name, assign), cut(hexes, 64), 1),
        (1, F.concat(secret_name, assign), F.concat(F.lit("xoxb-"), cut(digits, 11), F.lit("-"), cut(b64, 24)), 1),
        (1, F.concat(secret_name, assign), cut(letters, 20), 1), (1, F.concat(secret_name, assign), pass_words, 1), (1, _pick(9, ["key ", "use ", "id = \"", "with ", ""]), F.concat(F.lit("ghp_"), cut(letters, 36)), 0),
        (1, F.concat(_pick(8, ["postgres", "mysql", "redis", "amqp", "https", "mongodb+srv"]), F.lit("://"), _pick(7, ["admin", "root", "app", "", "user"]), F.lit(":")), F.concat(cut(b64, 6), F.substring(digits, 1, 2)), 2),
        (1, _pick(9, ["", "key: ", "is "]), F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,"), F.upper(cut(hexes, 32)), F.lit("\n\n"), b64, F.lit("\n-----END RSA PRIVATE KEY-----")), 0),
        (0, F.concat(_pick(14, ["password", "token", "secret", "credentials"]), _pick(10, [": ", " = ", ":", "=", " := "])), _pick(15, [w for w in DICTIONARY if len(w) >= 6]), 0), (0, F.concat(_pick(14, ["token", "secret", "auth_token"]), _pick(10, [": ", " = ", "="])), F.concat(_pick(15, DICTIONARY), F.lit("."), _pick(16, DICTIONARY), F.lit("_"), _pick(17, DICTIONARY)), 0),
        (0, F.concat(_pick(8, ["https", "ftp", "mysql"]), F.lit("://"), _pick(7, ["user", "username", "me"]), F.lit(":")), _pick(13, ["password", "<password>", "${PASSWORD}", "your_password", "xxxxxxxx"]), 2),
        (0, harmless, cut(hexes, 40), 0), (0, harmless, cut(hexes, 64), 0), (0, harmless, uuid, 0), (0, harmless, cut(digits, 16), 0), (0, place, two(12), 0),
        (0, F.lit(""), two(13), 0), *[(0, F.concat(secret_name, assign), fake, 1)] * 3, (0, place, cut(hexes, 32), 0), (0, F.lit("data:image/png;base64,"), F.concat(F.lit("iVBORw0KGgo"), cut(b64, 80)), 0),
        (0, F.concat(_pick(14, ["password", "token", "secret"]), assign), _pick(15, ["required", "string;", "process.env.VALUE", "get_password()", "os.environ", "<redacted>", "${SECRET}", "None,"]), 1),
    ]
    parts = None
    for i, (label, before, cand, quoted) in enumerate(kinds):
        at = F.concat(words, F.lit(" "), before)
        end = F.when(at.rlike("\"$"), "\"").when(at.rlike("'$"), "'").otherwise("") if quoted == 1 else F.lit("@host/" if quoted else "")
        rows = spark.range(i, n, len(kinds)).select(at.alias("before"), cand.alias("candidate"), F.concat(end, F.lit(" "), _pick(40, DICTIONARY)).alias("after"), F.lit(float(label)).alias("label"))
        parts = rows if parts is None else parts.unionByName(rows)
    return keep(parts.coalesce(2), "findings")


def _trees(model) -> list:
    """The forest: for each tree its nodes (feature or -1, border, left, right, prediction), the root first."""
    forest = []
    for text in re.split(r"\n\s*Tree \d+ \(weight [^)]*\):\n", model.toDebugString)[1:]:
        lines, nodes = [x.strip() for x in text.strip().split("\n")], []

        def read(at: int) -> tuple[int, int]:
            mine = len(nodes)
            nodes.append(None)
            if lines[at].startswith("Predict"):
                nodes[mine] = [-1, 0.0, mine, mine, float(lines[at].split(":")[1])]
                return mine, at + 1
            feature, border = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at]).groups()
            left, at = read(at + 1)
            right, at = read(at + 1)  # past the line of Else
            nodes[mine] = [int(feature), float(border), left, right, 0.0]
            return mine, at

        read(0)
        forest.append(nodes)
    return [[{"f": f, "t": t, "l": a, "r": b, "p": p} for f, t, a, b, p in nodes] for nodes in forest]


def fit(findings: DataFrame, words: Iterable[str] | None = None, trees: int = TREES, depth: int = DEPTH) -> str:
    """The model (forest and lexicon) learnt from labelled findings (before, candidate, after, label of 0 or 1), as JSON of
    bounded size. Each finding is learnt as the scan cuts it: by the candidate that holds most of it, or as it stands
    where the scan finds none. Findings come from a review of scans (any table of these columns) or labelled_findings."""
    held = lexicon(words or DICTIONARY)
    start, end = F.length("before"), F.length("before") + F.length("candidate")
    places = F.transform(_near(F.concat("before", "candidate", "after")), lambda x: F.struct((F.least(end, x["start"] + F.length(x["candidate"])) - F.greatest(start, x["start"])).alias("common"), x["candidate"].alias("candidate"), x["before"].alias("before"), x["after"].alias("after")))
    own = F.struct(F.lit(0).alias("common"), "candidate", F.right("before", F.lit(NEAR)).alias("before"), F.left("after", F.lit(NEAR)).alias("after"))
    cut = findings.select(F.array_max(F.concat(F.filter(places, lambda x: x["common"] > 0), F.array(own))).alias("c"), F.col("label").cast("double").alias("label"))
    rows = cut.select(array_to_vector(features(F.col("c.candidate"), F.col("c.before"), F.col("c.after"), json.dumps(held))).alias("features"), "label")
    known = keep(rows, "features")
    forest = _trees(RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, maxBins=64, subsamplingRate=0.8, featureSubsetStrategy="onethird").fit(known))
    discard(known)
    return json.dumps({"forest": forest, "lexicon": held})


def forest_score(values: Column, model: str, depth: int = DEPTH) -> Column:
    """The mean of the trees' shares of secrets."""
    trees = F.from_json(F.lit(json.dumps(json.loads(model)["forest"])), "array<array<struct<f:int,t:double,l:int,r:int,p:double>>>")

    def vote(tree: Column) -> Column:
        node = lambda i: F.get(tree, i)
        step = lambda at, _: F.when(node(at)["f"] < 0, at).when(F.get(values, node(at)["f"]) <= node(at)["t"], node(at)["l"]).otherwise(node(at)["r"])
        return node(F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step))["p"]

    return F.aggregate(trees, F.lit(0.0), lambda s, tree: s + vote(tree)) / F.size(trees)


def has_candidate(text: Column) -> Column:
    return text.rlike(CANDIDATE)


def _between(text: Column) -> tuple[Column, Column]:
    """The pieces of the text between matches, and for each match what stands before and after it, and its head, in order."""
    pieces, found = F.split(text, CANDIDATE, -1), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    after = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    # each match between its neighbouring pieces, without looking the pieces up again for each one
    heads = F.transform(found, lambda m: F.struct(m.alias("match"), F.regexp_extract(m, HEAD, 0).alias("head")))
    cut = F.transform(heads, lambda x: F.struct(x["head"].alias("head"), F.right(x["match"], F.length(x["match"]) - F.length(x["head"])).alias("candidate")))
    near = F.zip_with(cut, F.slice(pieces, 1, F.size(cut)), lambda x, p: F.struct(x["head"].alias("head"), x["candidate"].alias("candidate"), F.right(F.concat(F.right(p, F.lit(NEAR)), x["head"]), F.lit(NEAR)).alias("before"), F.length(p).alias("gap")))
    return pieces, F.zip_with(near, after, lambda x, a: x.withField("after", F.left(a, F.lit(NEAR))))


def _near(text: Column) -> Column:
    """The candidates of a text in order, each with its first letter's place (from 0) and what stands around it."""
    _, near = _between(text)
    long = F.transform(near, lambda x: x["gap"] + F.length(x["head"]) + F.length(x["candidate"]))
    return F.transform(near, lambda x, i: x.withField("start", F.aggregate(F.slice(long, 1, i), F.lit(0), lambda s, n: s + n) + x["gap"] + F.length(x["head"])))


def _scan(text: Column, model: str) -> tuple[Column, Column]:
    """The pieces of the text between matches, and the matches with their scores, in order."""
    known = json.dumps(json.loads(model)["lexicon"])
    pieces, near = _between(text)
    told = F.transform(near, lambda x: x.withField("values", features(x["candidate"], x["before"], x["after"], known)))
    return pieces, F.transform(told, lambda x: F.struct(x["head"].alias("head"), x["candidate"].alias("candidate"), x["before"].alias("before"), x["after"].alias("after"), forest_score(x["values"], model).alias("score")))


def findings(df: DataFrame, model: str, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """key, nth (candidate of its text, from 0), candidate, before, after, score, is_secret: one row for each candidate of
    each whole text. Null and empty texts have none; repeated rows each have theirs; other columns aren't read; an empty
    table gives an empty result."""
    _, scored = _scan(F.col("__t"), model)
    rows = df.select(F.col(key), F.col(text).alias("__t")).filter(has_candidate(F.col("__t")))
    rows = rows.select(key, F.posexplode(scored).alias("nth", "c"))
    return rows.select(key, "nth", "c.candidate", "c.before", "c.after", "c.score", (F.col("c.score") >= threshold).alias("is_secret"))


def redact(df: DataFrame, model: str, text: str = "text", threshold: float = 0.5, mask: str = MASK) -> DataFrame:
    """df with each secret in `text` replaced by the mask; all rows and columns stay, whatever they are called; null and
    empty texts and an empty table stay as they are."""
    t = F.col(text)
    pieces, scored = _scan(t, model)
    shown = F.transform(scored, lambda c: F.concat(c["head"], F.when(c["score"] >= threshold, F.lit(mask)).otherwise(c["candidate"])))
    whole = F.array_join(F.flatten(F.zip_with(pieces, shown, lambda p, c: F.array(p, F.coalesce(c, F.lit(""))))), "")
    return df.withColumn(text, F.when(has_candidate(t), whole).otherwise(t))
