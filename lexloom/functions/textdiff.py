"""Alignments of two texts and Unicode forms that no built-in expression has: pandas UDFs on Arrow batches."""

from __future__ import annotations

import difflib
import html
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions.textclean import SMALL_KANA


@F.pandas_udf(T.StringType())
def unified_diff(a: pd.Series, b: pd.Series) -> pd.Series:
    """Line by line, as a patch; empty if equal. Null is the empty text."""
    return pd.Series(["\n".join(difflib.unified_diff((x or "").splitlines(), (y or "").splitlines(), "a", "b", lineterm="")) for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.ArrayType(T.StringType()))
def word_diff(a: pd.Series, b: pd.Series) -> pd.Series:
    """Words with `- `, `+ ` or two spaces before them."""
    return pd.Series([[w for w in difflib.ndiff((x or "").split(), (y or "").split()) if w[0] != "?"] for x, y in zip(a, b, strict=True)])


def _restore(text: str, model: str) -> str:
    small = dict(zip(*SMALL_KANA, strict=True))
    out = []
    for tag, i, j, k, m in difflib.SequenceMatcher(None, text, model, autojunk=False).get_opcodes():
        part, other = text[i:j], model[k:m]
        same_length = tag == "replace" and len(part) == len(other)
        out.append("".join(o if small.get(p) == o else p for p, o in zip(part, other, strict=True)) if same_length else part)
    return "".join(out)


@F.pandas_udf(T.StringType())
def restore_small_kana(text: pd.Series, model: pd.Series) -> pd.Series:
    """The text with small kana where an aligned model has the small form of a large one; nothing else changes."""
    return pd.Series([None if t is None else _restore(t, m or "") for t, m in zip(text, model, strict=True)])


@F.pandas_udf(T.StringType())
def compatibility_key(text: pd.Series) -> pd.Series:
    """A sort key: compatibility composition in lower case."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).lower())


@F.pandas_udf(T.StringType())
def ascii_only(text: pd.Series) -> pd.Series:
    """Compatibility decomposition, what is not ASCII dropped: exact for all scripts."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


@F.pandas_udf(T.StringType())
def unescape_html(text: pd.Series) -> pd.Series:
    """All named and numbered entities."""
    return text.map(lambda t: None if t is None else html.unescape(t))
