"""Column expressions for text cleaning and tokenisation.

Every function takes and returns a ``Column`` built from Spark built-ins, so
it stays inside whole-stage code generation; none of them is a Python UDF.
Regular expressions use ``(?U)`` where the source semantics are Unicode
(whitespace classes), because Java regex classes are ASCII-only by default.
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values that must equal the reference behaviour:
UNKNOWN_CATEGORY = "unknown_genre"   # filler for an empty genre list
MISSING_TEXT = "missing_description"  # text imputation constant
LIST_SEPARATOR = " | "                # separator of the joined unique values
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"  # runs of two or more word characters


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters Python's str.strip()/str.isspace() treat as
# whitespace, in code-point order.
UNICODE_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                      "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                      "\u2028\u2029\u202f\u205f\u3000")


def trim_unicode(c: ColumnOrName) -> Column:
    """Strip leading/trailing Unicode whitespace (tabs, NBSP included).

    ``F.trim`` only removes ASCII spaces, which is not what a Python
    ``str.strip`` does; ``btrim`` with the explicit set is a plain character
    scan (no regular expression).
    """
    c = _col(c)
    ws = list(UNICODE_WHITESPACE)
    # fast path: most values have no edge whitespace; two one-character
    # hash-set probes decide whether the (slower) trim scan is needed
    edge = F.substring(c, 1, 1).isin(ws) | F.substring(c, -1, 1).isin(ws)
    return F.when(edge, F.btrim(c, F.lit(UNICODE_WHITESPACE))).otherwise(c)


def trim_or_null(c: ColumnOrName) -> Column:
    """Trimmed text, NULL if nothing is left.

    The two probes of ``trim_unicode`` also find the empty text, so a value
    without white space at its edges (nearly all) is passed on untouched and
    no expression is made twice."""
    c = _col(c)
    ws = list(UNICODE_WHITESPACE)
    edge = F.substring(c, 1, 1).isin(["", *ws]) | F.substring(c, -1, 1).isin(ws)
    return F.when(edge, F.nullif(F.btrim(c, F.lit(UNICODE_WHITESPACE)), F.lit(""))).otherwise(c)


def short_key(c: ColumnOrName) -> Column:
    """A text to be told apart from others only: from 64 characters up its
    SHA-256 (64 hex digits), so that whole texts are not shuffled for that."""
    c = _col(c).cast("string")
    return F.when(F.length(c) < 64, c).otherwise(F.sha2(c, 256))


def blank_to_null(c: ColumnOrName) -> Column:
    """Whitespace-only strings become NULL; other values pass through."""
    c = _col(c)
    return F.when(trim_unicode(c) == "", F.lit(None).cast("string")).otherwise(c)


def to_double(c: ColumnOrName) -> Column:
    """Coerce to double; unparsable text and NaN become NULL (never raises).

    Text must look like a number: the cast alone also takes Java's type
    suffixes (``5d``, ``5f``)."""
    c = _col(c)
    # no text that looks like a number is a NaN
    return F.when(c.cast("string").rlike(NUMERIC_TEXT), c.try_cast("double"))


def nan_to_null(c: ColumnOrName) -> Column:
    """``to_double`` of a column that is a number already: no text is made."""
    d = _col(c).cast("double")
    return F.when(~F.isnan(d), d)


#: A decimal number, with exponent or not, or an infinity.
NUMERIC_TEXT = r"^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf(?:inity)?))\s*$"

#: An item of a plain list literal (a string without escapes, an integer or
#: a name), and the whole list.
_ITEM = r"""(?:'[^'\\\n]*+'|"[^"\\\n]*+"|None|True|False|-?(?:0|[1-9][0-9]*+)(?![0-9.eEjJxXoObB_]))"""
_GAP = r"[ \t\n\r\f]*+"
_LIST = rf"^{_GAP}\[{_GAP}(?:{_ITEM}{_GAP}(?:,{_GAP}{_ITEM}{_GAP})*+(?:,{_GAP})?+)?+\]{_GAP}$"


@functools.lru_cache(maxsize=None)
def _any_literal():
    """Items of any Python list literal as text; built when first used."""
    import ast
    import warnings

    def items(text: str) -> list[str]:
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                value = ast.literal_eval(text)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return []
        return [str(x) for x in value] if isinstance(value, list) else []

    @F.pandas_udf("array<string>")
    def parse(texts: pd.Series) -> pd.Series:
        return texts.map(items, na_action="ignore")

    return parse


def parse_list_literal(c: ColumnOrName) -> Column:
    """``"['Drama', 'Romance']"`` -> ``array('Drama', 'Romance')``.

    A Python list literal; items are read as text, trimmed, and blank ones
    dropped; NULL and anything else give an empty array.  Plain lists are
    parsed in the JVM.  Only a text with a bracket that is no plain list
    (escapes, adjacent strings, decimals, nested lists) goes to Python, in
    Arrow batches; the other rows of a batch are NULL there.
    """
    c = _col(c)
    plain = F.coalesce(c.rlike(_LIST), F.lit(False))
    raw = F.regexp_extract_all(c, F.lit(_ITEM), F.lit(0))
    bare = F.transform(raw, lambda x: F.when(F.substring(x, 1, 1).isin("'", '"'), F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(x))
    other = _any_literal()(F.when(~plain & F.contains(c, F.lit("[")), c))
    parsed = F.coalesce(F.when(plain, bare).otherwise(other), F.array().cast("array<string>"))
    return F.filter(F.transform(parsed, lambda x: trim_unicode(x)), lambda x: x.isNotNull() & (x != ""))


def tokens_text(arr: ColumnOrName) -> Column:
    """list -> ``"token_a token_b"``: lower, strip, inner spaces to ``_``."""
    return F.array_join(
        F.transform(_col(arr), lambda x: F.replace(trim_unicode(F.lower(x)), F.lit(" "), F.lit("_"))),
        " ",
    )


def unknown_category(c: ColumnOrName, filler: str = UNKNOWN_CATEGORY) -> Column:
    """Blank or NULL text becomes the explicit unknown category."""
    return F.coalesce(F.nullif(trim_unicode(c), F.lit("")), F.lit(filler))


def word_count(c: ColumnOrName) -> Column:
    """Number of whitespace-separated words (0 for empty text), as bigint."""
    return F.coalesce(F.regexp_count(_col(c), F.lit(r"(?U)\S+")), F.lit(0)).cast("bigint")


def char_count(c: ColumnOrName) -> Column:
    """Length in code points, as bigint."""
    return F.length(_col(c)).cast("bigint")


@functools.lru_cache(maxsize=None)
def english_stop_words() -> tuple[str, ...]:
    """Spark ML's built-in English stop-word list (read from the mllib jar).

    The same tuple is rendered into the DuckDB oracle SQL so both sides drop
    exactly the same words.
    """
    import pyspark

    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    for jar in jars:
        with zipfile.ZipFile(jar) as z:
            text = z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode("utf-8")
            return tuple(w for w in text.split() if w)
    from pyspark.ml.feature import StopWordsRemover  # needs an active context

    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def tokenize(c: ColumnOrName, stop_words: tuple[str, ...] | None = None) -> Column:
    """Lower-case, extract runs of >= 2 word characters, drop stop words.

    A membership test against a literal list is turned into a hash-set
    lookup (``InSet``) by the optimiser, so the cost per token is constant.
    """
    toks = F.regexp_extract_all(F.lower(_col(c)), F.lit(TOKEN_PATTERN), 0)
    stops = english_stop_words() if stop_words is None else stop_words
    if not stops:
        return toks
    return F.filter(toks, lambda t: ~t.isin(*stops))


def ngrams(arr: ColumnOrName, n: int) -> Column:
    """Contiguous n-grams of a token array, joined by single spaces."""
    a = _col(arr)
    if n == 1:
        return a
    if n == 2:
        m = F.greatest(F.size(a) - 1, F.lit(0))
        return F.zip_with(F.slice(a, 1, m), F.slice(a, 2, m), lambda x, y: F.concat_ws(" ", x, y))
    size = F.size(a)
    return F.when(size < n, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), size - n + 1),
            lambda i: F.array_join(F.slice(a, i, n), " "),
        )
    )


def ngram_range(arr: ColumnOrName, lo: int, hi: int) -> Column:
    """All n-grams for ``lo <= n <= hi`` (unigrams first, as in the source)."""
    parts = [ngrams(arr, n) for n in range(lo, hi + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def sql_string_list(values) -> str:
    """Render values as a SQL list literal body: ``'a', 'b'``."""
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)
