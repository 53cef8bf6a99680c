"""Quality rules as a bitmask ledger.

Every text is measured once (`measure`), every rule is evaluated once on the
measurements (`ledger`: one bit per failed rule next to the measurements).
Policies are versioned sets of rules: applying one is a bitwise test on the
ledger, and an ablation (what would be kept without a rule) is an aggregate
over the distinct bit patterns, of which there are at most 2^rules.

Cases: a null or blank text has no words and measures 0 everywhere; it fails
``few_words``.  Repeated rows are measured each.  A document's other columns
pass through unread.  A very long text is measured whole; memory follows the
longest text of a task, as one row is in memory anyway.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from emolens.llm.common import SPACES, WORD, free_name, map_in_arrow, text_chunks

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
            "n_repeat_words", "n_echo_words", "n_upper_words", "n_letter_words")
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A rule fails a document when ``fails`` is true of its measurements."""

    name: str
    bit: int
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


#: Bits are never reused: a ledger written earlier keeps its meaning.
RULES = (
    Rule("few_words", 0, "n_words < 10"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", 3, "2 * n_dup_lines > n_lines"),
    Rule("echoed_words", 4, "100 * n_echo_words > 30 * n_words"),
    Rule("upper_case", 5, "2 * n_upper_words > n_words"),
    Rule("few_letter_words", 6, "2 * n_letter_words <= n_words"),
    Rule("short_words", 7, "word_chars < 2 * n_words"),
    Rule("long_words", 8, "word_chars > 20 * n_words"),
)
BY_NAME = {r.name: r for r in RULES}

#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "duplicate_lines",
           "echoed_words", "upper_case", "few_letter_words", "short_words", "long_words"),
}


def policy_mask(policy: str | tuple[str, ...]) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    return sum(BY_NAME[n].mask for n in set(names))


_word, _letter = re.compile(WORD).findall, re.compile(r"[^\W\d_]").search


def _window_keys(ids: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each window of ``k`` words and its document."""
    n = len(ids) - k + 1
    key = doc[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(k):
        x = ids[j:j + n].astype(np.uint64) + np.uint64(1)
        x = (x ^ (x << np.uint64(31))) * np.uint64((0x9E3779B97F4A7C15 * (2 * j + 3)) & (2**64 - 1))
        key += x ^ (x >> np.uint64(29))
    return key


def _repeated(ids: np.ndarray, doc: np.ndarray, k: int = WINDOW) -> np.ndarray:
    """Marks words inside a window of ``k`` words that occurs twice or more
    in the same document.  Windows are sorted by a hash and equal neighbours
    compared word by word; a document with a clash is counted word for word."""
    covered = np.zeros(len(ids), bool)
    n = len(ids) - k + 1
    if n < 2:
        return covered
    key = _window_keys(ids, doc, k)
    at = np.flatnonzero(doc[:n] == doc[k - 1:])
    order = at[np.argsort(key[at], kind="stable")]
    same = key[order[1:]] == key[order[:-1]]
    a, b = order[:-1][same], order[1:][same]
    if not len(a):
        return covered
    equal = doc[a] == doc[b]
    for j in range(k):
        equal &= ids[a + j] == ids[b + j]
    hit = np.zeros(n, bool)
    hit[a[equal]] = hit[b[equal]] = True
    for d in set(doc[a[~equal]].tolist()) | set(doc[b[~equal]].tolist()):
        lo, hi = np.searchsorted(doc, [d, d + 1])
        own = ids[lo:hi].tolist()
        windows = [tuple(own[i:i + k]) for i in range(len(own) - k + 1)]
        seen = Counter(windows)
        hit[lo:lo + len(windows)] = [seen[w] > 1 for w in windows]
    for j in range(k):
        covered[j:j + n] |= hit
    return covered


def measure_texts(texts: list[str]) -> dict[str, np.ndarray]:
    """The measurements of each text."""
    words = [_word(t) for t in texts]
    count = np.array([len(w) for w in words], np.int64)
    flat = [w for one in words for w in one]
    n = len(texts)
    doc = np.repeat(np.arange(n), count)
    if flat:
        ids, unique = pd.factorize(np.array(flat, dtype=object))
    else:
        ids, unique = np.zeros(0, np.int64), np.zeros(0, object)
    per_word = lambda f: np.array([f(w) for w in unique], np.int64)[ids] if len(ids) else ids
    total = lambda v: np.bincount(doc, weights=v, minlength=n).astype(np.int64)
    echo = np.zeros(len(ids), bool)
    echo[1:] = (ids[1:] == ids[:-1]) & (doc[1:] == doc[:-1])
    lines = [[x for x in t.split("\n") if x.strip(SPACES)] for t in texts]
    n_lines = np.array([len(x) for x in lines], np.int64)
    return {
        "n_words": count,
        "word_chars": total(per_word(len)),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
        "n_lines": n_lines,
        "n_dup_lines": n_lines - np.array([len(set(x)) for x in lines], np.int64),
        "n_repeat_words": total(_repeated(ids, doc)),
        "n_echo_words": total(echo),
        "n_upper_words": total(per_word(lambda w: len(w) > 1 and w.isupper())),
        "n_letter_words": total(per_word(lambda w: _letter(w) is not None)),
    }


def _measured(batches: Iterator[pa.RecordBatch], text: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for rows, texts in text_chunks(batches, text):
        m = measure_texts(texts)
        struct = pa.StructArray.from_arrays([pa.array(m[c], pa.int64()) for c in MEASURES], list(MEASURES))
        yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), struct], [*keep, "m"])


def measure(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """The columns ``keep`` (default: all) and a struct of measurements under
    a free name, which is the second result."""
    keep = docs.columns if keep is None else keep
    name = free_name(keep, "measures")
    struct = StructType([StructField(c, LongType(), False) for c in MEASURES])
    fields = [docs.schema[c] for c in keep]
    schema = StructType([*fields, StructField("m" if "m" == name else name, struct, False)])
    slim = docs.select(*[f"`{c}`" for c in dict.fromkeys([*keep, text])])

    def run(batches):
        for b in _measured(batches, text, keep):
            yield b.rename_columns([*keep, name])

    return map_in_arrow(slim, run, schema), name


def failure_bits(prefix: str = "") -> Column:
    """One bit for every failed rule, from columns or struct fields."""
    out = F.lit(0).cast("long")
    for rule in RULES:
        test = re.sub(r"\b(n_\w+|word_chars)\b", lambda x: f"{prefix}{x[0]}", rule.fails)
        out = out.bitwiseOR(F.when(F.expr(test), F.lit(rule.mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def ledger(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, measurements, ``failure_bits``."""
    measured, m = measure(docs, text, [key])
    return measured.select(key, f"`{m}`.*").withColumn("failure_bits", failure_bits())


def apply_policy(led: DataFrame, policy: str | tuple[str, ...] = "v1", name: str = "kept") -> DataFrame:
    """The ledger with the policy's verdict."""
    return led.withColumn(name, F.col("failure_bits").bitwiseAND(F.lit(policy_mask(policy))) == 0)


def ablations(led: DataFrame, policy: str | tuple[str, ...] = "v1") -> DataFrame:
    """Per rule of a policy: documents that fail it, documents only it
    rejects, documents kept with and without it.

    The ledger is reduced to counts per bit pattern (map-side combined);
    the rest works on those few rows."""
    mask = policy_mask(policy)
    names = POLICIES[policy] if isinstance(policy, str) else policy
    patterns = led.groupBy(F.col("failure_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(BY_NAME[n].mask).cast("long").alias("mask"))
                      for n in sorted(set(names))])
    hit = F.col("bits").bitwiseAND(F.col("r.mask")) != 0
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return (patterns.select("bits", "n", F.explode(rules).alias("r"))
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(count(hit).alias("failed"), count(F.col("bits") == F.col("r.mask")).alias("rejected_only_by_it"),
                 count(F.col("bits") == 0).alias("kept"),
                 count(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.mask"))) == 0).alias("kept_without_it")))


def passing(docs: DataFrame, policy: str | tuple[str, ...] = "v1", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with their own columns."""
    measured, m = measure(docs, text)
    bits = failure_bits(f"`{m}`.")
    return measured.where(bits.bitwiseAND(F.lit(policy_mask(policy))) == 0).select(*[f"`{c}`" for c in docs.columns])
