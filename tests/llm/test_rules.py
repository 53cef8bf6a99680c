import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from emolens.llm import rules
from tests.llm.data import awkward, awkward_rows, empty

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    t = t or ""
    w = W.findall(t)
    win = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + j for i in range(len(w) - 4) if win[tuple(w[i:i + 5])] > 1 for j in range(5)}
    lines = [x for x in t.split("\n") if W.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "n_echo_words": sum(a == b for a, b in zip(w, w[1:])), "n_upper_words": sum(len(x) > 1 and x.isupper() for x in w),
            "n_letter_words": sum(any(c.isalpha() for c in x) for x in w)}


def test_ledger_matches_brute_force(spark):
    got = Counter((r.doc_id, *(r[m] for m in rules.MEASURES)) for r in rules.ledger(awkward(spark)).collect())
    assert got == Counter((i, *(brute(t)[m] for m in rules.MEASURES)) for i, t, *_ in awkward_rows())


def test_hash_clash_is_counted_word_for_word(monkeypatch):
    monkeypatch.setattr(rules, "_window_keys", lambda ids, doc, k: np.zeros(len(ids) - k + 1, np.uint64))
    ids = np.array([1, 2, 3, 4, 5, 6, 1, 2, 3, 4, 5], np.int64)
    marks = rules._repeated(ids, np.zeros(11, np.int64))
    assert marks.tolist() == [True] * 5 + [False] + [True] * 5


def test_policies_and_ablations(spark):
    led = rules.ledger(awkward(spark)).cache()
    kept = {r.doc_id for r in rules.apply_policy(led).where("kept").collect()}
    assert {1, 3, 4, 5, 12, 16, 19} <= kept and not kept & {7, 8, 9, 10, 14, 15}
    bits = [r.failure_bits for r in led.collect()]
    mask = rules.policy_mask("v1")
    for r in rules.ablations(led).collect():
        m = rules.BY_NAME[r.rule].mask
        assert r.failed == sum(bool(b & m) for b in bits)
        assert r.rejected_only_by_it == sum(b & mask == m for b in bits)
        assert r.kept == sum(b & mask == 0 for b in bits)
        assert r.kept_without_it == r.kept + r.rejected_only_by_it


def test_passing_keeps_columns_even_with_clashing_names(spark):
    docs = awkward(spark).withColumn("measures", F.lit(1)).withColumn("failure_bits", F.lit("x")).withColumn("n_words", F.lit(-1))
    out = rules.passing(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    assert out.where("n_words = -1").count() == out.count() > 0


def test_empty_table(spark):
    assert rules.ledger(empty(spark)).count() == 0
    assert rules.passing(empty(spark)).count() == 0
    assert rules.ablations(rules.ledger(empty(spark))).count() == 0
