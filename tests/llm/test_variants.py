import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from emolens.llm import variants
from tests.llm.data import DOC_SCHEMA, awkward, awkward_rows, empty

RUN = re.compile("[A-Za-zÀ-ÿ]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_vocabulary(docs):
    n = Counter()
    for i, t in docs:
        for w in RUN.findall(t or ""):
            w = w.translate(AZ)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute(vocab):
    """(word, form, root, n, n_near, form_n) per word."""
    near = {w: [v for v in vocab if one_edit(w, v)] for w in vocab}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best and vocab[best] >= 5 * vocab[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), vocab[form[w]] if form[w] else None) for w, n in vocab.items())


def found(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def rows():
    """Chains of forms, ties, words alike at either end, one edit of each kind."""
    words = {"compose": 700, "compos": 140, "conpos": 28, "conpis": 5, "xompose": 90, "composer": 6, "ccompose": 5,
             "straße": 50, "strasse": 9, "Straßen": 5, "école": 30, "écoles": 30, "ecoles": 6, "aaaaaa": 40, "aaaaaaa": 7, "aaaaaaaa": 5,
             "tiedab": 5, "tiedac": 25, "tiedad": 25, "z" * 3000 + "a" * 3000: 25, "z" * 2999 + "b" + "a" * 3000: 5, "abc": 90}
    said = [w for w, n in words.items() for _ in range(n)]
    random.Random(4).shuffle(said)
    return [(i, " ".join(said[i::40]), "en", "s", None) for i in range(40)]


def test_whole_operator_against_brute_force(spark):
    table = rows() + awkward_rows()
    table += [(900 + i, "Überall überall Ärger×÷Ärger under_score2words " * 3, "de", "s", 0) for i in range(3)]
    got = found(variants.spelling_variants(spark.createDataFrame(table, DOC_SCHEMA).repartition(3)))
    assert got == brute(brute_vocabulary([r[:2] for r in table]))
    by = {r[0]: r for r in got}
    assert by["conpis"][1:3] == ("conpos", "compose") and by["tiedab"][1] == "tiedac"


@pytest.mark.parametrize("limit", [3, 40, 8_000])
def test_partitions_of_any_size_give_the_same(spark, limit):
    """Words over few letters, most with one beginning: split again and again."""
    r = random.Random(1)
    vocab = {("aaab" if r.random() < .6 else "") + "".join(r.choices("ab", k=r.randint(3, 5))) + r.choice(["", "aaab"]): r.randint(5, 300)
             for _ in range(700)}
    vocab = {w: n for w, n in vocab.items() if len(w) >= 6}
    df = spark.createDataFrame([*vocab.items()], "word string, n long").repartition(4)
    got = found(variants.with_roots(variants.near_words(df, limit=limit)))
    assert got == brute(vocab)


def test_no_partition_exceeds_the_bound(spark):
    df = spark.createDataFrame([(f"same{i:06d}", 5) for i in range(500)], "word string, n long")
    sizes = variants.partitions(df, limit=50).groupBy("part").count().agg(F.max("count")).first()[0]
    assert sizes <= 50


def test_pairs_of_the_composition():
    r = random.Random(2)
    words = sorted({"".join(r.choices("abé", k=r.randint(1, 6))) for _ in range(250)})
    got = [tuple(sorted(p)) for p in variants.near_pairs(words)]
    assert len(got) == len(set(got))
    assert set(got) == {(u, v) for u in words for v in words if u < v and one_edit(u, v)}
    first = lambda u, v: next((i for i, (a, b) in enumerate(zip(u, v)) if a != b), min(len(u), len(v)))
    assert {tuple(sorted(p)) for p in variants.near_pairs(words, 1, 2)} == {p for p in set(got) if 1 <= first(*p) <= 2}


def test_acceptor_is_minimal():
    """States are as many as there are different futures."""
    words = ["walking", "talking", "walked", "talked", "walk", "talk"]
    a = variants.Acceptor(words)
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    futures = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes}
    assert len(a.next) == len(futures)


def test_clashing_columns_take_no_part(spark):
    table = rows()
    df = spark.createDataFrame(table, DOC_SCHEMA).withColumns({c: F.lit("x") for c in ("id", "run", "word", "n", "a.b")})
    assert found(variants.spelling_variants(df)) == brute(brute_vocabulary([r[:2] for r in table]))


def test_empty_tables(spark):
    assert variants.spelling_variants(empty(spark)).count() == 0
    assert variants.spelling_variants(awkward(spark).where("doc_id = 10")).count() == 0
