import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from emolens.llm import ngram_join
from emolens.llm.graph import components
from tests.llm.data import awkward, awkward_rows, empty, text

W = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(t):
    w = W.findall(t or "")
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if (rows[i][1] or "") == (rows[j][1] or "") or a and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[root(i)].append(d)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return sorted(((d, least[root(i)], links[i]) for i, (d, _) in enumerate(rows)), key=str)


def near_rows():
    """A group of many near copies, a chain and far texts."""
    rng = np.random.default_rng(0)
    base = text(50, 150).split()
    out = []
    for i in range(60):
        w = list(base)
        for k in rng.integers(0, 150, 2):
            w[k] = f"edit{i}_{k}"
        out.append((100 + i, " ".join(w)))
    step = text(60, 200).split()
    for i in range(6):
        out.append((300 + i, " ".join(step[i * 9:i * 9 + 120])))
    return out + [(400 + i, text(1000 + i, 80)) for i in range(20)]


@pytest.mark.parametrize("block", [256, 16, 1])
def test_matches_brute_force(spark, block):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.similarity_classes(docs, block=block).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(rows)


def test_awkward_rows(spark):
    docs = awkward(spark).withColumn("digest", F.lit(1)).withColumn("class_id", F.lit(1)).withColumn("vid", F.lit(1))
    got = ngram_join.similarity_classes(docs).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute([(i, t) for i, t, *_ in awkward_rows()])


def test_one_per_class(spark):
    docs = awkward(spark).withColumn("digest_", F.lit("x"))
    kept = ngram_join.one_per_class(docs)
    assert kept.schema == docs.schema
    classes = ngram_join.similarity_classes(docs).select("class_id").distinct().count()
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert len(ids) == classes and 2 not in ids and 6 not in ids and 17 not in ids and {1, 5, 16} <= set(ids)


def test_bands_meet_the_recall():
    for t in (0.5, 0.8, 0.9):
        b, r = ngram_join.choose_bands(t, 0.9999, 256)
        assert 1 - (1 - t ** r) ** b >= 0.9999 and b * r <= 256
    assert ngram_join.choose_bands() == (31, 6)


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 100), (7, 7), (60, 61), (62, 61)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {(i, 1) for i in range(2, 41)} | {(100, 50), (61, 60), (62, 60)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_empty_table(spark):
    assert ngram_join.similarity_classes(empty(spark)).count() == 0
    assert ngram_join.one_per_class(empty(spark)).count() == 0
