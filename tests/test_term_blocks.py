"""TF-IDF in blocks: the same features as a count by hand, and no row per
(document, term) on disk."""

import math
import os
import time
from collections import Counter, defaultdict
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from emolens.operators import features as X
from emolens.operators.term_blocks import TextBlocks, TextFeatures, parts_of, vocabulary_rows
from emolens.session import cut_lineage, ensure_checkpoint_dir

WORDS = ["amber", "brook", "cedar", "delta", "ember", "fjord", "grove", "heath", "éclair", "straße"]


def text(i):
    return " ".join(WORDS[(i * j * j + j) % len(WORDS)] for j in range(1, 3 + i % 9))


def rows():
    out = [(f"d{i}", text(i), "AB"[i % 2]) for i in range(60)]
    return [*out, ("d3", "amber zebra", "C"), ("d60", None, "A"), ("d61", "", "A")]


def grams(t):
    w = ("missing_description" if t is None else t).split()
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def by_hand(known, given):
    """TF-IDF of ``given`` with the vocabulary of ``known``; rows of a key count together."""
    def counted(rs):
        tf = defaultdict(Counter)
        for d, t, *_ in rs:
            tf[d].update(grams(t))
        return tf

    df = Counter(t for c in counted(known).values() for t in c)
    n = len(known)
    idf = {t: math.log((1 + n) / (1 + x)) + 1 for t, x in df.items() if 2 <= x <= 0.95 * n}
    out = {}
    for d, c in counted(given).items():
        w = {t: (1 + math.log(x)) * idf[t] for t, x in c.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out |= {(d, "0:" + t): x / norm for t, x in w.items()}
    return out


def frame(spark, rs):
    return spark.createDataFrame(rs, "doc string, Description string, emotion string").repartition(4)


def as_dict(df):
    got = df.collect()
    assert len(got) == len({(r["doc"], r["feature"]) for r in got})
    return {(r["doc"], r["feature"]): r["value"] for r in got}


@pytest.mark.parametrize("blocks", [1, 5])
def test_blocks_hold_the_features_counted_by_hand(spark, blocks):
    train = frame(spark, rows())
    other = frame(spark, [("x1", "amber brook unseen", "A"), ("x2", "unseen", "A"), ("x3", text(5), "B")])
    own = TextBlocks(train, "doc", "Description", (1, 2), blocks)
    weights = own.fit(63.0, 2, 0.95)
    features = own.weigh(weights)
    want = by_hand(rows(), rows())
    assert as_dict(features.long()) == pytest.approx(want)
    there = TextBlocks(other, "doc", "Description", (1, 2), blocks)
    got = as_dict(there.weigh(there.lookup(vocabulary_rows(weights))).long())
    assert got == pytest.approx(by_hand(rows(), [tuple(r) for r in other.collect()]))
    # by class: each label row of a document counts
    sums = {(r["feature"], r["emotion"]): r["o"] for r in features.sums(train.select("doc", "emotion"), "emotion").collect()}
    total = Counter()
    for d, _, label in rows():
        total.update({(f, label): v for (e, f), v in want.items() if e == d})
    assert sums == pytest.approx(dict(total))
    # of three features, as an array per document
    names = ["0:amber", "0:brook", "0:cedar delta"]
    some = {(r["doc"], "0:" + names[p["index"]][2:]): p["value"] for r in features.pairs({f: i for i, f in enumerate(names)}).collect() for p in r["p"]}
    assert some == pytest.approx({k: v for k, v in want.items() if k[1] in names})
    assert as_dict(features.only(names).long()) == pytest.approx(some)


def test_most_frequent_terms_only(spark):
    train = frame(spark, rows())
    got = X.text_features(train, None, "doc", ngram=(1, 2), max_features=4)[0]
    cf = Counter(g for _, t, _ in rows() for g in grams(t))
    df = Counter(g for _, g in {(d, g) for d, t, _ in rows() for g in grams(t)})
    kept = sorted((t for t in cf if 2 <= df[t] <= 0.95 * 63), key=lambda t: (-cf[t], t))[:4]
    assert {r[0] for r in got.features().collect()} == {f"0:{t}" for t in kept}


def test_no_row_per_document_and_term_is_written(spark):
    """Before, the rows were checkpointed: 400 documents of 200 words made 80,000 rows."""
    docs = spark.range(400).select(
        F.concat(F.lit("d"), "id").alias("doc"), F.lit("A").alias("emotion"), F.lit("g").alias("genres_text"),
        F.array_join(F.transform(F.sequence(F.lit(1), F.lit(200)), lambda j: F.concat(F.lit("w"), (F.col("id") * j) % 991)), " ").alias("Description"))
    docs = cut_lineage(docs.withColumns({c: F.col("doc").substr(2, 9).cast("double") for c in X.NUMERIC_FEATURES}))
    folder = urlparse(ensure_checkpoint_dir(spark)).path
    stored = lambda: {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names}
    before = stored()
    f_tr, _ = X.assemble_long(docs, docs.limit(5), "doc")
    assert f_tr.long().where("feature LIKE '0:%'").count() > 40_000
    new = [p for p in stored() - before if not p.endswith(".crc")]
    tables = {os.path.dirname(p) for p in new if p.endswith(".parquet")}
    assert tables and all(p.endswith((".parquet", "_SUCCESS")) for p in new)  # no checkpointed rows
    assert max(spark.read.parquet(t).count() for t in tables) <= 400 * 9
    assert isinstance(f_tr.text, TextFeatures)


def test_shuffle_files_go_when_a_table_is_written(spark):
    """A materialised table reads them no more; they were kept before."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {n for n in disk.getAllBlocks().mkString("|").split("|") if n.startswith("shuffle_")}
    before = files()
    got = cut_lineage(spark.range(5_000).groupBy((F.col("id") % 977).alias("k")).count())
    for _ in range(50):  # they are removed in the background
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    # the reads of the result shuffle again, outside
    assert got.count() == 977


def test_parts_are_the_same_wherever_a_term_is():
    import pyarrow as pa

    words = pa.array(["amber", "brook", "éclair", "straße 12", "x" * 5_000])
    assert parts_of(words, 7).tolist() == [int(parts_of(pa.array([w]), 7)[0]) for w in words.to_pylist()]
    assert parts_of(words.slice(2), 7).tolist() == parts_of(words, 7).tolist()[2:]
    assert len(parts_of(pa.array([], pa.string()), 7)) == 0
