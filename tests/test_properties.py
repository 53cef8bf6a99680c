
import math

import numpy as np
from pyspark.sql import functions as F

from emolens.functions.text import (blank_to_null, parse_list_literal, to_double, tokenize,
                                    trim_unicode, word_count)
from emolens.ml.naive_bayes import fit_naive_bayes
from emolens.operators import features as X
from emolens.operators import sampling as S
from emolens.operators.clean import exact_dedup


def test_trim_and_blank_unicode(spark):
    df = spark.createDataFrame([(" \tab c 　",), ("  \n",), ("x",), (None,)], "s string")
    got = [r[0] for r in df.select(blank_to_null(trim_unicode("s"))).collect()]
    assert got == ["ab c", None, "x", None]


def test_to_double_never_raises(spark):
    df = spark.createDataFrame([("5.5",), ("bad",), ("NaN",), ("11",), (None,)], "s string")
    assert [r[0] for r in df.select(to_double("s")).collect()] == [5.5, None, None, 11.0, None]


def test_parse_list_literal_edges(spark):
    df = spark.createDataFrame([("['Drama', 'Romance']",), ("[]",), ("broken",), (None,),
                                ("[' a ', '  ']",)], "g string")
    got = [r[0] for r in df.select(parse_list_literal("g")).collect()]
    assert got == [["Drama", "Romance"], [], [], [], ["a"]]


def test_word_count_and_tokens(spark):
    df = spark.createDataFrame([("  The quick\tbrown fox's jumps ",)], "t string")
    r = df.select(word_count("t").alias("w"), tokenize("t").alias("k")).first()
    assert r["w"] == 5
    assert r["k"] == ["quick", "brown", "fox", "jumps"]


def test_dedup_idempotent_and_keeps_first(spark):
    df = spark.createDataFrame([(3, "a", 1.0), (1, "a", 1.0), (2, "b", None), (5, "b", None)],
                               "_row_id long, x string, y double")
    once = exact_dedup(df)
    assert sorted(r["_row_id"] for r in once.collect()) == [1, 2]
    assert sorted(map(tuple, exact_dedup(once).collect())) == sorted(map(tuple, once.collect()))


def test_split_properties_and_repartition_invariance(spark):
    d = spark.range(0, 997).select(F.col("id").cast("string").alias("key"),
                                   (F.col("id") % 7).cast("string").alias("label"))
    a = S.stratified_split(d, "label", "key")
    b = S.stratified_split(d.repartition(13), "label", "key")
    ra = {r["key"]: (r["split"], r["fold"]) for r in a.collect()}
    rb = {r["key"]: (r["split"], r["fold"]) for r in b.collect()}
    assert ra == rb and len(ra) == 997
    # folds differ by at most one per class
    sizes = a.where("split = 'train'").groupBy("label", "fold").count().groupBy("label").agg(
        (F.max("count") - F.min("count")).alias("spread"))
    assert max(r["spread"] for r in sizes.collect()) <= 1


def test_clipper_bounded_and_idempotent(spark):
    df = spark.createDataFrame([(None if x is None else float(x),) for x in [1, 2, 3, 4, 100, -50, None]], "v double")
    b = X.fit_iqr_clipper(df, ["v"])
    once = X.iqr_clip(df, ["v"], b)
    twice = X.iqr_clip(once, ["v"], b)
    assert once.collect() == twice.collect()
    vals = [r[0] for r in once.collect() if r[0] is not None]
    assert max(vals) < 100 and min(vals) > -50


def test_min_max_constant_column_is_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    out = X.min_max_scale(df, ["v"], X.fit_min_max(df, ["v"]))
    assert [r[0] for r in out.collect()] == [0.0, 0.0]


def test_tfidf_rows_unit_norm(spark):
    docs = spark.createDataFrame([("d1", "apple banana apple cherry"), ("d2", "banana cherry date"),
                                  ("d3", "apple date date banana")], "doc string, Description string")
    tr, _ = X.text_block(docs, docs, "doc", min_df=2, max_df=1.0)
    norms = tr.groupBy("doc").agg(F.sqrt(F.sum(F.col("value") ** 2)).alias("n")).collect()
    assert all(math.isclose(r["n"], 1.0) for r in norms)


def test_chi2_matches_direct_formula(spark):
    feats = spark.createDataFrame([("a", "f1", 1.0), ("a", "f2", 2.0), ("b", "f1", 3.0), ("c", "f2", 1.0)],
                                  "doc string, feature string, value double")
    labels = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "y")], "doc string, emotion string")
    got = {r["feature"]: r["chi2"] for r in X.chi2_scores(feats, labels, "doc", "emotion").collect()}
    X_ = np.array([[1, 2], [3, 0], [0, 1]], dtype=float)
    Y = np.array([[1, 0], [0, 1], [0, 1]], dtype=float)
    obs = Y.T @ X_
    exp = Y.mean(axis=0).reshape(-1, 1) @ X_.sum(axis=0).reshape(1, -1)
    chi = ((obs - exp) ** 2 / exp).sum(axis=0)
    assert math.isclose(got["f1"], chi[0]) and math.isclose(got["f2"], chi[1])


def test_naive_bayes_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    n_docs, n_feat, classes = 30, 6, ["a", "b", "c"]
    Xm = rng.integers(0, 3, size=(n_docs, n_feat)).astype(float)
    y = [classes[i % 3] for i in range(n_docs)]
    Xm[5] = 0.0  # a document without features keeps its row
    rows = [(f"d{i}", f"f{j}", float(Xm[i, j])) for i in range(n_docs) for j in range(n_feat) if Xm[i, j]]
    feats = spark.createDataFrame(rows, "doc string, feature string, value double")
    labels = spark.createDataFrame([(f"d{i}", y[i]) for i in range(n_docs)], "doc string, emotion string")
    for alpha, uniform in [(0.1, True), (1.0, False)]:
        m = fit_naive_bayes(feats, labels, "doc", "emotion", alpha, uniform)
        got = {r["doc"]: r["predicted"] for r in m.predict(feats, labels.select("doc"), "doc").collect()}
        used = sorted({f for _, f, _ in rows}, key=lambda s: int(s[1:]))
        cols = [int(f[1:]) for f in used]
        fc = np.array([Xm[[i for i in range(n_docs) if y[i] == c]][:, cols].sum(axis=0) for c in classes])
        flp = np.log(fc + alpha) - np.log((fc + alpha).sum(axis=1, keepdims=True))
        prior = np.full(3, -np.log(3)) if uniform else np.log([y.count(c) / n_docs for c in classes])
        jll = Xm[:, cols] @ flp.T + prior
        expected = {f"d{i}": classes[int(np.argmax(jll[i]))] for i in range(n_docs)}
        assert got == expected


def test_svd_fit_matches_numpy(spark):
    from pyspark.ml.linalg import Vectors

    from emolens.ml.vectors import svd_fit

    rng = np.random.default_rng(3)
    M = rng.random((40, 12)) * (rng.random((40, 12)) < 0.4)
    df = spark.createDataFrame([(Vectors.dense(r.tolist()),) for r in M], ["features"])
    v, s = svd_fit(df, 5)
    expected = np.linalg.svd(M, compute_uv=False)[:5]
    assert np.allclose(s, expected, rtol=1e-8)
    assert np.allclose(v.T @ v, np.eye(5), atol=1e-8)


def test_correlation_matrix_by_pair(spark):
    import math

    import numpy as np
    from emolens.operators.eda import correlation_matrix
    from pyspark.sql import functions as F
    rng = np.random.default_rng(5)
    data = [(float(a), float(b), int(c), 3.0, None if i % 7 == 0 else float(a * b)) for i, (a, b, c) in enumerate(zip(
        rng.normal(size=200), rng.normal(size=200), rng.integers(0, 9, 200)))]
    df = spark.createDataFrame(data, "a double, b double, c int, k double, n double")
    out = correlation_matrix(df, ["a", "b", "c", "k", "n"])
    rows = out.collect()
    assert [(r.feature_x, r.feature_y) for r in rows[:3]] == [("a", "a"), ("a", "b"), ("b", "a")] and len(rows) == 25
    for r in rows:
        x, y = ([row["abckn".index(c)] for row in data] for c in (r.feature_x, r.feature_y))
        both = [(u, v) for u, v in zip(x, y) if u is not None and v is not None]
        if "k" in (r.feature_x, r.feature_y):
            assert r.correlation is None
        else:
            assert math.isclose(r.correlation, np.corrcoef(*zip(*both))[0, 1], abs_tol=1e-9)
    # a few buffers per pair, not those of all pairs in one row
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("covar_samp") == 1
    none = correlation_matrix(df.where(F.lit(False)), ["a", "b"]).collect()
    assert [tuple(r) for r in none] == [("a", "a", None), ("a", "b", None), ("b", "a", None), ("b", "b", None)]
