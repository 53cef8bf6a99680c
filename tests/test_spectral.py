"""Block power SVD, its variance curve, the sweep of components, and what the
iterative fits promise (importances, loss)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from emolens.ml import spectral as S
from emolens.ml.vectors import svd_project
from emolens.operators import evaluate as E
from emolens.operators import features as X
from emolens.plans.q_features import DOC, train_test
from tests.conftest import SF_SMALL

SCHEMA = "doc string, feature string, value double"


def dense(rows):
    docs, names = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    m = np.zeros((len(docs), len(names)))
    for d, f, x in rows:
        m[docs.index(d), names.index(f)] += x or 0.0
    return docs, names, m


def random_rows(seed, n_docs, n_features, share=0.2):
    g = np.random.default_rng(seed)
    # columns of falling size, so that the leading values are apart
    return [(f"d{i:04d}", f"f{j:04d}", float(g.random() * 0.97 ** j)) for i in range(n_docs) for j in range(n_features) if g.random() < share]


def found(fitted):
    s = [r["value"] for r in fitted.singular.orderBy("component").collect()]
    return np.array(s), {(r["feature"], r["component"]): r["weight"] for r in fitted.weights.collect()}


@pytest.fixture(scope="module")
def capped(spark):
    tr, te = train_test(spark, SF_SMALL)
    f = X.text_block(tr, te, DOC, ngram=(1, 2), max_features=5000)[0].checkpoint()
    return f, tr.count()


def test_leading_block_matches_numpy(spark):
    rows = random_rows(3, 300, 90)
    docs, names, m = dense(rows)
    f = spark.createDataFrame(rows, SCHEMA).repartition(5)
    fitted = S.fit_components(f, "doc", 8)
    u, s, vt = np.linalg.svd(m, full_matrices=False)
    got, w = found(fitted)
    assert fitted.passes > 2 and (fitted.n_docs, fitted.k) == (300, 8)
    assert got == pytest.approx(s[:8], rel=1e-8)
    mine = np.array([[w[n, c] for c in range(8)] for n in names])
    assert np.abs(mine) == pytest.approx(np.abs(vt[:8].T), abs=1e-6)
    assert mine.T @ mine == pytest.approx(np.eye(8), abs=1e-9)
    assert (mine[np.abs(mine).argmax(0), range(8)] > 0).all()
    # the projection of every row
    rows_out = svd_project(f, fitted.weights, f.select("doc").distinct(), "doc", 8).collect()
    scores = {r["doc"]: r["svd"].toArray() for r in rows_out}
    assert np.abs(np.array([scores[d] for d in docs])) == pytest.approx(np.abs(u[:, :8] * s[:8]), abs=1e-6)


def test_curve_of_the_capped_vocabulary_matches_numpy(spark, capped):
    f, n = capped
    docs, names, m = dense([tuple(r) for r in f.select(DOC, "feature", "value").collect()])
    m = np.vstack([m, np.zeros((n - len(docs), len(names)))])  # rows without a term
    u, s, _ = np.linalg.svd(m, full_matrices=False)
    scores = u[:, :100] * s[:100]
    want = scores.var(0) / m.var(0).sum()
    fitted = S.fit_components(f, DOC, 100)
    got = S.variance_curve(fitted, f, n).orderBy("component").collect()
    assert found(fitted)[0] == pytest.approx(s[:100], rel=1e-6)
    assert [r["ratio"] for r in got] == pytest.approx(want, rel=1e-6)
    assert [r["cumulative"] for r in got] == pytest.approx(want.cumsum(), rel=1e-6)


def test_result_does_not_depend_on_partitions_or_chunks(spark, monkeypatch):
    f = spark.createDataFrame(random_rows(5, 80, 40), SCHEMA)
    one, w = found(S.fit_components(f.coalesce(1), "doc", 5))
    many, x = found(S.fit_components(f.repartition(13), "doc", 5, seed=7))
    assert one == pytest.approx(many, rel=1e-9) and w.keys() == x.keys()
    assert max(abs(w[k] - x[k]) for k in w) < 1e-6


def test_chunks():
    assert list(S.chunks(np.array([3, 3, 9, 1, 1]), 6)) == [(0, 2), (2, 3), (3, 5)]
    assert list(S.chunks(np.array([], int))) == []


def test_gaps_repeats_few_features_and_empty(spark):
    rows = [("a", "x", 1.0), ("a", "x", 1.0), ("a", "y", None), ("b", "y", 0.0), ("b", "x", 3.0), ("c", "z", 2.0)]
    fitted = S.fit_components(spark.createDataFrame(rows, SCHEMA), "doc", 5)
    s, w = found(fitted)
    assert fitted.k == 2 and s == pytest.approx([13 ** 0.5, 2.0])
    assert w["x", 0] == pytest.approx(1.0) and w["z", 1] == pytest.approx(1.0)
    none = S.fit_components(spark.createDataFrame([], SCHEMA), "doc", 5)
    assert none.k == 0 and none.weights.count() == 0 and none.singular.count() == 0


def test_too_many_features_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(S, "MOST_BYTES", 1000)
    with pytest.raises(ValueError, match="cap the vocabulary"):
        S.fit_components(spark.createDataFrame(random_rows(1, 20, 30), SCHEMA), "doc", 5)


def test_last_prefix_of_the_sweep_is_the_tree(spark):
    from emolens.plans.q_models import SWEEP, q_dt, q_svd_sweep

    sweep = {r["components"]: r for r in q_svd_sweep(spark, SF_SMALL).collect()}
    tree = E.summary_metrics(E.label_counts(q_dt(spark, SF_SMALL))).first()
    assert sorted(sweep) == sorted(SWEEP)
    last = sweep[max(sweep)].asDict()
    assert {k: v for k, v in last.items() if k != "components"} == pytest.approx(tree.asDict())
    assert len({(r["macro_f1"], r["accuracy"]) for r in sweep.values()}) > 1


def test_importances_sum_to_one(spark):
    from emolens.plans.q_models import q_components, q_importance

    every = [r["importance"] for r in q_components(spark, SF_SMALL).collect()]
    top = [r["importance"] for r in q_importance(spark, SF_SMALL).collect()]
    assert len(every) == 100 and min(every) >= 0 and sum(every) == pytest.approx(1.0)
    assert top == pytest.approx(sorted(every, reverse=True)[:20])


def test_loss_falls_at_every_iteration(spark):
    from emolens.plans.q_models import q_loss

    rows = q_loss(spark, SF_SMALL).orderBy("iteration").collect()
    loss = [r["loss"] for r in rows]
    assert [r["iteration"] for r in rows] == list(range(len(loss))) and 2 < len(loss) <= 301
    assert all(b <= a for a, b in zip(loss, loss[1:])) and loss[-1] < 0.5 * loss[0]
