"""Fitted pipelines: state, save and reload, raw rows, solutions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from emolens.ml.pipeline import (Linear, NaiveBayes, PipelineModel, SparkModel, dense_pipeline, sparse_pipeline)
from emolens.operators.describe import NUMERIC_FEATURES
from emolens.session import ensure_checkpoint_dir

SCHEMA = "doc string, emotion string, Description string, genres_text string, " + ", ".join(f"{c} double" for c in NUMERIC_FEATURES)
CLASSES = {"joy": "sun happy bright laugh smile play", "fear": "dark ghost scream night shadow cold", "calm": "river slow quiet leaf tea rain"}


def rows(seed, n, prefix):
    r = random.Random(seed)
    out = []
    for i in range(n):
        label = r.choice([*CLASSES, "joy"])
        words = r.choices(CLASSES[label].split(), k=r.randint(3, 9)) + r.choices("plot film story scene actor".split(), k=4)
        r.shuffle(words)
        text = None if i % 23 == 5 else " ".join(words)
        genre = None if i % 17 == 3 else r.choice(["drama", "drama comedy", "horror"])
        numbers = [None if r.random() < 0.05 else float(round(r.gauss(5, 2 + j), 1)) for j in range(len(NUMERIC_FEATURES))]
        out.append((f"{prefix}{i}", label, text, genre, *numbers))
    return out


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(rows(1, 150, "t"), SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def other(spark):
    """Unseen rows: among them an unknown genre, no known word, only gaps."""
    odd = [("o1", "joy", "zzz qqq", "opera", *[5.0] * 8), ("o2", "joy", None, None, *[None] * 8), ("o3", "joy", "", "", *[1e9] * 8)]
    return spark.createDataFrame(rows(2, 60, "v") + odd, SCHEMA).repartition(3)


def folder(spark, name):
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-{name}-{uuid.uuid4().hex}"


def labels(df, column="predicted"):
    return {r["doc"]: r[column] for r in df.select("doc", column).collect()}


def test_bayes_pipeline_round_trip_in_a_fresh_session(spark, train, other):
    fitted = sparse_pipeline("doc", NaiveBayes("doc", 0.1, True), k=40).fit(train, "emotion")
    path = folder(spark, "bayes")
    fitted.save(path)
    fresh = spark.newSession()
    again = PipelineModel.load(fresh, path)
    raw = fresh.createDataFrame(rows(2, 60, "v"), SCHEMA)
    want, got = labels(fitted.transform(other)), labels(again.transform(raw))
    assert len(want) == 63 and got == {k: v for k, v in want.items() if k.startswith("v")}
    truth = {r[0]: r[1] for r in rows(2, 60, "v")}
    assert np.mean([got[k] == truth[k] for k in got]) > 0.85
    assert all(c.isidentifier() for c in again.stages) and list(again.stages) == list(fitted.stages)


def test_scored_rows_never_change_what_was_learned(spark, train, other):
    p = sparse_pipeline("doc", NaiveBayes("doc", 1.0, False), k=25)
    model = p.fit(train, "emotion")
    one = labels(model.transform(other.where("doc = 'v7'")))
    assert one["v7"] == labels(model.transform(other))["v7"]
    assert model.stages["select"].tables["selected"].count() == 25
    terms = {r["term"] for r in model.stages["text"].tables["vocabulary"].collect()}
    assert "zzz" not in terms and "happy" in terms


def test_bayes_matches_a_dense_computation(spark, train, other):
    """The joins with saved tables against the textbook formula."""
    model = sparse_pipeline("doc", NaiveBayes("doc", 0.5, False), k=30).fit(train, "emotion")
    selected = sorted(r["feature"] for r in model.stages["select"].tables["selected"].collect())

    def matrix(df):
        docs = sorted(r["doc"] for r in df.select("doc").collect())
        x = np.zeros((len(docs), len(selected)))
        for r in model.features(df).collect():
            x[docs.index(r["doc"]), selected.index(r["feature"])] = r["value"]
        return docs, x

    docs, x = matrix(train)
    y = labels(train, "emotion")
    names = sorted(set(y.values()))
    fc = np.array([x[[y[d] == c for d in docs]].sum(0) for c in names]) + 0.5
    log_p = np.log(fc) - np.log(fc.sum(1, keepdims=True))
    prior = np.log([sum(v == c for v in y.values()) / len(y) for c in names])
    others, z = matrix(other)
    want = {d: names[int(np.argmax(prior + z[i] @ log_p.T))] for i, d in enumerate(others)}
    assert labels(model.transform(other)) == want


@pytest.mark.parametrize("family", ["logistic", "linear_svm"])
def test_linear_pipeline_round_trip(spark, train, other, family):
    fitted = sparse_pipeline("doc", Linear("doc", family, (("C", 1.0), ("max_iter", 200))), k=40).fit(train, "emotion")
    path = folder(spark, family)
    fitted.save(path)
    again = PipelineModel.load(spark, path)
    got = labels(again.transform(other))
    assert got == labels(fitted.transform(other)) and len(got) == 63
    truth = {r[0]: r[1] for r in rows(2, 60, "v")}
    assert np.mean([got[k] == truth[k] for k in truth]) > 0.85


def test_logistic_weights_solve_their_problem(spark, train):
    """The gradient of the regularised, weighted loss vanishes at the fit."""
    model = sparse_pipeline("doc", Linear("doc", "logistic", (("C", 2.0), ("max_iter", 2000)), False), k=30).fit(train, "emotion")
    c = model.stages["classifier"]
    names = c.params["classes"]
    w = {r["feature"]: r["w"] for r in c.tables["weights"].collect()}
    bias = {r["label"]: r["bias"] for r in c.tables["classes"].collect()}
    feats = sorted(w)
    y = labels(train, "emotion")
    docs = sorted(y)
    x = np.zeros((len(docs), len(feats)))
    for r in model.features(train).collect():
        x[docs.index(r["doc"]), feats.index(r["feature"])] = r["value"]
    m = x @ np.array([w[f] for f in feats]) + np.array([bias[n] for n in names])
    p = np.exp(m - m.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    hot = np.array([[y[d] == n for n in names] for d in docs], float)
    reg = 1.0 / (2.0 * len(docs))
    gradient = x.T @ (p - hot) / len(docs) + reg * np.array([w[f] for f in feats])
    assert np.abs(gradient).max() < 2e-3 and np.abs((p - hot).mean(0)).max() < 2e-3


@pytest.fixture(scope="module")
def tree(spark, train):
    spec = SparkModel("doc", "decision_tree", (("criterion", "entropy"), ("max_depth", 6)))
    return dense_pipeline("doc", spec, k=40, components=6).fit(train, "emotion")


def test_components_match_numpy(spark, train, tree):
    selected = {r["feature"]: r["index"] for r in tree.stages["select"].tables["selected"].collect()}
    docs = sorted(labels(train, "emotion"))
    x = np.zeros((len(docs), len(selected)))
    for r in tree.features(train).collect():
        x[docs.index(r["doc"]), selected[r["feature"]]] = r["value"]
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    got = [r["value"] for r in tree.stages["project"].tables["singular"].orderBy("component").collect()]
    assert got == pytest.approx(s[:6], rel=1e-6)
    comps = {r["doc"]: r["components"] for r in tree.vectors(train).collect()}
    mine = np.array([comps[d] for d in docs])
    assert np.abs(mine) == pytest.approx(np.abs(u[:, :6] * s[:6]), abs=1e-6)
    scaling = tree.stages["project"].tables["scaling"].orderBy("component").collect()
    assert [r["mean"] for r in scaling] == pytest.approx(mine.mean(0), abs=1e-9)
    assert [r["std"] for r in scaling] == pytest.approx(mine.std(0), abs=1e-9)


def test_dense_pipeline_round_trip(spark, other, tree):
    path = folder(spark, "tree")
    tree.save(path)
    again = PipelineModel.load(spark, path)
    before = {r["doc"]: r["components"] for r in tree.vectors(other).collect()}
    after = {r["doc"]: r["components"] for r in again.vectors(other).collect()}
    assert before.keys() == after.keys() and len(after) == 63
    assert max(np.abs(np.array(before[d]) - after[d]).max() for d in after) < 1e-9
    assert labels(again.transform(other)) == labels(tree.transform(other))


def test_scaled_network_round_trip(spark, train, other):
    spec = SparkModel("doc", "mlp", (("hidden", (8,)), ("max_iter", 60)), False)
    fitted = dense_pipeline("doc", spec, k=40, components=6, scale=True, ngram=(1, 1)).fit(train, "emotion")
    v = np.array([r["components"] for r in fitted.vectors(train).collect()])
    assert np.abs(v.mean(0)).max() < 1e-6 and v.std(0) == pytest.approx(np.ones(6), abs=1e-6)
    path = folder(spark, "mlp")
    fitted.save(path)
    again = PipelineModel.load(spark, path)
    got = labels(again.transform(other))
    assert got == labels(fitted.transform(other))
    truth = {r[0]: r[1] for r in rows(2, 60, "v")}
    assert np.mean([got[k] == truth[k] for k in truth]) > 0.7


def test_genre_words_and_their_unseen_rule(spark, train, other):
    from emolens.ml.pipeline import GenreTokens, Pipeline, ScaledNumbers, SelectBest, TextTfidf

    known = {w for r in rows(1, 150, "t") for w in (r[3] or "").split()}
    genres = {r["doc"]: (r["genres_text"] or "").split() for r in other.select("doc", "genres_text").collect()}
    for unseen in ("ignore", "mark"):
        model, _ = GenreTokens("doc", unseen=unseen).fit(train)
        got = {}
        for r in model.transform(other).collect():
            assert r["value"] == 1.0
            got.setdefault(r["doc"], set()).add(r["feature"])
        want = {d: {f"4:{w}" for w in ws if w in known} | ({"4"} if unseen == "mark" and set(ws) - known else set()) for d, ws in genres.items()}
        assert got == {d: f for d, f in want.items() if f} and ("o1" in got) == (unseen == "mark")
    # as a block of a pipeline: selected by chi², saved and reloaded
    spec = Pipeline(TextTfidf("doc"), GenreTokens("doc"), ScaledNumbers("doc"), SelectBest(500), NaiveBayes("doc", 0.5))
    fitted = spec.fit(train, "emotion")
    scores = {r["feature"]: r["chi2"] for r in fitted.stages["select"].tables["selected"].collect()}
    docs = {r[0]: (r[1], set((r[3] or "").split())) for r in rows(1, 150, "t")}
    names = sorted({e for e, _ in docs.values()})
    for w in known:
        seen = np.array([sum(e == c and w in ws for e, ws in docs.values()) for c in names], float)
        due = seen.sum() * np.array([sum(e == c for e, _ in docs.values()) for c in names]) / len(docs)
        assert scores[f"4:{w}"] == pytest.approx(((seen - due) ** 2 / due).sum())
    path = folder(spark, "genres")
    fitted.save(path)
    assert labels(PipelineModel.load(spark, path).transform(other)) == labels(fitted.transform(other))


def test_scoring_plans_have_no_python(spark, other, tree):
    plan = tree.vectors(other)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_rows(spark, train):
    model = sparse_pipeline("doc", NaiveBayes("doc"), k=10).fit(train, "emotion")
    assert model.transform(train.where(F.lit(False))).count() == 0
