"""Classifier families on Spark ML.

Gaps against the source's library, stated once here:

* logistic regression: ``regParam = 1 / (C * sum(weights))`` with
  ``standardization=False`` maps the C-parameterised L2 objective;
* linear SVM: ``OneVsRest(LinearSVC)`` — hinge loss and an unpenalised
  intercept (the source used squared hinge with a penalised intercept);
* Naive Bayes: the long-form model in ``naive_bayes.py`` is the exact one
  (uniform prior supported); ``ml.NaiveBayes`` smooths the prior;
* trees: Spark caps depth at 30: no depth means 30, a larger one is an
  error, so that two candidates are never silently the same fit; splits are on
  binned thresholds and ``minInstancesPerNode`` is a leaf minimum;
* MLP: sigmoid hidden layers, no L2 / activation / early-stopping options —
  its grid is layers x iterations, and a step size where one is named
  (gradient descent; the default L-BFGS has none).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TREE_DEPTH = 30


@dataclass
class Candidate:
    family: str
    params: dict

    @property
    def name(self) -> str:
        return self.family + "(" + ", ".join(f"{k}={v}" for k, v in sorted(self.params.items())) + ")"


def tree_depth(params: dict) -> int:
    """The depth of a tree candidate; Spark has no deeper trees than 30."""
    depth = int(params.get("max_depth") or MAX_TREE_DEPTH)
    if depth > MAX_TREE_DEPTH:
        raise ValueError(f"max_depth {depth}: Spark's trees end at depth {MAX_TREE_DEPTH}")
    return depth


def make_estimator(c: Candidate, n_features: int, n_classes: int, weight_sum: float = 1.0):
    p = dict(c.params)
    w = "weight"
    if c.family == "logistic":
        C = float(p.get("C", 1.0))
        return LogisticRegression(family="multinomial", elasticNetParam=0.0, standardization=False,
                                  regParam=1.0 / (C * weight_sum), maxIter=int(p.get("max_iter", 100)),
                                  weightCol=w)
    if c.family == "linear_svm":
        C = float(p.get("C", 1.0))
        svc = LinearSVC(regParam=1.0 / (C * weight_sum), standardization=False,
                        maxIter=int(p.get("max_iter", 50)), weightCol=w)
        return OneVsRest(classifier=svc, weightCol=w)
    if c.family == "decision_tree":
        return DecisionTreeClassifier(impurity=p.get("criterion", "gini"),
                                      maxDepth=tree_depth(p),
                                      minInstancesPerNode=int(p.get("min_samples", 1)),
                                      weightCol=w, seed=42)
    if c.family == "random_forest":
        return RandomForestClassifier(numTrees=int(p.get("n_estimators", 100)),
                                      maxDepth=tree_depth(p),
                                      featureSubsetStrategy=p.get("max_features", "sqrt"),
                                      weightCol=w, seed=42)
    if c.family == "mlp":
        hidden = list(p.get("hidden", (100,)))
        mlp = MultilayerPerceptronClassifier(layers=[n_features, *hidden, n_classes],
                                             maxIter=int(p.get("max_iter", 300)), seed=42)
        return mlp.setSolver("gd").setStepSize(float(p["lr"])) if "lr" in p else mlp
    raise ValueError(f"unknown family {c.family}")


def fit_predict(c: Candidate, train: DataFrame, others: dict[str, DataFrame], classes: list[str],
                features: str = "features"):
    """Fit on ``train`` (label, weight, features) and predict each named row
    set; returns (model, {name: predictions with actual/predicted names})."""
    n_features = train.select(features).first()[0].size
    wsum = train.select(F.sum("weight")).first()[0] or 1.0
    est = make_estimator(c, n_features, len(classes), wsum).setFeaturesCol(features)
    model = est.fit(train)
    names = F.array(*[F.lit(x) for x in classes])
    out = {}
    for key, df in others.items():
        p = model.transform(df)
        out[key] = p.withColumn("predicted", F.element_at(names, (F.col("prediction") + 1).cast("int")))
    return model, out


def component_sweep(c: Candidate, train: DataFrame, rows: DataFrame, classes: list[str], sizes,
                    features: str = "features") -> DataFrame:
    """``c`` fitted on each of the first ``sizes`` components of ``train``;
    every row of ``rows`` once per size as (components, actual, predicted).

    The rows are read once: each model adds its label as a column."""
    names = F.array(*[F.lit(x) for x in classes])
    weight_sum = train.select(F.sum("weight")).first()[0] or 1.0
    labelled = rows
    for n in sizes:
        cut = VectorSlicer(inputCol=features, outputCol="_cut", indices=list(range(n)))
        model = make_estimator(c, n, len(classes), weight_sum).setFeaturesCol("_cut").fit(cut.transform(train))
        p = model.transform(cut.transform(labelled))
        label = F.element_at(names, (F.col("prediction") + 1).cast("int"))
        labelled = p.withColumn(f"_by_{n}", label).drop("_cut", "prediction", "probability", "rawPrediction")
    each = F.array(*[F.struct(F.lit(n).alias("components"), F.col(f"_by_{n}").alias("predicted")) for n in sizes])
    return labelled.select("actual", F.inline(each))
