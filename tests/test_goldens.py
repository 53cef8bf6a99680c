
import math

import pytest
from pyspark.sql import functions as F

from emolens.operators import evaluate as E
from emolens.operators import sampling as S
from emolens.operators.recommend import score_catalogue

CLASSES = ["anger", "anticipation", "disgust", "fear", "joy", "optimism", "sadness"]
LINEAR_SVM = ("5 5 2 2 3 0 9; 3 14 2 6 10 3 12; 2 1 1 0 0 1 10; 3 3 0 5 3 4 12; "
              "3 16 7 5 24 4 21; 6 6 3 0 5 9 18; 10 9 14 10 15 14 92")
LOGREG = ("5 7 1 3 4 0 6; 4 15 1 6 9 6 9; 3 1 1 0 1 2 7; 4 5 0 6 3 5 7; 3 18 6 7 29 6 11; "
          "6 8 3 0 7 10 13; 13 13 12 14 23 25 64")


def predictions_from_matrix(spark, matrix):
    rows = []
    for i, line in enumerate(matrix.split(";")):
        for j, n in enumerate(line.split()):
            rows.append((CLASSES[i], CLASSES[j], int(n)))
    df = spark.createDataFrame(rows, "actual string, predicted string, n int")
    return df.select("actual", "predicted", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_")) \
             .where(F.col("n") > 0).drop("_")


@pytest.mark.parametrize("matrix,acc,macro_f1,weighted_f1,macro_p,macro_r", [
    (LINEAR_SVM, 0.3640776699029126, 0.2523229910137368, 0.3660734955469141,
     0.259205990825449, 0.25115799958560725),
    (LOGREG, 0.3155339805825243, 0.2387273110743478, 0.3321891646006497,
     0.2396522224684047, 0.2463548884085988),
])
def test_metrics_from_published_confusion(spark, matrix, acc, macro_f1, weighted_f1, macro_p, macro_r):
    pred = predictions_from_matrix(spark, matrix)
    assert pred.count() == 412
    s = E.summary_metrics(E.label_counts(pred)).first()
    assert math.isclose(s["accuracy"], acc, abs_tol=1e-12)
    assert math.isclose(s["macro_f1"], macro_f1, abs_tol=1e-12)
    assert math.isclose(s["weighted_f1"], weighted_f1, abs_tol=1e-12)
    assert math.isclose(s["macro_precision"], macro_p, abs_tol=1e-12)
    assert math.isclose(s["macro_recall"], macro_r, abs_tol=1e-12)


def test_report_rows_match_published(spark):
    rep = {r["label"]: r for r in E.classification_report(predictions_from_matrix(spark, LINEAR_SVM)).collect()}
    assert math.isclose(rep["anger"]["precision"], 0.15625)
    assert math.isclose(rep["disgust"]["recall"], 0.06666666666666667)
    assert rep["sadness"]["support"] == 164.0
    # the accuracy row repeats its value in all four columns
    assert all(math.isclose(rep["accuracy"][c], 0.3640776699029126) for c in E.REPORT_COLUMNS)
    assert rep["macro avg"]["support"] == 412.0


def test_quota_golden(spark):
    counts = {"sadness": 817, "joy": 400, "anticipation": 249, "optimism": 237, "fear": 150,
              "anger": 131, "disgust": 73}
    rows = [(f"{k}-{i}", k) for k, n in counts.items() for i in range(n)]
    df = spark.createDataFrame(rows, "key string, emotion string")
    q = {r["emotion"]: r["test_quota"] for r in S.class_quotas(df, "emotion").collect()}
    assert q == {"sadness": 164, "joy": 80, "anticipation": 50, "optimism": 47, "fear": 30,
                 "anger": 26, "disgust": 15}
    split = S.stratified_split(df, "emotion", "key")
    got = {r["emotion"]: r["c"] for r in split.where("split = 'test'").groupBy("emotion")
           .agg(F.count(F.lit(1)).alias("c")).collect()}
    assert got == q


def test_score_golden(spark):
    # rating bounds 1..10 and review counts 1..2178 fix the min-max scales
    rows = [(9.590909090909092, 88), (9.666666666666666, 18), (10.0, 3), (8.1, 60),
            (1.0, 1), (5.0, 2178)]
    df = spark.createDataFrame([(f"d{i}", r, math.log1p(n)) for i, (r, n) in enumerate(rows)],
                               "Description string, mean_rating double, log_review_count double")
    got = {r["Description"]: r["recommendation_score"] for r in score_catalogue(df).collect()}
    expected = [0.8515887654665693, 0.8027005277434849, 0.7747783564097883, 0.7138422337798506]
    for i, e in enumerate(expected):
        assert math.isclose(got[f"d{i}"], e, rel_tol=1e-12)


def test_tie_golden_first_in_grid_order(spark):
    ranked = spark.createDataFrame(
        [(0, "depth=None", 1), (1, "depth=20", 1), (2, "depth=40", 1), (3, "depth=10", 4)],
        "candidate_id int, params string, rank_test_score int")
    # grid order as the source lists it: 20 comes before 40 and None
    order = {"depth=20": 0, "depth=40": 1, "depth=None": 2, "depth=10": 3}
    ranked = ranked.withColumn("grid_pos", F.udf(lambda p: order[p], "int")("params"))
    best = E.pick_best(ranked, "grid_pos").first()
    assert best["params"] == "depth=20"
