"""Evaluation, model comparison and selection.

All metrics derive from per-label counts (support, true positives,
predicted count).  One pass computes them: every prediction row emits a row
for its actual label and one for its predicted label, so the label set is
the union of both (as in the source) without a label x label grid.  Counts
are additive, so "all folds but f" statistics are totals minus fold counts.
``by`` columns (model, fold, ...) keep many evaluations in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REPORT_COLUMNS = ["precision", "recall", "f1_score", "support"]
METRICS = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1"]


def _safe_div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def confusion_long(pred: DataFrame, actual: str = "actual", predicted: str = "predicted",
                   by=()) -> DataFrame:
    """(actual, predicted, count) for the observed pairs."""
    return pred.groupBy(*by, actual, predicted).agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(pred: DataFrame, labels, actual: str = "actual",
                     predicted: str = "predicted") -> DataFrame:
    """Zero-filled matrix: one row per actual label, one column per label."""
    return (pred.groupBy(actual).pivot(predicted, list(labels))
            .agg(F.count(F.lit(1))).na.fill(0))


def label_counts(pred: DataFrame, actual: str = "actual", predicted: str = "predicted",
                 by=()) -> DataFrame:
    """Per (by..., label): support, tp, predicted (one aggregate)."""
    hit = (F.col(actual) == F.col(predicted)).cast("long")
    rows = F.array(
        F.struct(F.col(actual).alias("label"), F.lit(1).cast("long").alias("s"),
                 hit.alias("tp"), F.lit(0).cast("long").alias("pc")),
        F.struct(F.col(predicted).alias("label"), F.lit(0).cast("long").alias("s"),
                 F.lit(0).cast("long").alias("tp"), F.lit(1).cast("long").alias("pc")))
    return (pred.select(*by, F.inline(rows))
            .groupBy(*by, "label").agg(F.sum("s").alias("support"), F.sum("tp").alias("tp"),
                                        F.sum("pc").alias("predicted_count")))


def per_label_scores(counts: DataFrame) -> DataFrame:
    p = _safe_div(F.col("tp"), F.col("predicted_count"))
    r = _safe_div(F.col("tp"), F.col("support"))
    return counts.withColumns({"precision": p, "recall": r}).withColumn(
        "f1_score", _safe_div(2 * F.col("precision") * F.col("recall"),
                              F.col("precision") + F.col("recall")))


def summary_metrics(counts: DataFrame, by=()) -> DataFrame:
    """accuracy, macro P/R/F1, weighted F1 per ``by`` group (wide)."""
    sc = per_label_scores(counts)
    n = F.sum("support")
    return sc.groupBy(*by).agg(
        (F.sum("tp") / n).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1_score").alias("macro_f1"),
        (F.sum(F.col("f1_score") * F.col("support")) / n).alias("weighted_f1"),
        (F.sum(F.col("precision") * F.col("support")) / n).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / n).alias("weighted_recall"),
        n.alias("n"))


def classification_report(pred: DataFrame, actual: str = "actual", predicted: str = "predicted",
                          by=()) -> DataFrame:
    """Per label precision/recall/F1/support, then ``accuracy`` (its value in
    all four columns, as the source writes it), ``macro avg`` and
    ``weighted avg`` rows."""
    counts = label_counts(pred, actual, predicted, by)
    per = per_label_scores(counts).select(*by, "label", "precision", "recall", "f1_score",
                                          F.col("support").cast("double").alias("support"))
    s = summary_metrics(counts, by)
    acc = s.select(*by, F.lit("accuracy").alias("label"),
                   *[F.col("accuracy").alias(c) for c in REPORT_COLUMNS])
    macro = s.select(*by, F.lit("macro avg").alias("label"),
                     F.col("macro_precision").alias("precision"),
                     F.col("macro_recall").alias("recall"), F.col("macro_f1").alias("f1_score"),
                     F.col("n").cast("double").alias("support"))
    weighted = s.select(*by, F.lit("weighted avg").alias("label"),
                        F.col("weighted_precision").alias("precision"),
                        F.col("weighted_recall").alias("recall"),
                        F.col("weighted_f1").alias("f1_score"),
                        F.col("n").cast("double").alias("support"))
    return per.unionByName(acc).unionByName(macro).unionByName(weighted)


def accuracy(pred: DataFrame, actual: str = "actual", predicted: str = "predicted", by=()):
    return pred.groupBy(*by).agg(F.avg((F.col(actual) == F.col(predicted)).cast("double"))
                                 .alias("accuracy"))


def metrics_summary(test_pred: DataFrame, train_pred: DataFrame, by=("model",),
                    best_cv: DataFrame | None = None, with_gap: bool = False) -> DataFrame:
    """Long ``(by..., metric, score)``: train/test accuracy, macro P/R/F1,
    weighted F1, optional best CV macro F1 and train-test gap."""
    s = summary_metrics(label_counts(test_pred, by=by), by)
    tr = accuracy(train_pred, by=by).withColumnRenamed("accuracy", "train_accuracy")
    wide = s.join(tr, list(by)).withColumnRenamed("accuracy", "test_accuracy")
    cols = ["train_accuracy", "test_accuracy", "macro_precision", "macro_recall",
            "macro_f1", "weighted_f1"]
    if best_cv is not None:
        wide = wide.join(best_cv, list(by), "left")
        cols.append("best_cv_macro_f1")
    if with_gap:
        wide = wide.withColumn("train_test_accuracy_gap",
                               F.col("train_accuracy") - F.col("test_accuracy"))
        cols.append("train_test_accuracy_gap")
    return wide.select(*by, *cols).unpivot(list(by), cols, "metric", "score")


def fold_scores(pred: DataFrame, fold: str = "fold", by=("model",), k: int = 5) -> DataFrame:
    """Per (by, fold): the five metrics on the fold (validation) and on all
    other folds (training side), the latter by subtracting fold counts from
    the totals — no refit or rescan per fold.  Totals are repeated for the k
    fold ids with a generator (no join grid)."""
    per_fold = label_counts(pred, by=(*by, fold))
    totals = per_fold.groupBy(*by, "label").agg(*[F.sum(c).alias(f"t_{c}") for c in
                                                  ("support", "tp", "predicted_count")])
    totals = totals.withColumn(fold, F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    comp = totals.join(per_fold, [*by, fold, "label"], "left").select(
        *by, fold, "label", *[(F.col(f"t_{c}") - F.coalesce(F.col(c), F.lit(0))).alias(c)
                              for c in ("support", "tp", "predicted_count")])
    # a label seen only in one fold has an all-zero complement row: drop it
    comp = comp.where((F.col("support") + F.col("predicted_count")) > 0)
    val = summary_metrics(per_fold, (*by, fold))
    trn = summary_metrics(comp, (*by, fold)).select(
        *by, fold, F.col("macro_f1").alias("train_macro_f1"))
    return val.join(trn, [*by, fold])


def cv_reliability(pred: DataFrame, fold: str = "fold", by=("model",)) -> DataFrame:
    """Mean and population std over folds of the five metrics (long form)."""
    fs = summary_metrics(label_counts(pred, by=(*by, fold)), (*by, fold))
    long = fs.select(*by, *METRICS).unpivot(list(by), METRICS, "metric", "value")
    return long.groupBy(*by, "metric").agg(F.avg("value").alias("mean"),
                                           F.stddev_pop("value").alias("std"))


def model_comparison(fs: DataFrame, candidate: str = "model") -> DataFrame:
    """One row per candidate: mean train/test score, std test (ddof=0) and
    the min-rank of the mean test score (ties share the lowest rank)."""
    agg = fs.groupBy(candidate).agg(F.avg("train_macro_f1").alias("mean_train_score"),
                                    F.avg("macro_f1").alias("mean_test_score"),
                                    F.stddev_pop("macro_f1").alias("std_test_score"))
    return rank_candidates(agg, candidate)


def rank_candidates(agg: DataFrame, candidate: str = "model",
                    score: str = "mean_test_score") -> DataFrame:
    # one row per candidate (bounded by the grid size)
    w = Window.orderBy(F.desc(F.round(score, 9)))
    return agg.withColumn("rank_test_score", F.rank().over(w).cast("int"))


def pick_best(ranked: DataFrame, candidate_order: str = "candidate_id") -> DataFrame:
    """First rank-1 candidate; ties go to grid order."""
    w = Window.orderBy("rank_test_score", candidate_order)
    return ranked.withColumn("_p", F.row_number().over(w)).where(F.col("_p") == 1).drop("_p")


def overfit_gap(metrics_long: DataFrame, by=("model",)) -> DataFrame:
    wide = metrics_long.groupBy(*by).pivot("metric", ["train_accuracy", "test_accuracy"]).agg(
        F.first("score"))
    return wide.withColumn("accuracy_gap", F.col("train_accuracy") - F.col("test_accuracy"))


LEADERBOARD_METRICS = ["train_accuracy", "test_accuracy", "train_test_accuracy_gap",
                       "macro_precision", "macro_recall", "macro_f1", "weighted_f1",
                       "best_cv_macro_f1"]


def model_leaderboard(metrics_long: DataFrame, model: str = "model") -> DataFrame:
    """Stack per-model metric tables into one ranked table (macro F1 desc,
    test accuracy desc, model name as the final tie key).  A missing gap
    falls back to train - test accuracy."""
    wide = metrics_long.groupBy(model).pivot("metric", LEADERBOARD_METRICS).agg(F.first("score"))
    wide = wide.withColumn("accuracy_gap", F.coalesce(
        F.col("train_test_accuracy_gap"), F.col("train_accuracy") - F.col("test_accuracy")))
    wide = wide.withColumnRenamed("best_cv_macro_f1", "cv_macro_f1").drop("train_test_accuracy_gap")
    w = Window.orderBy(F.desc(F.round("macro_f1", 12)), F.desc(F.round("test_accuracy", 12)), model)
    return wide.withColumn("rank", F.row_number().over(w).cast("int"))


def select_best_model(board: DataFrame, metric: str = "macro_f1", model: str = "model") -> DataFrame:
    """Rank-1 model by ``metric`` (``macro_f1`` reproduces the source, which
    selects on the held-out test set; ``cv_macro_f1`` avoids that)."""
    w = Window.orderBy(F.desc(F.round(metric, 12)), model)
    return (board.withColumn("_p", F.row_number().over(w)).where(F.col("_p") == 1)
            .select(F.col(model).alias("selected_model"), F.lit(metric).alias("selection_metric"),
                    F.col("macro_f1").alias("test_macro_f1"), "test_accuracy", "weighted_f1",
                    "cv_macro_f1"))


def align_counts(left: DataFrame, right: DataFrame, key: str, left_name: str,
                 right_name: str) -> DataFrame:
    """Outer alignment of two count tables by key, missing -> 0."""
    return (left.join(right, key, "full_outer")
            .select(key, F.coalesce(left_name, F.lit(0)).cast("bigint").alias(left_name),
                    F.coalesce(right_name, F.lit(0)).cast("bigint").alias(right_name)))
