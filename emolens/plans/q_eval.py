"""Queries for evaluation, comparison, ranking and model selection
(SURVEY §2.6, §2.7, §2.10 model_comparison, §2.11).

Input: predictions of three simple rule-based classifiers over every
document (actual = language), with a hash-based train/test flag and fold.
They stand in for the six model exports, whose prediction files are the
reference's goldens (those are checked in the unit tests).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from emolens.operators import evaluate as E
from emolens.plans.catalog import register
from emolens.plans.sqlparts import r6
from emolens.sources.fixtures import table

MODELS = ["length_rule", "majority", "source_rule"]
FOLDS = 5


def predictions(spark, sf):
    """(model, doc_id, split, fold, actual, predicted) for every document."""
    d = table(spark, sf, "documents")
    n = F.col("n_chars")
    lang = F.col("lang")
    rules = {
        "majority": F.lit("en"),
        "length_rule": F.when(n % 5 == 0, "en").when(n % 5 == 1, "fr").otherwise(lang),
        "source_rule": F.when(F.expr("substring(source, 4)").cast("int") % 4 == 0, "de").otherwise(lang),
    }
    h = F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string")))
    fold_h = F.md5(F.concat(F.lit("7:"), F.col("doc_id").cast("string")))
    return d.select(
        "doc_id", lang.alias("actual"),
        F.when(F.substring(h, 1, 2) < "34", "test").otherwise("train").alias("split"),
        (F.conv(F.substring(fold_h, 1, 1), 16, 10).cast("int") % FOLDS).alias("fold"),
        F.inline(F.array(*[F.struct(F.lit(m).alias("model"), r.alias("predicted"))
                           for m, r in rules.items()])))


PRED_SQL = f"""p AS (
 SELECT m.model, d.doc_id, d.lang AS actual,
   CASE WHEN substr(md5('42:' || d.doc_id), 1, 2) < '34' THEN 'test' ELSE 'train' END AS split,
   CAST((strpos('0123456789abcdef', substr(md5('7:' || d.doc_id), 1, 1)) - 1) % {FOLDS} AS INTEGER) AS fold,
   CASE m.model WHEN 'majority' THEN 'en'
     WHEN 'length_rule' THEN CASE d.n_chars % 5 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' ELSE d.lang END
     ELSE CASE WHEN CAST(substr(d.source, 4) AS INTEGER) % 4 = 0 THEN 'de' ELSE d.lang END END AS predicted
 FROM documents d CROSS JOIN (VALUES {", ".join(f"('{m}')" for m in MODELS)}) m(model)),
 te AS (SELECT * FROM p WHERE split = 'test'),
 tr AS (SELECT * FROM p WHERE split = 'train')"""


def lc_sql(src: str, by: str) -> str:
    return f"""(SELECT {by}, label, sum(s) AS support, sum(tp) AS tp, sum(pc) AS predicted_count FROM (
   SELECT {by}, actual AS label, 1 AS s, CASE WHEN actual = predicted THEN 1 ELSE 0 END AS tp, 0 AS pc FROM {src}
   UNION ALL SELECT {by}, predicted AS label, 0 AS s, 0 AS tp, 1 AS pc FROM {src}) GROUP BY {by}, label)"""


def scores_sql(lc: str) -> str:
    return f"""(SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1
 FROM (SELECT *, CASE WHEN predicted_count = 0 THEN 0.0 ELSE tp / predicted_count END AS precision,
   CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM {lc}))"""


def summary_sql(sc: str, by: str) -> str:
    return f"""(SELECT {by}, sum(tp) / sum(support) AS accuracy, avg(precision) AS macro_precision,
   avg(recall) AS macro_recall, avg(f1) AS macro_f1, sum(f1 * support) / sum(support) AS weighted_f1,
   sum(precision * support) / sum(support) AS weighted_precision,
   sum(recall * support) / sum(support) AS weighted_recall, sum(support) AS n FROM {sc} GROUP BY {by})"""


def _train_test(spark, sf):
    p = predictions(spark, sf)
    return p.where(F.col("split") == "train"), p.where(F.col("split") == "test")


@register("confusion_matrix", f"WITH {PRED_SQL} SELECT model, actual, predicted, count(*) AS count FROM te GROUP BY ALL")
def q_confusion(spark, sf):
    _, te = _train_test(spark, sf)
    return E.confusion_long(te, by=("model",))


@register("confusion_matrix_wide", f"""WITH {PRED_SQL} SELECT actual, """
          + ", ".join(f"count(*) FILTER (WHERE predicted = '{v}') AS {v}" for v in ["de", "en", "es", "fr"])
          + " FROM te WHERE model = 'length_rule' GROUP BY actual")
def q_confusion_wide(spark, sf):
    _, te = _train_test(spark, sf)
    return E.confusion_matrix(te.where(F.col("model") == "length_rule"), ["de", "en", "es", "fr"])


_REPORT_FROM_TE = f""", sc AS {scores_sql(lc_sql('te', 'model'))}, sm AS {summary_sql('sc', 'model')}
 SELECT model, label, {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1')} AS f1_score,
   {r6('support')} AS support FROM sc
 UNION ALL SELECT model, 'accuracy', {r6('accuracy')}, {r6('accuracy')}, {r6('accuracy')}, {r6('accuracy')} FROM sm
 UNION ALL SELECT model, 'macro avg', {r6('macro_precision')}, {r6('macro_recall')}, {r6('macro_f1')}, {r6('n')} FROM sm
 UNION ALL SELECT model, 'weighted avg', {r6('weighted_precision')}, {r6('weighted_recall')}, {r6('weighted_f1')}, {r6('n')} FROM sm"""
_REPORT_SQL = f"WITH {PRED_SQL}" + _REPORT_FROM_TE


@register("classification_report", _REPORT_SQL)
def q_report(spark, sf):
    """Per-label report plus accuracy / macro / weighted rows, per model."""
    _, te = _train_test(spark, sf)
    return E.classification_report(te, by=("model",))


_FOLD_SQL = f""", pf AS {lc_sql('tr', 'model, fold')},
 tot AS (SELECT model, label, sum(support) AS ts, sum(tp) AS ttp, sum(predicted_count) AS tpc FROM pf GROUP BY model, label),
 tf AS (SELECT t.*, f.fold FROM tot t CROSS JOIN range(0, {FOLDS}) f(fold)),
 comp AS (SELECT tf.model, tf.fold, tf.label, ts - coalesce(pf.support, 0) AS support, ttp - coalesce(pf.tp, 0) AS tp,
   tpc - coalesce(pf.predicted_count, 0) AS predicted_count FROM tf LEFT JOIN pf USING (model, fold, label)
   WHERE (ts - coalesce(pf.support, 0)) + (tpc - coalesce(pf.predicted_count, 0)) > 0),
 val AS {summary_sql(scores_sql('pf'), 'model, fold')},
 trn AS {summary_sql(scores_sql('comp'), 'model, fold')},
 fs AS (SELECT val.*, trn.macro_f1 AS train_macro_f1 FROM val JOIN trn USING (model, fold)),
 cv AS (SELECT model, avg(macro_f1) AS best_cv_macro_f1 FROM fs GROUP BY model)"""


def _metrics_long_sql():
    return f"""WITH {PRED_SQL}, sm AS {summary_sql(scores_sql(lc_sql('te', 'model')), 'model')},
 tra AS (SELECT model, avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END) AS train_accuracy FROM tr GROUP BY model)
 {_FOLD_SQL},
 wide AS (SELECT sm.*, tra.train_accuracy, cv.best_cv_macro_f1 FROM sm JOIN tra USING (model) JOIN cv USING (model)),
 ml AS (
   SELECT model, 'train_accuracy' AS metric, train_accuracy AS score FROM wide
   UNION ALL SELECT model, 'test_accuracy', accuracy FROM wide
   UNION ALL SELECT model, 'macro_precision', macro_precision FROM wide
   UNION ALL SELECT model, 'macro_recall', macro_recall FROM wide
   UNION ALL SELECT model, 'macro_f1', macro_f1 FROM wide
   UNION ALL SELECT model, 'weighted_f1', weighted_f1 FROM wide
   UNION ALL SELECT model, 'best_cv_macro_f1', best_cv_macro_f1 FROM wide
   UNION ALL SELECT model, 'train_test_accuracy_gap', train_accuracy - accuracy FROM wide WHERE model = 'length_rule')"""


def metrics_long(spark, sf):
    """Per-model metrics; only ``length_rule`` reports its gap (as only
    three of the six source models do)."""
    tr, te = _train_test(spark, sf)
    cv = E.fold_scores(tr, k=FOLDS).groupBy("model").agg(F.avg("macro_f1").alias("best_cv_macro_f1"))
    ml = E.metrics_summary(te, tr, ("model",), best_cv=cv, with_gap=True)
    return ml.where((F.col("metric") != "train_test_accuracy_gap") | (F.col("model") == "length_rule"))


@register("metrics_summary", _metrics_long_sql() + f" SELECT model, metric, {r6('score')} AS score FROM ml")
def q_metrics(spark, sf):
    return metrics_long(spark, sf)


@register("round_display", _metrics_long_sql() + " SELECT model, metric, round(score, 4) AS score FROM ml")
def q_round(spark, sf):
    """Metrics rounded to 4 decimals for display."""
    return metrics_long(spark, sf).withColumn("score", F.round("score", 4))


@register("cv_reliability", f"""WITH {PRED_SQL}, fsum AS {summary_sql(scores_sql(lc_sql('tr', 'model, fold')), 'model, fold')},
 long AS (SELECT model, 'accuracy' AS metric, accuracy AS v FROM fsum UNION ALL SELECT model, 'macro_precision', macro_precision FROM fsum
   UNION ALL SELECT model, 'macro_recall', macro_recall FROM fsum UNION ALL SELECT model, 'macro_f1', macro_f1 FROM fsum
   UNION ALL SELECT model, 'weighted_f1', weighted_f1 FROM fsum)
 SELECT model, metric, {r6('avg(v)')} AS mean, {r6('stddev_pop(v)')} AS std FROM long GROUP BY model, metric""")
def q_cv(spark, sf):
    """Five-fold mean and population std of five metrics, per model."""
    tr, _ = _train_test(spark, sf)
    return E.cv_reliability(tr)


@register("model_comparison", f"""WITH {PRED_SQL} {_FOLD_SQL},
 agg AS (SELECT model, avg(train_macro_f1) AS mean_train_score, avg(macro_f1) AS mean_test_score,
   stddev_pop(macro_f1) AS std_test_score FROM fs GROUP BY model)
 SELECT model, {r6('mean_train_score')} AS mean_train_score, {r6('mean_test_score')} AS mean_test_score,
   {r6('std_test_score')} AS std_test_score,
   CAST(rank() OVER (ORDER BY round(mean_test_score, 9) DESC) AS INTEGER) AS rank_test_score FROM agg""")
def q_comparison(spark, sf):
    """Per candidate: mean train / validation macro F1 over folds (train side
    from count subtraction), std, min-rank."""
    tr, _ = _train_test(spark, sf)
    return E.model_comparison(E.fold_scores(tr, k=FOLDS))


@register("rank_candidates", f"""WITH {PRED_SQL} {_FOLD_SQL}
 SELECT model, fold, CAST(rank() OVER (PARTITION BY fold ORDER BY round(macro_f1, 9) DESC) AS INTEGER) AS rank_test_score FROM fs""")
def q_rank_candidates(spark, sf):
    """Min-rank of candidates within each fold (ties share the lowest rank)."""
    tr, _ = _train_test(spark, sf)
    fs = E.fold_scores(tr, k=FOLDS)
    from pyspark.sql import Window
    w = Window.partitionBy("fold").orderBy(F.desc(F.round("macro_f1", 9)))
    return fs.select("model", "fold", F.rank().over(w).cast("int").alias("rank_test_score"))


@register("pick_best", f"""WITH {PRED_SQL} {_FOLD_SQL},
 agg AS (SELECT model, avg(macro_f1) AS mean_test_score FROM fs GROUP BY model),
 rk AS (SELECT *, rank() OVER (ORDER BY round(mean_test_score, 9) DESC) AS rank_test_score FROM agg)
 SELECT model, {r6('mean_test_score')} AS mean_test_score FROM rk
 QUALIFY row_number() OVER (ORDER BY rank_test_score, model) = 1""")
def q_pick_best(spark, sf):
    tr, _ = _train_test(spark, sf)
    ranked = E.model_comparison(E.fold_scores(tr, k=FOLDS))
    return E.pick_best(ranked, "model").select("model", "mean_test_score")


_BOARD_SQL = _metrics_long_sql() + """,
 w AS (PIVOT ml ON metric IN ('train_accuracy', 'test_accuracy', 'train_test_accuracy_gap', 'macro_precision',
   'macro_recall', 'macro_f1', 'weighted_f1', 'best_cv_macro_f1') USING first(score) GROUP BY model),
 board AS (SELECT model, train_accuracy, test_accuracy,
   coalesce(train_test_accuracy_gap, train_accuracy - test_accuracy) AS accuracy_gap,
   macro_precision, macro_recall, macro_f1, weighted_f1, best_cv_macro_f1 AS cv_macro_f1,
   CAST(row_number() OVER (ORDER BY round(macro_f1, 12) DESC, round(test_accuracy, 12) DESC, model) AS INTEGER) AS rank FROM w)"""


def _board(spark, sf):
    return E.model_leaderboard(metrics_long(spark, sf))


_BOARD_COLS = ["train_accuracy", "test_accuracy", "accuracy_gap", "macro_precision", "macro_recall",
               "macro_f1", "weighted_f1", "cv_macro_f1"]


@register("model_leaderboard", _BOARD_SQL + " SELECT model, rank, " + ", ".join(
    f"{r6(c)} AS {c}" for c in _BOARD_COLS) + " FROM board")
def q_board(spark, sf):
    """Models ranked by macro F1 then test accuracy, one row each."""
    return _board(spark, sf).select("model", "rank", *_BOARD_COLS)


@register("leaderboard_rank", _BOARD_SQL + " SELECT model, rank FROM board")
def q_board_rank(spark, sf):
    return _board(spark, sf).select("model", "rank")


@register("metric_fallback", _BOARD_SQL + f" SELECT model, {r6('accuracy_gap')} AS accuracy_gap FROM board")
def q_fallback(spark, sf):
    """The reported gap where present, else train - test accuracy."""
    return _board(spark, sf).select("model", "accuracy_gap")


@register("overfit_gap", _metrics_long_sql() + f""", w2 AS (SELECT model,
   first(score) FILTER (WHERE metric = 'train_accuracy') AS train_accuracy,
   first(score) FILTER (WHERE metric = 'test_accuracy') AS test_accuracy FROM ml GROUP BY model)
 SELECT model, {r6('train_accuracy')} AS train_accuracy, {r6('test_accuracy')} AS test_accuracy,
   {r6('train_accuracy - test_accuracy')} AS accuracy_gap FROM w2""")
def q_gap(spark, sf):
    return E.overfit_gap(metrics_long(spark, sf))


@register("select_best_model", _BOARD_SQL + f""" SELECT model AS selected_model, 'macro_f1' AS selection_metric,
 {r6('macro_f1')} AS test_macro_f1, {r6('test_accuracy')} AS test_accuracy, {r6('weighted_f1')} AS weighted_f1,
 {r6('cv_macro_f1')} AS cv_macro_f1 FROM board QUALIFY row_number() OVER (ORDER BY round(macro_f1, 12) DESC, model) = 1""")
def q_select_best(spark, sf):
    return E.select_best_model(_board(spark, sf), "macro_f1")


@register("select_best_model_cv", _BOARD_SQL + f""" SELECT model AS selected_model, 'cv_macro_f1' AS selection_metric,
 {r6('macro_f1')} AS test_macro_f1, {r6('test_accuracy')} AS test_accuracy, {r6('weighted_f1')} AS weighted_f1,
 {r6('cv_macro_f1')} AS cv_macro_f1 FROM board QUALIFY row_number() OVER (ORDER BY round(cv_macro_f1, 12) DESC, model) = 1""")
def q_select_best_cv(spark, sf):
    """Selection on cross-validated macro F1 (no test-set leakage)."""
    return E.select_best_model(_board(spark, sf), "cv_macro_f1")


@register("prediction_counts", f"WITH {PRED_SQL} SELECT model, split, count(*) AS rows FROM p GROUP BY model, split")
def q_prediction_counts(spark, sf):
    """Predictions of all models, counted per model and split."""
    p = predictions(spark, sf)
    return p.groupBy("model", "split").agg(F.count(F.lit(1)).alias("rows"))


@register("align_on_key", f"""WITH {PRED_SQL},
 a AS (SELECT actual, count(*) AS train_count FROM tr WHERE model = 'majority' GROUP BY actual),
 b AS (SELECT actual, count(*) AS test_count FROM te WHERE model = 'majority' GROUP BY actual)
 SELECT coalesce(a.actual, b.actual) AS actual, CAST(coalesce(train_count, 0) AS BIGINT) AS train_count,
   CAST(coalesce(test_count, 0) AS BIGINT) AS test_count FROM a FULL OUTER JOIN b ON a.actual = b.actual""")
def q_align(spark, sf):
    """Train vs test class counts aligned by class, missing -> 0."""
    tr, te = _train_test(spark, sf)
    a = tr.where(F.col("model") == "majority").groupBy("actual").agg(F.count(F.lit(1)).alias("train_count"))
    b = (te.where(F.col("model") == "majority")
         .groupBy("actual").agg(F.count(F.lit(1)).alias("test_count")))
    return E.align_counts(a, b, "actual", "train_count", "test_count")
