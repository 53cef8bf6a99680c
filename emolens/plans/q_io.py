"""Queries for sources and sinks.

Each writes data derived from the test tables into a fresh folder under the
session's checkpoint directory (the shared folder on a cluster), reads it
back through the matching reader and returns what was read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from emolens.plans.catalog import register
from emolens.plans.q_eval import _BOARD_COLS, _BOARD_SQL, _REPORT_SQL, MODELS, _metrics_long_sql, metrics_long
from emolens.plans.q_prep import DESCRIPTION_SELECT, _desc, _with  # noqa: F401
from emolens.plans.sqlparts import list_literal as sql_list_literal
from emolens.plans.sqlparts import r6
from emolens.session import cut_lineage, ensure_checkpoint_dir
from emolens.sources import io
from emolens.sources.fixtures import RAW_REVIEWS_SQL, raw_reviews


def scratch(spark, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/io/{name}-{uuid.uuid4().hex[:12]}"


@register("read_reviews_csv", RAW_REVIEWS_SQL)
def q_read_csv(spark, sf):
    """Raw reviews written as multi-line CSV and read back with the
    explicit schema and null spellings (whole texts survive the trip)."""
    path = scratch(spark, "raw-csv")
    io.write_reviews_csv(raw_reviews(spark, sf), path)
    return io.read_reviews_csv(spark, path)


@register("write_descriptions", _with() + " SELECT Description, " + sql_list_literal("genre_list")
          + " AS genre_list FROM descriptions")
def q_write_desc(spark, sf):
    """Description table to CSV (list rendered as ['a', 'b']) and back."""
    path = scratch(spark, "desc-csv")
    io.write_descriptions(_desc(spark, sf), path, fmt="csv")
    back = spark.read.options(**io.CSV_OPTIONS).csv(path)
    return back.select("Description", "genre_list")


_METRICS = ["best_cv_macro_f1", "macro_f1", "macro_precision", "macro_recall", "test_accuracy",
            "train_accuracy", "train_test_accuracy_gap", "weighted_f1"]


@register("read_metrics_long", _metrics_long_sql() + " SELECT model, " + ", ".join(
    f"{r6(f'first(score) FILTER (WHERE metric = {chr(39)}{m}{chr(39)})')} AS {m}" for m in _METRICS)
    + " FROM ml GROUP BY model")
def q_read_metrics(spark, sf):
    """Per-model (metric, score) CSV read back and pivoted to one row each."""
    path = scratch(spark, "metrics-csv")
    io.write_results(metrics_long(spark, sf), path, fmt="csv")
    return io.read_metrics_long(spark, path).select("model", *_METRICS)


@register("read_summary_json", _metrics_long_sql() + f""" SELECT model, 42 AS random_state,
 {r6("first(score) FILTER (WHERE metric = 'macro_f1')")} AS macro_f1, CAST(count(*) AS INTEGER) AS n_metrics FROM ml GROUP BY model""")
def q_read_summary(spark, sf):
    """Model summaries with nested parameters and metrics, JSON round trip."""
    ml = metrics_long(spark, sf)
    summ = ml.groupBy("model").agg(F.map_from_entries(F.collect_list(F.struct("metric", "score")))
                                   .alias("metrics")).select(
        "model", F.lit(42).alias("random_state"),
        F.create_map(F.lit("rule"), F.col("model")).alias("best_parameters"), "metrics")
    path = scratch(spark, "summary-json")
    io.write_results(summ, path, fmt="json")
    back = io.read_summary_json(spark, path, multi_line=False)
    return back.select("model", "random_state", F.col("metrics")["macro_f1"].alias("macro_f1"),
                       F.size("metrics").alias("n_metrics"))


@register("write_results", _REPORT_SQL)
def q_write_results(spark, sf):
    """Classification report written as Parquet and read back."""
    from emolens.plans.q_eval import _train_test
    from emolens.operators.evaluate import classification_report
    _, te = _train_test(spark, sf)
    path = scratch(spark, "report-parquet")
    io.write_results(classification_report(te, by=("model",)), path, fmt="parquet")
    return spark.read.parquet(path)


#: What each model of the stand-in was set to; every family has its own names.
_SETTINGS = {"majority": {"label": "en"}, "length_rule": {"modulus": 5}, "source_rule": {"modulus": 4, "kept": "lang"}}


@register("collect_models", _BOARD_SQL + " SELECT model, rank, " + ", ".join(f"{r6(c)} AS {c}" for c in _BOARD_COLS) + """,
 CASE model WHEN 'majority' THEN 'en' END AS param_label, CASE model WHEN 'length_rule' THEN 5 WHEN 'source_rule' THEN 4 END AS param_modulus,
 CASE model WHEN 'source_rule' THEN 'lang' END AS param_kept FROM board""")
def q_collect(spark, sf):
    """Each model's metrics and parameters written to a folder of its own,
    all folders read together: one ranked row per model, the missing gaps
    filled."""
    base = scratch(spark, "results")
    ml = cut_lineage(metrics_long(spark, sf))
    for m in MODELS:  # a folder per model
        io.write_model_result(ml.where(F.col("model") == m).drop("model"), base, m, _SETTINGS[m])
    params = [f"param_{p}" for p in ("label", "modulus", "kept")]
    return io.collect_model_results(spark, base).select("model", "rank", *_BOARD_COLS, *params)
