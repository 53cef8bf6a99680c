"""Driver contract: entry smoke test and a representative oracle subset."""

import duckdb
import pytest

from tests.conftest import SF_SMALL

SUBSET = ["describe_per_key", "describe_per_key_big", "exact_dedup", "top_terms_by_class",
          "histogram", "box_stats_by_class", "stratified_split", "classification_report",
          "model_comparison", "recommend_fallback", "clf_naive_bayes", "pipeline_sparse", "predict", "pipeline_report",
          "recommend_stream", "collect_models", "vocabulary_grid", "genre_multi_hot", "iqr_bounds", "describe_numeric"]


def test_entry_runs(spark):
    from __spark_entry__ import entry

    rows = entry(spark).collect()
    assert len(rows) > 0 and set(rows[0].asDict()) == {"emotion", "count"}


def test_every_query_has_oracle_or_is_iterative():
    from __spark_entry__ import oracle_sql, queries

    from emolens.plans import catalog

    q, o = queries(), oracle_sql()
    assert set(o) <= set(q) and set(catalog.QUERIES) <= set(q) and set(catalog.ORACLE) <= set(o)
    # the training-data queries have tests of their own beside them
    rows_only = set(catalog.QUERIES) - set(catalog.ORACLE)
    assert rows_only <= {"clf_logistic", "clf_linear_svm", "clf_decision_tree", "clf_random_forest",
                         "clf_mlp", "truncated_svd", "svd_explained_variance", "svd_explained_variance_selected",
                         "svd_component_sweep", "top_k_importance",
                         "training_loss_curve", "grid_search_logistic", "predict_logistic", "pipeline_dense",
                         "pipeline_dense_scaled", "component_importance"}


@pytest.mark.parametrize("name", SUBSET)
def test_oracle_subset(spark, name):
    from __spark_entry__ import oracle_sql, queries
    from emolens.sources.fixtures import TABLES
    from scripts.oracle_check import rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sp = queries()[name](spark, SF_SMALL).toPandas()
    od = con.execute(oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(od.columns)
    assert rows_of(sp) == rows_of(od)
