"""Exact quantiles against NumPy: gaps, ties, hot values, empty groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from emolens.operators import eda
from emolens.operators import features as X
from emolens.operators.quantiles import exact_mode, exact_quantiles, grouped_counts, value_counts_long

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def values(seed, n):
    r = np.random.default_rng(seed)
    x = np.where(r.random(n) < 0.4, 7.0, np.round(r.normal(0, 50, n), 1))  # 7 holds two fifths
    return [None if r.random() < 0.1 else float(v) for v in x]


def table(spark, n=700):
    rows = list(zip(range(n), values(1, n), values(2, n), [["a", "b", None][i % 7 % 3] for i in range(n)], strict=True))
    return spark.createDataFrame(rows, "id long, x double, y double, g string").repartition(5)


def test_columns_match_numpy(spark):
    df = table(spark)
    got = {r["feature"]: r["q"] for r in exact_quantiles(value_counts_long(df, ["x", "y"]), ["feature"], PROBS).collect()}
    for c, seed in (("x", 1), ("y", 2)):
        assert got[c] == pytest.approx(np.quantile([v for v in values(seed, 700) if v is not None], PROBS).tolist(), abs=1e-12)


def test_groups_match_numpy(spark):
    df = table(spark)
    rows = df.collect()
    got = {r["g"]: r["q"] for r in exact_quantiles(grouped_counts(df, ["g"], "x"), ["g"], [0.5]).collect()}
    for g in ("a", "b", None):
        assert got[g][0] == pytest.approx(np.median([r.x for r in rows if r.g == g and r.x is not None]))


def test_one_value_all_null_and_empty(spark):
    df = spark.createDataFrame([(1, 5.0, None), (2, 5.0, None)], "id long, x double, y double")
    got = {r["feature"]: r["q"] for r in exact_quantiles(value_counts_long(df, ["x", "y"]), ["feature"], [0.25, 0.5]).collect()}
    assert got == {"x": [5.0, 5.0]}
    assert X.fit_medians(df, ["x", "y"]) == {"x": 5.0, "y": None}
    assert exact_quantiles(value_counts_long(df.where("id < 0"), ["x"]), ["feature"], [0.5]).count() == 0


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), (None,), (None,)], "v string")
    assert exact_mode(df, "v") == "a" and exact_mode(df.where("v is null"), "v") is None


def test_numbers_are_learned_as_by_numpy(spark):
    df = table(spark)
    got = {r["feature"]: r for r in X.fit_numbers(df, ["x", "y"]).collect()}
    for position, (c, seed) in enumerate((("x", 1), ("y", 2))):
        v = values(seed, 700)
        median = float(np.median([a for a in v if a is not None]))
        filled = np.array([median if a is None else a for a in v])
        q1, q3 = np.quantile(filled, [0.25, 0.75])
        lower, upper = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        clipped = np.clip(filled, lower, upper)
        r = got[c]
        assert r["position"] == position
        assert [r[k] for k in ("median", "lower", "upper", "lo", "hi")] == pytest.approx([median, lower, upper, clipped.min(), clipped.max()])


def test_box_and_describe_keep_every_group(spark):
    df = table(spark).unionByName(spark.createDataFrame([(9999, None, None, "empty")], "id long, x double, y double, g string"))
    box = {r["g"]: r for r in eda.box_stats(df, "x", "g").collect()}
    assert box["empty"]["q1"] is None and box["empty"]["count"] == 0
    assert sum(r["count"] for r in box.values()) == df.where("x is not null").count()
    assert {r["g"] for r in eda.group_median_order(df, "g", "x").collect()} == {"a", "b", None, "empty"}
    assert eda.describe_numeric(df.where("g = 'empty'"), ["x"]).first()["q50"] is None


def test_no_plan_gathers_a_column(spark):
    """Neither an exact percentile nor a mode over a whole column."""
    plan = exact_quantiles(value_counts_long(table(spark), ["x"]), ["feature"], [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "median" not in plan
    assert X.fit_numbers(table(spark), ["x"]).where(F.lit(False)).count() == 0
