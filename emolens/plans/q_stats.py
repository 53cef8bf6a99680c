"""Queries for distributions, group statistics and correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from emolens.operators import eda
from emolens.operators.describe import NUMERIC_FEATURES
from emolens.operators.terms import explode_tokens, restrict_to_top, top_k_tokens
from emolens.plans.catalog import register
from emolens.plans.q_prep import _desc, _with
from emolens.plans.sqlparts import r6

# labels of the documents stand-in (emotion = lower(lang))
DOC_LABELS = ["de", "en", "es", "fr"]
CORRELATION_FEATURES = [
    "mean_rating", "median_rating", "minimum_rating", "maximum_rating", "rating_range",
    "genre_count", "description_word_count", "description_character_count",
    "log_review_count", "log_unique_review_count",
]


@register("value_counts", _with() + " SELECT emotion, count(*) AS count FROM descriptions GROUP BY emotion")
def q_value_counts(spark, sf):
    return eda.value_counts(_desc(spark, sf), "emotion")


@register("value_counts_big", _with("big") + " SELECT emotion, count(*) AS count FROM descriptions GROUP BY emotion")
def q_value_counts_big(spark, sf):
    return eda.value_counts(_desc(spark, sf, "big"), "emotion")


@register("value_shares", _with() + f""", c AS (SELECT emotion, count(*) AS count FROM descriptions GROUP BY emotion)
 SELECT emotion, count, {r6('count * 100.0 / (SELECT sum(count) FROM c)')} AS percent FROM c""")
def q_value_shares(spark, sf):
    return eda.value_shares(_desc(spark, sf), "emotion")


_LONG = """,
 long AS (SELECT d.*, coalesce(t.genre_token, 'unknown_genre') AS genre_token FROM descriptions d
   LEFT JOIN LATERAL (SELECT unnest(regexp_extract_all(d.genres_text, '\\S+')) AS genre_token) t ON true),
 top AS (SELECT genre_token, count(*) AS c FROM long GROUP BY genre_token ORDER BY c DESC, genre_token LIMIT {k}),
 major AS (SELECT * FROM long WHERE genre_token IN (SELECT genre_token FROM top))"""


def _major(spark, sf, k):
    long = explode_tokens(_desc(spark, sf))
    return restrict_to_top(long, top_k_tokens(long, k=k))


@register("group_mean_nunique", _with() + _LONG.format(k=12) + f"""
 SELECT genre_token, {r6('avg(mean_rating)')} AS mean_rating, count(DISTINCT Description) AS description_count
 FROM major GROUP BY genre_token""")
def q_group_mean_nunique(spark, sf):
    """Mean rating and distinct descriptions per major genre token."""
    return eda.group_mean_nunique(_major(spark, sf, 12), "genre_token", "mean_rating", "Description")


@register("group_median_order", _with("big") + f""", m AS (SELECT emotion, quantile_cont(mean_rating, 0.5) AS median_value
 FROM descriptions GROUP BY emotion)
 SELECT emotion, {r6('median_value')} AS median_value,
   row_number() OVER (ORDER BY round(median_value, 9), emotion) AS position FROM m""")
def q_group_median_order(spark, sf):
    return eda.group_median_order(_desc(spark, sf, "big"), "emotion", "mean_rating")


@register("crosstab", _with() + _LONG.format(k=12) + " SELECT genre_token, "
          + ", ".join(f"count(*) FILTER (WHERE emotion = '{v}') AS {v}" for v in DOC_LABELS)
          + " FROM major GROUP BY genre_token")
def q_crosstab(spark, sf):
    """Top-12 genre tokens x emotion counts, zero-filled."""
    return eda.crosstab(_major(spark, sf, 12), "genre_token", "emotion", DOC_LABELS)


_FEATS = NUMERIC_FEATURES


@register("describe_numeric", _with("big") + ", long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM descriptions" for c in _FEATS) + f""")
 SELECT feature, count(value) AS count, {r6('avg(value)')} AS mean, {r6('stddev_samp(value)')} AS std,
   {r6('min(value)')} AS min, {r6('quantile_cont(value, 0.25)')} AS q25,
   {r6('quantile_cont(value, 0.5)')} AS q50, {r6('quantile_cont(value, 0.75)')} AS q75,
   {r6('max(value)')} AS max FROM long GROUP BY feature""")
def q_describe_numeric(spark, sf):
    """count/mean/std/min/quartiles/max of the 8 model features."""
    return eda.describe_numeric(_desc(spark, sf, "big"), _FEATS)


@register("correlation_pair", _with() + f""" SELECT {r6("CASE WHEN isnan(corr(description_word_count, mean_rating)) THEN NULL ELSE corr(description_word_count, mean_rating) END")} AS correlation
 FROM descriptions""")
def q_corr_pair(spark, sf):
    return eda.correlation_pair(_desc(spark, sf), "description_word_count", "mean_rating")


def _corr_sql():
    parts = []
    for a in CORRELATION_FEATURES:
        for b in CORRELATION_FEATURES:
            x, y = sorted([a, b], key=CORRELATION_FEATURES.index)
            parts.append(f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, "
                         f"{r6(f'CASE WHEN isnan(corr({x}, {y})) THEN NULL ELSE corr({x}, {y}) END')}"
                         " AS correlation FROM descriptions")
    return _with("big") + " " + " UNION ALL ".join(parts)


@register("correlation_matrix", _corr_sql())
def q_corr_matrix(spark, sf):
    """10 x 10 Pearson matrix, long form (a constant column gives NULL)."""
    return eda.correlation_matrix(_desc(spark, sf, "big"), CORRELATION_FEATURES)


def _hist_sql(kind, column, bins):
    return _with(kind) + f""", b AS (SELECT
   CASE WHEN min({column}) = max({column}) THEN min({column}) - 0.5 ELSE min({column}) END AS lo,
   CASE WHEN min({column}) = max({column}) THEN max({column}) + 0.5 ELSE max({column}) END AS hi
   FROM descriptions),
 w AS (SELECT lo, (hi - lo) / {float(bins)} AS width FROM b),
 c AS (SELECT CAST(least(floor((CAST({column} AS DOUBLE) - lo) / width), {bins - 1}) AS BIGINT) AS bin,
   count(*) AS n FROM descriptions, w WHERE {column} IS NOT NULL GROUP BY 1),
 g AS (SELECT range AS bin FROM range(0, {bins}))
 SELECT g.bin, {r6('lo + g.bin * width')} AS bin_lower, {r6('lo + (g.bin + 1) * width')} AS bin_upper,
   CAST(coalesce(c.n, 0) AS BIGINT) AS count FROM g CROSS JOIN w LEFT JOIN c ON g.bin = c.bin"""


@register("histogram", _hist_sql("big", "mean_rating", 20))
def q_hist(spark, sf):
    """20 equal-width bins of the mean rating."""
    return eda.histogram(_desc(spark, sf, "big"), "mean_rating", 20)


@register("histogram_word_count", _hist_sql("documents", "description_word_count", 30))
def q_hist_words(spark, sf):
    return eda.histogram(_desc(spark, sf), "description_word_count", 30)


@register("histogram_review_count", _hist_sql("big", "review_count", 35))
def q_hist_reviews(spark, sf):
    return eda.histogram(_desc(spark, sf, "big"), "review_count", 35)


@register("discrete_histogram", _with() + " SELECT genre_count, count(*) AS count FROM descriptions GROUP BY genre_count")
def q_discrete_hist(spark, sf):
    return eda.discrete_histogram(_desc(spark, sf), "genre_count")


_BOX_TAIL = f"""
 SELECT {{keysel}} {r6('q1')} AS q1, {r6('median')} AS median, {r6('q3')} AS q3,
   {r6('lower_fence')} AS lower_fence, {r6('upper_fence')} AS upper_fence,
   {r6('min(CASE WHEN v >= lower_fence AND v <= upper_fence THEN v END)')} AS whisker_low,
   {r6('max(CASE WHEN v >= lower_fence AND v <= upper_fence THEN v END)')} AS whisker_high,
   count(*) FILTER (WHERE v IS NOT NULL AND NOT (v >= lower_fence AND v <= upper_fence)) AS outliers,
   count(v) AS count
 FROM j GROUP BY {{keygrp}} q1, median, q3, lower_fence, upper_fence"""


def _box_sql(by):
    keys = f"{by}, " if by else ""
    q = f"""q AS (SELECT {keys} quantile_cont(mean_rating, 0.25) AS q1, quantile_cont(mean_rating, 0.5) AS median,
   quantile_cont(mean_rating, 0.75) AS q3 FROM descriptions {'GROUP BY ' + by if by else ''}),
 f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q),
 j AS (SELECT {'d.' + by + ', ' if by else ''}d.mean_rating AS v, f.q1, f.median, f.q3, f.lower_fence, f.upper_fence
   FROM descriptions d {'JOIN f ON d.' + by + ' = f.' + by if by else 'CROSS JOIN f'})"""
    return _with("big") + ", " + q + _BOX_TAIL.format(keysel=keys, keygrp=keys)


@register("box_stats", _box_sql(None))
def q_box(spark, sf):
    """Box-plot numbers of the mean rating over all descriptions."""
    return eda.box_stats(_desc(spark, sf, "big"), "mean_rating")


@register("box_stats_by_class", _box_sql("emotion"))
def q_box_by(spark, sf):
    return eda.box_stats(_desc(spark, sf, "big"), "mean_rating", "emotion")
