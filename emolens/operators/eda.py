"""Distributions, group statistics and correlations.

These operators produce the numbers behind the source's charts.  Global
scalars (totals, min/max) are scalar subqueries, so no operator needs a cross
join or a single-partition window over raw rows; windows only run over
already-aggregated, category-sized results.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emolens.operators.quantiles import exact_quantiles, grouped_counts, value_counts_long

QUARTILES = [0.25, 0.5, 0.75]


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Category counts, largest first (ties by category)."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.desc(name), F.asc(column)))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Counts with their percentage of the total (total is a scalar subquery)."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.select(F.sum("count")).scalar()
    return counts.withColumn("percent", F.col("count") * 100.0 / total)


def group_mean_nunique(df: DataFrame, by: str, mean_of: str, nunique_of: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(mean_of).alias(mean_of),
                              F.count_distinct(nunique_of).alias("description_count"))


def group_median_order(df: DataFrame, by: str, value: str) -> DataFrame:
    """Categories with their median, ranked by it (the box-plot order)."""
    mid = exact_quantiles(grouped_counts(df, [by], value), [by], [0.5]).select(F.col(by).alias("_by"), "q")
    groups = df.select(by).distinct()  # a group without a value has a null median
    med = groups.join(mid, F.col(by).eqNullSafe(F.col("_by")), "left").select(by, F.col("q")[0].alias("median_value"))
    # rank on the value rounded to 9 decimals so float noise cannot split ties
    w = Window.orderBy(F.round("median_value", 9), by)
    return med.withColumn("position", F.row_number().over(w).cast("bigint"))


def crosstab(df: DataFrame, row: str, col: str, values=None) -> DataFrame:
    """Zero-filled contingency table; one column per ``col`` value.

    Passing ``values`` avoids the extra job that discovers them.
    """
    piv = df.groupBy(row).pivot(col, values) if values is not None else df.groupBy(row).pivot(col)
    return piv.agg(F.count(F.lit(1))).na.fill(0)


def describe_numeric(df: DataFrame, columns) -> DataFrame:
    """count, mean, std (ddof=1), min, quartiles, max per numeric column.

    Long form, one row per feature.  Quartiles are exact (linear
    interpolation), from value counts; a column is never gathered in one task.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "value")
    moments = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(value_counts_long(df, columns), ["feature"], QUARTILES)
    return moments.join(q, "feature", "left").select(
        "feature", "count", "mean", "std", "min", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"), "max")


def pearson(x: str, y: str):
    """Pearson r over the rows that have both values; NULL (not an ANSI
    divide error) for a constant column."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))


def correlation_pair(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(pearson(x, y).alias("correlation"))


def correlation_matrix(df: DataFrame, columns) -> DataFrame:
    """Pearson matrix in long form ``(feature_x, feature_y, correlation)``.

    Every row gives its upper triangle (incl. diagonal) as rows of (pair, x,
    y), and one small aggregate per pair takes them, combined map-side: all
    pairs as columns of one aggregate made methods too long to be compiled.
    The lower triangle is mirrored.  A constant column gives NULL.
    """
    pairs = list(combinations_with_replacement(list(columns), 2))
    cells = F.array(*[F.struct(F.lit(i).alias("pair"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
                      for i, (a, b) in enumerate(pairs)])
    by_pair = df.select(F.inline(cells)).groupBy("pair").agg(pearson("x", "y").alias("r"))
    # one row per pair
    row = by_pair.agg(F.map_from_entries(F.collect_list(F.struct("pair", "r"))).alias("r"))
    entries = []
    for i, (a, b) in enumerate(pairs):
        r = F.try_element_at("r", F.lit(i)).alias("correlation")
        entries.append(F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"), r))
        if a != b:
            entries.append(F.struct(F.lit(b).alias("feature_x"), F.lit(a).alias("feature_y"), r))
    return row.select(F.inline(F.array(*entries)))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed on the right.

    Output ``(bin, bin_lower, bin_upper, count)`` with empty bins as 0.  A
    constant column uses [v-0.5, v+0.5] like NumPy.
    """
    x = F.col(column).cast("double")
    bounds = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).select(F.struct(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )).scalar()
    lo_s, hi_s = bounds["lo"], bounds["hi"]
    width = (hi_s - lo_s) / F.lit(float(bins))
    b = F.least(F.floor((x - lo_s) / width), F.lit(bins - 1)).cast("bigint")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin", (lo_s + F.col("bin") * width).alias("bin_lower"),
                    (lo_s + (F.col("bin") + 1) * width).alias("bin_upper"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def discrete_histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(column)


def box_stats(df: DataFrame, value: str, by: str | None = None, factor: float = 1.5) -> DataFrame:
    """Box-plot numbers: quartiles, whiskers (furthest point within
    ``factor`` IQR of the box), outlier count — overall or per category."""
    if by is None:
        return box_stats(df.withColumn("_whole", F.lit(0)), value, "_whole", factor).drop("_whole")
    counts = grouped_counts(df, [by], value)
    spread = factor * (F.col("q")[2] - F.col("q")[0])
    q = exact_quantiles(counts, [by], QUARTILES).select(
        F.col(by).alias("_by"), F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
        (F.col("q")[0] - spread).alias("lower_fence"), (F.col("q")[2] + spread).alias("upper_fence"))
    box = ["q1", "median", "q3", "lower_fence", "upper_fence"]
    # whiskers and outliers need no second scan: the counts hold every value
    j = counts.join(q, F.col(by).eqNullSafe(F.col("_by")), "left")
    v, n = F.col("value"), F.col("n")
    inside = (v >= F.col("lower_fence")) & (v <= F.col("upper_fence"))
    return j.groupBy(by, *box).agg(
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.coalesce(F.sum(F.when(v.isNotNull() & ~inside, n)), F.lit(0)).alias("outliers"),
        F.coalesce(F.sum(F.when(v.isNotNull(), n)), F.lit(0)).alias("count"))


def profile_counts(df: DataFrame, key: str, label: str) -> DataFrame:
    """Repetition profile of a key: distinct values, values repeated at
    least once, surplus copies, max copies, values with > 1 label."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                            F.count_distinct(label).alias("labels"))
    return g.agg(
        F.count(F.lit(1)).alias("distinct_values"),
        F.count_if(F.col("n") > 1).alias("repeated_values"),
        F.sum(F.col("n") - 1).cast("bigint").alias("surplus_rows"),
        F.max("n").alias("max_copies"),
        F.count_if(F.col("labels") > 1).alias("multi_label_values"),
    )


def missing_audit(df: DataFrame) -> DataFrame:
    """Per column: NULL count and blank-string count (0 for non-strings).

    One aggregate over the table, reshaped into ``(column, missing_count,
    blank_count)`` rows.
    """
    string_cols = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    aggs = []
    for c in df.columns:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"m_{c}"))
        blank = F.count_if(F.trim(F.col(c)) == "") if c in string_cols else F.lit(0).cast("bigint")
        aggs.append(blank.alias(f"b_{c}"))
    row = df.agg(*aggs)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").alias("missing_count"),
                 F.col(f"b_{c}").alias("blank_count")) for c in df.columns])))
