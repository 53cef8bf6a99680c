"""Exact quantiles and modes without gathering a column in one task.

A column is first counted by value (combined map-side), so that repeated
values shrink at once.  The (group, value) counts are sorted by range; each
sort partition gets the rank it begins at from one total per (partition,
group), and the few rows that hold a wanted rank are picked.  A group of any
size is spread over as many tasks as it has values to fill; no task and no
buffer ever holds all values of a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emolens.session import cut_lineage


def value_counts_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n): how often each column has each value, as double;
    a NULL value is counted too.  Materialised, for several reads."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "feature", "value")
    return cut_lineage(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))


def grouped_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by..., value, n) of one column's values per group."""
    return cut_lineage(df.groupBy(*by, F.col(value).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n")))


def exact_quantiles(counts: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(by..., q): per group the quantiles at ``probs``, linear between the
    two nearest ranks.  ``counts`` is (by..., value, n); NULL values are left
    out, and a group without any other value has no row."""
    order = [*by, "value"]
    known = counts.where(F.col("value").isNotNull()).select(*order, "n")
    # ranks depend on the partitions of the sort: fix them before they are used twice
    placed = cut_lineage(known.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    per = placed.groupBy("_part", *by).agg(F.sum("n").alias("_here"))
    along = Window.partitionBy(*by).orderBy("_part")
    begins = per.select(
        F.col("_part").alias("_p"), *[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)],
        F.coalesce(F.sum("_here").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_here").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"))
    same = F.col("_part") == F.col("_p")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_by{i}"))
    inner = Window.partitionBy("_part", *by).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("_at", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(begins, same)
    first = F.col("_before") + F.col("_at")
    place = F.transform(F.array(*[F.lit(float(p)) for p in probs]), lambda p: p * (F.col("_all") - 1))
    holds = lambda r: (r >= first) & (r < first + F.col("n"))
    wanted = F.filter(F.transform(place, lambda r, i: F.struct(
        i.alias("i"), holds(F.floor(r)).alias("low"), holds(F.ceil(r)).alias("high"), (r - F.floor(r)).alias("part"))),
        lambda x: x["low"] | x["high"])
    hits = ranked.select(*by, "value", F.explode(wanted).alias("x"))
    ends = hits.groupBy(*by, F.col("x.i").alias("i"), F.col("x.part").alias("part")).agg(
        F.max(F.when(F.col("x.low"), F.col("value"))).alias("low"), F.max(F.when(F.col("x.high"), F.col("value"))).alias("high"))
    # equal ends as they are: the difference of two infinities is no number
    q = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") + (F.col("high") - F.col("low")) * F.col("part"))
    got = ends.select(*by, F.struct("i", q.alias("q")).alias("x")).groupBy(*by).agg(F.sort_array(F.collect_list("x")).alias("x"))
    return got.select(*by, F.col("x.q").alias("q"))


def exact_mode(df: DataFrame, column: str):
    """The most frequent non-null value, ties to the smallest; None if there
    is none.  A count and a distributed top-1."""
    top = (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.asc(column)).first())
    return None if top is None else top[0]
