"""Deterministic stratified split, folds and class weights.

Randomness is replaced by a keyed md5 order: row r of class c is placed by
``md5('<seed>:' || key)``.  Quotas follow largest-remainder allocation, so
class counts are exact (e.g. 817/400/249/237/150/131/73 -> test
164/80/50/47/30/26/15).

Scale: ranking every row of a class with one window would sort a hot class
(say a third of all rows) inside one task.  ``class_rank`` instead splits the
md5 order into 65,536 prefix buckets: a tiny (class, bucket) count table
gives each bucket its offset, and rows are ranked only within their
(class, bucket) partition — exact, and spread over the whole cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42
PREFIX_HEX = 4  # 16-bit bucket = first four hex digits of the md5 digest


def order_hash(key: str | Column, seed: int = SEED) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def class_rank(df: DataFrame, label: str, key: str, seed: int = SEED,
               rank_col: str = "_rank") -> DataFrame:
    """1-based rank of each row inside its class in md5 order (exact)."""
    h = order_hash(key, seed)
    tagged = df.withColumns({"_h": h, "_b": F.conv(F.substring(h, 1, PREFIX_HEX), 16, 10)
                             .cast("int")})
    buckets = tagged.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w_cum = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("_before", F.coalesce(F.sum("_n").over(w_cum), F.lit(0)))
    w_in = Window.partitionBy(label, "_b").orderBy("_h")
    ranked = (tagged.join(offsets.select(label, "_b", "_before"), [label, "_b"])
              .withColumn(rank_col, F.col("_before") + F.row_number().over(w_in)))
    return ranked.drop("_h", "_b", "_before")


def class_quotas(df: DataFrame, label: str, test_size: float = 0.2) -> DataFrame:
    """Per class: n_class, train_quota, test_quota (largest remainder).

    n_test = ceil(test_size * n); train quotas are allocated first and test
    takes the rest of each class.  Remainder ties go to the smaller label.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    n = counts.select(F.sum("n_class")).scalar()
    n_test = F.ceil(F.lit(test_size) * n).cast("bigint")
    # exact integer arithmetic (div / %) for the largest-remainder split
    alloc = counts.withColumns({"_n": n, "_ntr": n - n_test}).withColumns({
        "_base": F.expr("(n_class * _ntr) div _n"),
        "_rem": F.expr("(n_class * _ntr) % _n"),
    })
    leftover = alloc.select(F.first("_ntr") - F.sum("_base")).scalar()
    w = Window.orderBy(F.desc("_rem"), F.asc(label))
    alloc = alloc.withColumn("_pos", F.row_number().over(w))  # one row per class
    train_q = F.col("_base") + F.when(F.col("_pos") <= leftover, 1).otherwise(0)
    return alloc.select(label, "n_class", train_q.cast("bigint").alias("train_quota"),
                        (F.col("n_class") - train_q).cast("bigint").alias("test_quota"))


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2,
                     seed: int = SEED, folds: int | None = 5) -> DataFrame:
    """Add ``split`` ('train'/'test') and, for training rows, ``fold``.

    Test rows are the first ``test_quota`` rows of each class in md5 order;
    the remaining rows are dealt round-robin into ``folds`` folds, so fold
    sizes within a class differ by at most one.
    """
    q = class_quotas(df, label, test_size).select(label, "test_quota")
    ranked = class_rank(df, label, key, seed).join(q, label)
    is_test = F.col("_rank") <= F.col("test_quota")
    out = ranked.withColumn("split", F.when(is_test, "test").otherwise("train"))
    if folds:
        out = out.withColumn("fold", F.when(is_test, F.lit(None)).otherwise(
            ((F.col("_rank") - F.col("test_quota") - 1) % folds)).cast("int"))
    return out.drop("_rank", "test_quota")


def split_summary(split_df: DataFrame, label: str) -> DataFrame:
    """Per class train and test counts (zero when absent)."""
    return split_df.groupBy(label).agg(
        F.count_if(F.col("split") == "train").alias("train_count"),
        F.count_if(F.col("split") == "test").alias("test_count"))


def class_weights(train: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """'balanced' weights n / (k * n_c) per class (one row per class)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    tot = counts.select(F.struct(F.sum("n_class").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    return counts.select(label, (tot["n"] / (tot["k"] * F.col("n_class"))).alias(weight_col))


def with_class_weights(train: DataFrame, label: str, weight_col: str = "weight",
                       balanced: bool = True) -> DataFrame:
    if not balanced:
        return train.withColumn(weight_col, F.lit(1.0))
    return train.join(class_weights(train, label, weight_col), label)
