"""Leakage-safe featurisation in long form.

Every statistic is learned from the *training* rows passed in and applied to
any other row set, so changing test rows never changes a fitted value.  A
feature row is ``(doc, feature, value)``; the feature name carries its block
so that the assembled order (text, genre, numeric) is a plain sort order:

* ``0:<term>``              sublinear TF-IDF of the description
* ``1:<category>``          one-hot of the whole genre string
* ``2:<i>:<column>``        imputed, IQR-clipped, min-max scaled numeric

Zero values are not stored (they add nothing to sums, chi² or Naive Bayes).
Global statistics are scalar subqueries or per-feature aggregates; the only
joins are against per-feature / per-term tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emolens.functions.text import MISSING_TEXT, ngram_range, tokenize
from emolens.operators.describe import NUMERIC_FEATURES
from emolens.operators.quantiles import exact_mode, exact_quantiles, value_counts_long
from emolens.operators.term_blocks import Features, TextBlocks, TextFeatures, vocabulary_rows
from emolens.session import cut_lineage

TEXT_BLOCK, GENRE_BLOCK, NUMERIC_BLOCK = "0:", "1:", "2:"


# ----------------------------------------------------------- imputation

def fit_medians(train: DataFrame, columns) -> dict:
    """Fitted parameters are one small row: bring it to the driver once, the
    way a Spark ML ``fit`` does, so transforms use literals (no nested
    subqueries re-running the training plan).  NULLs are ignored."""
    rows = exact_quantiles(value_counts_long(train, columns), ["feature"], [0.5]).collect()  # one row per column
    return {c: None for c in columns} | {r["feature"]: r["q"][0] for r in rows}


def impute_median(df: DataFrame, columns, train: DataFrame) -> DataFrame:
    med = fit_medians(train, columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(med[c])) for c in columns})


def mode_value(train: DataFrame, column: str):
    """Most frequent non-null value; ties go to the smallest value."""
    return F.lit(exact_mode(train, column))


def impute_mode(df: DataFrame, column: str, train: DataFrame) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), mode_value(train, column)))


def impute_constant(df: DataFrame, column: str, value: str = MISSING_TEXT) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


# ----------------------------------------------------- outliers, scaling

def _fences(counts: DataFrame, factor: float) -> DataFrame:
    """(feature, q1, q3, lower_bound, upper_bound) from (feature, value, n)."""
    q = exact_quantiles(counts, ["feature"], [0.25, 0.75]).select(
        "feature", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    spread = factor * (F.col("q3") - F.col("q1"))
    return q.withColumns({"lower_bound": F.col("q1") - spread, "upper_bound": F.col("q3") + spread})


def iqr_bounds(df: DataFrame, columns, factor: float = 1.5) -> DataFrame:
    """Per feature: q1, q3, lower/upper fence and outlier count (long form).
    One scan counts the values; quartiles and outliers come from the counts."""
    counts = value_counts_long(df, columns)
    q = _fences(counts, factor)
    # q has one row per feature: a proven size bound, so it is broadcast
    j = counts.join(F.broadcast(q), "feature")
    out = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    return j.groupBy("feature", "q1", "q3", "lower_bound", "upper_bound").agg(
        F.coalesce(F.sum(F.when(out, F.col("n"))), F.lit(0)).alias("outlier_count"))


def fit_iqr_clipper(train: DataFrame, columns, factor: float = 1.5):
    """Learned bounds, two literals per column."""
    rows = {r["feature"]: r for r in _fences(value_counts_long(train, columns), factor).collect()}  # one row per column
    out = {}
    for c in columns:
        r = rows.get(c)
        out[f"{c}__lo"] = F.lit(r and r["lower_bound"]).cast("double")
        out[f"{c}__hi"] = F.lit(r and r["upper_bound"]).cast("double")
    return out


def iqr_clip(df: DataFrame, columns, bounds) -> DataFrame:
    """Winsorise to the learned fences; NULL stays NULL; nothing is dropped."""
    return df.withColumns({
        c: F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(
            F.greatest(F.least(F.col(c).cast("double"), bounds[f"{c}__hi"]), bounds[f"{c}__lo"]))
        for c in columns})


def fit_min_max(train: DataFrame, columns):
    row = train.select(*[x for c in columns for x in (
        F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max"))]
    ).first().asDict()
    return {k: F.lit(v) for k, v in row.items()}


def min_max_scale(df: DataFrame, columns, stats) -> DataFrame:
    """(x - min) / (max - min) with a zero range treated as 1 (a constant
    training column maps to 0; unseen values may leave [0, 1])."""
    out = {}
    for c in columns:
        lo, hi = stats[f"{c}__min"], stats[f"{c}__max"]
        rng = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
        out[c] = (F.col(c).cast("double") - lo) / rng
    return df.withColumns(out)


def fit_standard(train: DataFrame, columns):
    row = train.select(*[x for c in columns for x in (
        F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std"))]).first().asDict()
    return {k: F.lit(v) for k, v in row.items()}


def standard_scale(df: DataFrame, columns, stats) -> DataFrame:
    """(x - mean) / std with population std (ddof=0); zero std -> 1."""
    out = {}
    for c in columns:
        sd = stats[f"{c}__std"]
        out[c] = (F.col(c).cast("double") - stats[f"{c}__mean"]) / F.when(sd == 0, 1.0).otherwise(sd)
    return df.withColumns(out)


def scaled_summary(df: DataFrame, columns) -> DataFrame:
    """Mean and sample std of each column (the check after scaling)."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "value")
    return long.groupBy("feature").agg(F.avg("value").alias("mean"),
                                       F.stddev_samp("value").alias("std"))


# ------------------------------------------------------------ encodings

def label_encoding(train: DataFrame, label: str) -> DataFrame:
    """Sorted distinct labels -> 0..k-1 (one row per class)."""
    labels = train.select(label).distinct()
    return labels.withColumn("encoded_value",
                             (F.row_number().over(Window.orderBy(label)) - 1).cast("bigint"))


def one_hot_long(df: DataFrame, doc: str, column: str, train: DataFrame) -> DataFrame:
    """One-hot of the whole string: categories seen in training only, an
    unseen category gives no feature rows (an all-zero block)."""
    cats = train.select(column).where(F.col(column).isNotNull()).distinct()
    return (df.select(doc, column).join(cats, column, "left_semi")
            .select(doc, F.concat(F.lit(GENRE_BLOCK), F.col(column)).alias("feature"),
                    F.lit(1.0).alias("value")))


def fit_numbers(train: DataFrame, columns=NUMERIC_FEATURES, factor: float = 1.5) -> DataFrame:
    """One row per column: (feature, position, median, lower, upper, lo, hi).

    Median for gaps, fences of the filled column, and the range of the
    clipped one.  Everything comes from the value counts of one scan: filling
    adds the gaps to the median's count, and clipping keeps the order, so the
    clipped range is the clipped minimum and maximum."""
    counts = value_counts_long(train, columns)
    med = exact_quantiles(counts, ["feature"], [0.5]).select("feature", F.col("q")[0].alias("median"))
    # one row per column: broadcast is size-bounded
    filled = counts.join(F.broadcast(med), "feature", "left").groupBy(
        "feature", "median", F.coalesce("value", "median").alias("value")).agg(F.sum("n").alias("n"))
    ends = filled.groupBy("feature", "median").agg(F.min("value").alias("least"), F.max("value").alias("most"))
    table = ends.join(F.broadcast(_fences(filled, factor)), "feature", "left")
    clip = lambda x: F.greatest(F.least(F.col(x), F.col("upper_bound")), F.col("lower_bound"))
    names = F.array(*[F.lit(c) for c in columns])
    return table.select("feature", (F.array_position(names, F.col("feature")) - 1).cast("int").alias("position"), "median",
                        F.col("lower_bound").alias("lower"), F.col("upper_bound").alias("upper"),
                        clip("least").alias("lo"), clip("most").alias("hi"))


def scaled_numbers(df: DataFrame, doc: str, columns, table: DataFrame) -> DataFrame:
    """Numeric block in long form: gaps filled, clipped, scaled by the range
    (a zero range counts as 1); zero values are omitted."""
    long = df.select(doc, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot([doc], list(columns), "feature", "value")
    j = long.join(F.broadcast(table), "feature")  # one row per column
    x = F.greatest(F.least(F.coalesce("value", "median"), F.col("upper")), F.col("lower"))
    size = F.when(F.col("hi") == F.col("lo"), F.lit(1.0)).otherwise(F.col("hi") - F.col("lo"))
    name = F.concat(F.lit(NUMERIC_BLOCK), F.col("position").cast("string"), F.lit(":"), F.col("feature"))
    scaled = j.select(doc, name.alias("feature"), ((x - F.col("lo")) / size).alias("value"))
    return scaled.where(F.col("value").isNotNull() & (F.col("value") != 0.0))


def numeric_block(train: DataFrame, other: DataFrame, doc: str, columns=NUMERIC_FEATURES,
                  factor: float = 1.5):
    """median impute -> IQR clip -> min-max, fitted on ``train``."""
    table = cut_lineage(fit_numbers(train, columns, factor))
    return scaled_numbers(train, doc, columns, table), scaled_numbers(other, doc, columns, table)


# --------------------------------------------------------------- tf-idf

def term_counts(df: DataFrame, doc: str, text: str, ngram=(1, 1), stop_words=None) -> DataFrame:
    """(doc, term, tf) — missing text is imputed with the constant first.

    Texts are dealt by document before they are taken apart, so that counting
    needs no shuffle of (doc, term) rows, several times the text."""
    t = F.coalesce(F.col(text), F.lit(MISSING_TEXT))
    rows = df.select(doc, t.alias("_t")).repartition(doc)
    grams = ngram_range(tokenize("_t", stop_words), *ngram)
    return (rows.select(doc, F.explode(grams).alias("term"))
            .groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf")))


def most_frequent(vocab: DataFrame, max_features: int) -> DataFrame:
    """The most frequent terms, ties by term: a distributed top-k."""
    return vocab.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)


def text_features(train: DataFrame, other: DataFrame | None, doc: str, text: str = "Description",
                  ngram=(1, 1), min_df: int = 2, max_df: float = 0.95,
                  max_features: int | None = None) -> tuple[TextFeatures, TextFeatures | None]:
    """TF-IDF of both row sets as blocks, the vocabulary from ``train``;
    without other rows None for them."""
    blocks = TextBlocks(train, doc, text, ngram)
    weights = blocks.fit(float(train.count()), min_df, max_df)
    vocab, only = vocabulary_rows(weights), None
    if max_features is not None:
        vocab = most_frequent(vocab, max_features)
        only = [r["term"] for r in vocab.select("term").collect()]  # max_features rows
    if other is None:
        return blocks.weigh(weights, only), None
    others = TextBlocks(other, doc, text, ngram)
    return blocks.weigh(weights, only), others.weigh(others.lookup(vocab))


def text_block(train: DataFrame, other: DataFrame | None, doc: str, text: str = "Description",
               ngram=(1, 1), min_df: int = 2, max_df: float = 0.95,
               max_features: int | None = None):
    a, b = text_features(train, other, doc, text, ngram, min_df, max_df, max_features)
    return a.long(), b and b.long()


def assemble_long(train: DataFrame, other: DataFrame, doc: str, text: str = "Description",
                  category: str = "genres_text", numeric=NUMERIC_FEATURES, ngram=(1, 1)) -> tuple[Features, Features]:
    """Text + genre + numeric blocks for training rows and another row set,
    every statistic learned from the training rows."""
    t_tr, t_ot = text_features(train, other, doc, text, ngram)
    mode = mode_value(train, category)
    tr_c = train.withColumn(category, F.coalesce(F.col(category), mode))
    ot_c = other.withColumn(category, F.coalesce(F.col(category), mode))
    g_tr, g_ot = one_hot_long(tr_c, doc, category, tr_c), one_hot_long(ot_c, doc, category, tr_c)
    n_tr, n_ot = numeric_block(train, other, doc, numeric)
    return Features(t_tr, cut_lineage(g_tr.unionByName(n_tr))), Features(t_ot, cut_lineage(g_ot.unionByName(n_ot)))


# ------------------------------------------------------ chi2 and select

def chi2_scores(features: DataFrame | Features, labels: DataFrame, doc: str, label: str) -> DataFrame:
    """Chi² of non-negative feature values against the class.

    observed O[f,c] = sum of values in class c, expected E = p_c * T_f with
    p_c the class share of training rows and T_f the feature total; since
    sum_c O = sum_c E = T_f, chi² = sum_c O²/E - T_f needs only the observed
    (f, c) pairs — no zero-filled feature x class grid.
    """
    n_rows = labels.select(F.count(F.lit(1)).cast("double")).scalar()
    prior = labels.groupBy(label).agg((F.count(F.lit(1)) / n_rows).alias("p"))
    if isinstance(features, Features):
        obs = features.sums(labels.select(doc, label), label)
    else:
        obs = (features.join(labels.select(doc, label), doc)
               .groupBy("feature", label).agg(F.sum("value").alias("o")))
    return chi2_from_sums(obs, prior, label)


def chi2_from_sums(sums: DataFrame, priors: DataFrame, label: str) -> DataFrame:
    """Chi² from the (feature, class) sums ``o`` and the class shares ``p``."""
    # one row per class: broadcast is size-bounded
    j = sums.join(F.broadcast(priors), label)
    # sum o²/(p t) - t as (sum o²/p)/t - t: one aggregate, no total joined back
    both = j.groupBy("feature").agg(F.sum(F.col("o") * F.col("o") / F.col("p")).alias("q"), F.sum("o").alias("t"))
    return both.select("feature", (F.col("q") / F.col("t") - F.col("t")).alias("chi2")).where(F.col("chi2").isNotNull())


def select_k_best(scores: DataFrame, k: int, score: str = "chi2") -> DataFrame:
    """Keep the k highest scores; ties go to the later feature position
    (scores rounded to 9 decimals so float noise cannot split ties)."""
    order = [F.desc(F.round(score, 9)), F.desc("feature")]
    top = scores.orderBy(*order).limit(k)  # distributed top-k
    return top.withColumn("position", F.row_number().over(Window.orderBy(*order)))
