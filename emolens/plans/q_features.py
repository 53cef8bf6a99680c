"""Queries for split/folds/weights, featurisation, chi² selection and the
long-form Naive Bayes (SURVEY §2.8, §2.9, §2.10 clf_naive_bayes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from emolens.functions.text import MISSING_TEXT
from emolens.ml.naive_bayes import fit_naive_bayes
from emolens.operators import features as X
from emolens.operators import sampling as S
from emolens.operators.clean import clean_reviews
from emolens.operators.describe import NUMERIC_FEATURES
from emolens.plans.catalog import register
from emolens.plans.prepare import modelling_table
from emolens.plans.q_prep import _desc, _with
from emolens.plans.sql_model import (chi2_ctes, features_ctes, nb_ctes, numeric_ctes,
                                     split_ctes, text_ctes)
from emolens.plans.sqlparts import cleaned_ctes, r6
from emolens.session import cut_lineage
from emolens.sources.fixtures import raw_reviews, table

LABEL, KEY, DOC = "emotion", "Description", "doc"
K_BEST = 1500


def modelling(spark, sf):
    return modelling_table(_desc(spark, sf)).withColumn(DOC, F.md5(KEY))


def split_table(spark, sf):
    """The split is read by every fit below: materialise it once in the
    reliable checkpoint folder instead of replaying the preparation plan."""
    return cut_lineage(S.stratified_split(modelling(spark, sf), LABEL, KEY))


def train_test(spark, sf):
    sp = split_table(spark, sf)
    return sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")


def rows_apart(split):
    """The split with a document key per row: of a text with several labels
    the rows after the first label get the label behind their key, so that a
    model has one vector for each row.  Texts with one label keep their key
    (``text_key`` is it for all)."""
    several = split.groupBy(DOC).agg(F.min(LABEL).alias("_first"), F.count(F.lit(1)).alias("_n"))
    several = cut_lineage(several.where(F.col("_n") > 1).drop("_n"))
    if several.isEmpty():
        return split
    own = F.when(F.col("_first") < F.col(LABEL), F.concat_ws(":", DOC, LABEL)).otherwise(F.col(DOC))
    return cut_lineage(split.join(several, DOC, "left").withColumn(DOC, own).select(*split.columns))


def text_key():
    """The document key as it is for texts with one label: the md5 digits."""
    return F.substring(DOC, 1, 32).alias(DOC)


def train_test_apart(spark, sf):
    """``train_test`` for models on vectors: a key per row."""
    sp = rows_apart(split_table(spark, sf))
    return sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")


def assembled(spark, sf, ngram=(1, 1)):
    tr, te = train_test(spark, sf)
    f_tr, f_te = X.assemble_long(tr, te, DOC, ngram=ngram)
    return tr, te, f_tr, f_te


W = "WITH " + split_ctes()


@register("stratified_split", W + " SELECT Description, emotion, split, CAST(coalesce(fold, -1) AS BIGINT) AS fold FROM split")
def q_split(spark, sf):
    """80/20 split with exact class quotas in md5('42:' || key) order
    (fold -1 marks test rows in this output)."""
    return split_table(spark, sf).select(KEY, LABEL, "split",
                                         F.coalesce("fold", F.lit(-1)).cast("bigint").alias("fold"))


@register("split_summary", W + """ SELECT emotion, count(*) FILTER (WHERE split = 'train') AS train_count,
 count(*) FILTER (WHERE split = 'test') AS test_count FROM split GROUP BY emotion""")
def q_split_summary(spark, sf):
    return S.split_summary(split_table(spark, sf), LABEL)


@register("stratified_folds", W + " SELECT emotion, CAST(fold AS BIGINT) AS fold, count(*) AS count FROM train GROUP BY emotion, fold")
def q_folds(spark, sf):
    tr, _ = train_test(spark, sf)
    return tr.groupBy(LABEL, F.col("fold").cast("bigint").alias("fold")).agg(
        F.count(F.lit(1)).alias("count"))


@register("class_weight_balanced", W + f""", c AS (SELECT emotion, count(*) AS n_c FROM train GROUP BY emotion)
 SELECT emotion, {r6('(SELECT sum(n_c) FROM c) / ((SELECT count(*) FROM c) * n_c)')} AS weight FROM c""")
def q_weights(spark, sf):
    tr, _ = train_test(spark, sf)
    return S.class_weights(tr, LABEL)


@register("label_encode", W + """ SELECT emotion, CAST(row_number() OVER (ORDER BY emotion) - 1 AS BIGINT) AS encoded_value
 FROM (SELECT DISTINCT emotion FROM train)""")
def q_label_encode(spark, sf):
    tr, _ = train_test(spark, sf)
    return X.label_encoding(tr, LABEL)


# --------------------------------------------------------------- imputation

_ORDERS_NULLED = """SELECT o_orderkey,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
 CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders"""


def orders_with_gaps(spark, sf):
    """Orders with injected gaps: price NULL where key % 13 = 0, priority
    NULL where key % 17 = 0 (every row kept)."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select("o_orderkey",
                    F.when(k % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice"))
                    .alias("o_totalprice"),
                    F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
                    .alias("o_orderpriority"))


@register("impute_median", f"""WITH o AS ({_ORDERS_NULLED})
 SELECT o_orderkey, {r6('coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM o))')} AS o_totalprice FROM o""")
def q_impute_median(spark, sf):
    o = orders_with_gaps(spark, sf)
    return X.impute_median(o, ["o_totalprice"], o).select("o_orderkey", "o_totalprice")


@register("impute_mode", f"""WITH o AS ({_ORDERS_NULLED}),
 m AS (SELECT o_orderpriority AS v FROM o WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
 SELECT o_orderkey, coalesce(o_orderpriority, (SELECT v FROM m)) AS o_orderpriority FROM o""")
def q_impute_mode(spark, sf):
    o = orders_with_gaps(spark, sf)
    return X.impute_mode(o, "o_orderpriority", o).select("o_orderkey", "o_orderpriority")


@register("impute_constant", "WITH " + cleaned_ctes() + f"""
 SELECT _row_id, coalesce(Reviews, '{MISSING_TEXT}') AS Reviews FROM cleaned""")
def q_impute_constant(spark, sf):
    c = clean_reviews(raw_reviews(spark, sf))
    return X.impute_constant(c, "Reviews").select("_row_id", "Reviews")


# ------------------------------------------------------ outliers, scaling

_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("iqr_bounds", "WITH long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM lineitem" for c in _LI) + f"""),
 q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM long GROUP BY feature),
 b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM q)
 SELECT b.feature, {r6('q1')} AS q1, {r6('q3')} AS q3, {r6('lower_bound')} AS lower_bound,
   {r6('upper_bound')} AS upper_bound,
   count(*) FILTER (WHERE value < lower_bound OR value > upper_bound) AS outlier_count
 FROM long JOIN b USING (feature) GROUP BY b.feature, q1, q3, lower_bound, upper_bound""")
def q_iqr_bounds(spark, sf):
    """IQR fences and outlier counts of four line-item measures (whole table)."""
    return X.iqr_bounds(table(spark, sf, "lineitem"), _LI)


def _num_sql(select_from: str) -> str:
    return W + numeric_ctes() + " " + select_from


_CLIP_SEL = ", ".join(
    r6(f"greatest(least(coalesce(CAST(test.{c} AS DOUBLE), {c}_med), {c}_hi), {c}_lo)") + f" AS {c}"
    for c in NUMERIC_FEATURES)


@register("iqr_clipper", _num_sql(f"SELECT test.doc, {_CLIP_SEL} FROM test, med, bnd"))
def q_iqr_clipper(spark, sf):
    """Test rows clipped to fences learned on training rows only."""
    tr, te = train_test(spark, sf)
    cols = NUMERIC_FEATURES
    tr_i = X.impute_median(tr, cols, tr)
    te_i = X.impute_median(te, cols, tr)
    bounds = X.fit_iqr_clipper(tr_i, cols)
    return X.iqr_clip(te_i, cols, bounds).select(DOC, *cols)


@register("min_max_scaler", _num_sql(f"""SELECT doc, feature, {r6('value')} AS value, 'train' AS split FROM num_train
 UNION ALL SELECT doc, feature, {r6('value')} AS value, 'test' AS split FROM num_test"""))
def q_min_max(spark, sf):
    """Numeric block (impute -> clip -> min-max), fitted on training rows."""
    tr, te = train_test(spark, sf)
    a, b = X.numeric_block(tr, te, DOC)
    return a.withColumn("split", F.lit("train")).unionByName(b.withColumn("split", F.lit("test")))


def _std_sql():
    cols = NUMERIC_FEATURES
    stats = ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in cols)
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, (CAST({c} AS DOUBLE) - {c}_m) / CASE WHEN {c}_s = 0 THEN 1 ELSE {c}_s END AS value"
        f" FROM descriptions, st" for c in cols)
    return _with() + f""", st AS (SELECT {stats} FROM descriptions), long AS ({long})
 SELECT feature, {r6('avg(value)')} AS mean, {r6('stddev_samp(value)')} AS std FROM long GROUP BY feature"""


@register("standard_scaler", _std_sql())
def q_standard(spark, sf):
    """Population-std standardisation; mean/std of the scaled features."""
    d = _desc(spark, sf)
    stats = X.fit_standard(d, NUMERIC_FEATURES)
    return X.scaled_summary(X.standard_scale(d, NUMERIC_FEATURES, stats), NUMERIC_FEATURES)


# ------------------------------------------------------------ encodings

@register("one_hot_whole", W + " " + features_ctes()[1:].split(",\nmed AS")[0].split("\nmode_g AS", 1)[0]
          if False else W + text_ctes() + """,
mode_g AS (SELECT genres_text AS g FROM train WHERE genres_text IS NOT NULL
   GROUP BY genres_text ORDER BY count(*) DESC, genres_text LIMIT 1),
cats AS (SELECT DISTINCT coalesce(genres_text, (SELECT g FROM mode_g)) AS c FROM train)
 SELECT doc, '1:' || genres_text AS feature, 1.0 AS value FROM test WHERE genres_text IN (SELECT c FROM cats)""")
def q_one_hot(spark, sf):
    """Whole-string one-hot of test rows against training categories
    (unseen category -> no rows, i.e. a zero block)."""
    tr, te = train_test(spark, sf)
    return X.one_hot_long(te, DOC, "genres_text", tr)


@register("tfidf", W + text_ctes() + f""" SELECT doc, feature, {r6('value')} AS value, 'train' AS split FROM tfidf_train
 UNION ALL SELECT doc, feature, {r6('value')} AS value, 'test' AS split FROM tfidf_test""")
def q_tfidf(spark, sf):
    """Sublinear smoothed TF-IDF (min_df 2, max_df 0.95) fitted on train."""
    tr, te = train_test(spark, sf)
    a, b = X.text_block(tr, te, DOC)
    return a.withColumn("split", F.lit("train")).unionByName(b.withColumn("split", F.lit("test")))


@register("tfidf_capped", W + text_ctes((1, 2), max_features=5000) + f"""
 SELECT doc, feature, {r6('value')} AS value FROM tfidf_train""")
def q_tfidf_capped(spark, sf):
    """Uni+bigram TF-IDF capped at the 5000 most frequent terms."""
    tr, _ = train_test(spark, sf)
    a, _ = X.text_block(tr, None, DOC, ngram=(1, 2), max_features=5000)
    return a


@register("assemble", W + features_ctes() + """ SELECT substr(feature, 1, 1) AS block,
 count(*) AS entries, count(DISTINCT feature) AS features FROM feat_train GROUP BY 1""")
def q_assemble(spark, sf):
    """Entries and distinct features per block of the assembled training matrix."""
    _, _, f_tr, _ = assembled(spark, sf)
    # by feature first: combined map-side, the second step then has a row per feature
    each = f_tr.long().groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy(F.substring("feature", 1, 1).alias("block")).agg(
        F.sum("n").alias("entries"), F.count(F.lit(1)).alias("features"))


@register("chi2_scores", W + features_ctes() + chi2_ctes(K_BEST) + f"""
 SELECT feature, {r6('chi2')} AS chi2 FROM chi2""")
def q_chi2(spark, sf):
    """Chi² of every assembled training feature against the class."""
    tr, _, f_tr, _ = assembled(spark, sf)
    return X.chi2_scores(f_tr, tr.select(DOC, LABEL), DOC, LABEL)


@register("select_k_best", W + features_ctes() + chi2_ctes(K_BEST) + """
 SELECT feature, CAST(position AS INTEGER) AS position FROM sel""")
def q_select(spark, sf):
    tr, _, f_tr, _ = assembled(spark, sf)
    sc = X.chi2_scores(f_tr, tr.select(DOC, LABEL), DOC, LABEL)
    return X.select_k_best(sc, K_BEST).select("feature", F.col("position").cast("int"))


def nb_predictions(spark, sf, alpha=0.1, uniform_prior=True, k=K_BEST, ngram=(1, 1)):
    tr, te, f_tr, f_te = assembled(spark, sf, ngram)
    sc = X.chi2_scores(f_tr, tr.select(DOC, LABEL), DOC, LABEL)
    sel = X.select_k_best(sc, k).select("feature")
    sel = cut_lineage(sel)
    model = fit_naive_bayes(f_tr.only(sel), tr.select(DOC, LABEL), DOC, LABEL, alpha, uniform_prior)
    return model.predict(f_te.only(sel).long(), te.select(DOC, KEY, F.col(LABEL).alias("actual")), DOC)


@register("clf_naive_bayes", W + features_ctes() + chi2_ctes(K_BEST) + nb_ctes(0.1, True)
          + " SELECT Description, actual, predicted FROM pred")
def q_nb(spark, sf):
    """Multinomial NB (alpha 0.1, uniform prior) on the 1500 best chi²
    features; one prediction per test description."""
    return nb_predictions(spark, sf).select(KEY, "actual", "predicted")


@register("clf_naive_bayes_prior", W + features_ctes() + chi2_ctes(500) + nb_ctes(1.0, False)
          + " SELECT Description, actual, predicted FROM pred")
def q_nb_prior(spark, sf):
    """Same with a learned prior, alpha 1 and k = 500."""
    return nb_predictions(spark, sf, alpha=1.0, uniform_prior=False, k=500).select(
        KEY, "actual", "predicted")
