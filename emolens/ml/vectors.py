"""Long-form features -> Spark ML vectors, and a truncated SVD.

The feature index is the sorted list of selected features (at most k).  Each
document's (index, value) pairs are collected (at most k per document), the
gaps between them filled with zeros, and the array turned into a vector that
is kept sparse where that is smaller: all of it in the JVM, no Python per
document.

The SVD is fitted from the Gramian of the training vectors (one distributed
aggregate of k x k numbers); projecting any row set is a join of the long-form
features with the right singular vectors and a sum per document.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emolens.operators.term_blocks import Features


def feature_index(selected: DataFrame) -> DataFrame:
    """(feature, index) in assembled order (block prefix, then name)."""
    return selected.select("feature").withColumn(
        "index", (F.row_number().over(Window.orderBy("feature")) - 1).cast("int"))


def to_sparse(features: DataFrame | Features, index: DataFrame, docs: DataFrame, doc: str,
              size: int, out: str = "features") -> DataFrame:
    """One vector per document of ``docs`` (documents without any selected
    feature get an empty vector rather than being dropped)."""
    if isinstance(features, Features):
        per_doc = features.pairs(index)
    else:
        pairs = F.array_sort(F.collect_list(F.struct("index", "value")))
        per_doc = features.join(index, "feature").groupBy(doc).agg(pairs.alias("_p"))
    joined = docs.join(per_doc, doc, "left")
    p, zeros = F.col("_p"), lambda n: F.array_repeat(F.lit(0.0), n.cast("int"))
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(p, i - 1)["index"])
    filled = F.flatten(F.transform(p, lambda x, i: F.concat(zeros(x["index"] - before(i) - 1), F.array(x["value"]))))
    tail = zeros(F.lit(size - 1) - F.get(p, F.size(p) - 1)["index"])
    dense = F.coalesce(F.concat(filled, tail), zeros(F.lit(size)))
    joined = joined.withColumn("_d", array_to_vector(dense)).drop("_p")
    # the assembler keeps the smaller of the two forms
    return VectorAssembler(inputCols=["_d"], outputCol=out).transform(joined).drop("_d")


def svd_fit(train_vectors: DataFrame, k: int = 100, col: str = "features"):
    """Right singular vectors V (n x k) and singular values of the uncentred
    training matrix.

    The n x n Gramian X^T X is one distributed tree aggregate (n is the
    number of selected features, bounded by the selection's k); its
    eigendecomposition on the driver gives V and s = sqrt(eigenvalues) —
    the local-eigs route, instead of one Spark job per ARPACK iteration."""
    import numpy as np
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils

    rows = MLUtils.convertVectorColumnsFromML(train_vectors.select(col), col)
    gram = RowMatrix(rows).computeGramianMatrix().toArray()
    n = gram.shape[0]
    if k >= n:
        raise ValueError(f"{k} components need more than {k} features; there are {n}")
    vals, vecs = np.linalg.eigh(gram)
    order = np.argsort(vals)[::-1][:k]
    s = np.sqrt(np.clip(vals[order], 0.0, None))
    return vecs[:, order], s


def svd_components_table(spark, index_rows, v) -> DataFrame:
    """Long table (feature, component, weight) from the local V matrix:
    one row per feature with its weight array, exploded by Spark."""
    data = [(feat, [float(x) for x in v[i]]) for feat, i in index_rows]
    rows = spark.createDataFrame(data, "feature string, w array<double>")
    return (rows.select("feature", F.posexplode("w").alias("component", "weight"))
            .where(F.col("weight") != 0.0))


def projected(features: Features, weights: DataFrame, doc: str, k: int) -> DataFrame:
    """(doc, c): the ``k`` components of each document as an array, from the
    (feature, component, weight) rows of a bounded number of features.

    A document is one row with the array of its features and meets the weights
    as one broadcast row, so that nothing is shuffled.  Products are added in
    the order of features."""
    by = F.map_from_entries(F.collect_list(F.struct("component", "weight")))
    w = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.try_element_at(F.col("_by"), i), F.lit(0.0)))
    each = weights.groupBy("feature").agg(by.alias("_by")).select("feature", w.alias("w"))
    index = feature_index(each)
    all_w = F.transform(F.sort_array(F.collect_list(F.struct("index", "w"))), lambda x: x["w"]).alias("_w")
    met = features.pairs(index).crossJoin(F.broadcast(each.join(index, "feature").agg(all_w)))
    total = F.aggregate("_p", F.array_repeat(F.lit(0.0), k), lambda acc, x: F.zip_with(
        acc, F.get(F.col("_w"), x["index"]), lambda a, b: a + x["value"] * b))
    return met.select(doc, total.alias("c"))


def svd_project(features: DataFrame | Features, comps: DataFrame, docs: DataFrame, doc: str, k: int,
                out: str = "svd") -> DataFrame:
    """Scores X V for every document (U S), as a dense vector column."""
    if isinstance(features, Features):
        got = docs.join(projected(features, comps, doc, k), doc, "left")
        return got.withColumn(out, array_to_vector(F.coalesce("c", F.array_repeat(F.lit(0.0), k)))).drop("c")
    s = (features.join(F.broadcast(comps), "feature")
         .groupBy(doc, "component").agg(F.sum(F.col("value") * F.col("weight")).alias("s")))
    arr = s.groupBy(doc).agg(F.map_from_entries(F.collect_list(F.struct("component", "s"))).alias("_m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                        lambda i: F.coalesce(F.element_at(F.col("_m"), i), F.lit(0.0)))
    joined = docs.join(arr, doc, "left")
    return joined.withColumn(out, array_to_vector(dense)).drop("_m")


def explained_variance(scores: DataFrame, features: DataFrame, n_docs: int, k: int,
                       col: str = "svd") -> DataFrame:
    """Per component: variance of the projected training rows over the total
    variance of the original features, and the cumulative share."""
    from pyspark.ml.functions import vector_to_array

    arr = scores.select(vector_to_array(col).alias("a"))
    comp = arr.select(F.posexplode("a").alias("component", "v")).groupBy("component").agg(
        F.var_pop("v").alias("variance"))
    # total variance of the sparse feature columns: E[x^2] - E[x]^2 with zeros
    fstat = features.groupBy("feature").agg(F.sum("value").alias("s1"),
                                           F.sum(F.col("value") * F.col("value")).alias("s2"))
    total = fstat.select(F.sum(F.col("s2") / n_docs - (F.col("s1") / n_docs) ** 2)).scalar()
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return (comp.withColumn("ratio", F.col("variance") / total)
            .withColumn("cumulative", F.sum("ratio").over(w)))
