"""Multinomial Naive Bayes on long-form features.

Fit: per (feature, class) the summed value ``fc``; per class the total
``N_c = sum_f fc + alpha * n_features``.  Score of document d for class c:

    jll = prior_c + S_d * (ln alpha - ln N_c) + sum_f x_df * ln(1 + fc/alpha)

where ``S_d = sum_f x_df`` and the sum runs over features *observed* in
class c only — the identity ``ln(fc + alpha) = ln alpha + ln(1 + fc/alpha)``
removes the need for a zero-filled feature x class grid.  A document without
any selected feature keeps its row (its score is the prior term alone), and
ties go to the first class in sorted order.

``prior`` is ``ln(n_c / n)`` when learned, ``-ln k`` when uniform.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emolens.operators.term_blocks import Features
from emolens.session import cut_lineage


@dataclass
class NaiveBayesLong:
    classes: list[str]          # sorted class names (bounded: one per class)
    class_table: DataFrame      # label, prior, a = ln(alpha) - ln(N_c)
    weights: DataFrame          # feature, g_0..g_{k-1} (ln(1 + fc/alpha), 0 if unseen)
    label: str

    def predict(self, features: DataFrame, docs: DataFrame, doc: str,
                output: str = "predicted") -> DataFrame:
        k = len(self.classes)
        consts = self.class_table.orderBy(self.label).collect()  # k rows
        # a row per selected feature: bounded
        j = features.join(F.broadcast(self.weights), "feature", "left")
        sums = j.groupBy(doc).agg(
            F.sum("value").alias("_s"),
            *[F.sum(F.col("value") * F.coalesce(F.col(f"g_{i}"), F.lit(0.0))).alias(f"_c{i}")
              for i in range(k)])
        scored = docs.join(sums, doc, "left")
        s = F.coalesce(F.col("_s"), F.lit(0.0))
        jll = F.array(*[F.lit(consts[i]["prior"]) + s * F.lit(consts[i]["a"])
                        + F.coalesce(F.col(f"_c{i}"), F.lit(0.0)) for i in range(k)])
        names = F.array(*[F.lit(c) for c in self.classes])
        best = F.array_position(jll, F.array_max(jll))  # first maximum
        return scored.withColumn(output, F.element_at(names, best.cast("int"))).drop(
            "_s", *[f"_c{i}" for i in range(k)])


def fit_naive_bayes(features: DataFrame | Features, labels: DataFrame, doc: str, label: str,
                    alpha: float = 1.0, uniform_prior: bool = False) -> NaiveBayesLong:
    classes = [r[0] for r in labels.select(label).distinct().orderBy(label).collect()]
    k = len(classes)
    if isinstance(features, Features):
        # summed in one pass over the blocks; a feature is a row of it
        fc = cut_lineage(features.sums(labels.select(doc, label), label).withColumnRenamed("o", "fc"))
        n_features = fc.select(F.count_distinct("feature")).scalar()
    else:
        n_features = features.select(F.count_distinct("feature")).scalar()
        fc = (features.join(labels.select(doc, label), doc)
              .groupBy("feature", label).agg(F.sum("value").alias("fc")))
    totals = fc.groupBy(label).agg(F.sum("fc").alias("_t"))
    counts = labels.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    n = labels.select(F.count(F.lit(1)).cast("double")).scalar()
    prior = F.lit(-math.log(k)) if uniform_prior else F.log(F.col("_n") / n)
    class_table = (counts.join(totals, label, "left")
                   .select(label, prior.alias("prior"),
                           (F.lit(math.log(alpha))
                            - F.log(F.coalesce(F.col("_t"), F.lit(0.0)) + F.lit(alpha) * n_features))
                           .alias("a")))
    weights = (fc.withColumn("g", F.log1p(F.col("fc") / alpha))
               .groupBy("feature").pivot(label, classes).agg(F.first("g")))
    weights = weights.select("feature", *[F.col(f"`{c}`").alias(f"g_{i}") for i, c in enumerate(classes)])
    return NaiveBayesLong(classes, class_table, weights, label)
