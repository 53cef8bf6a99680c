"""Raw reviews -> one row per description (the preparation entry point).

One lazy plan: scan -> clean -> filter -> dedup (shuffle 1) -> per-key
aggregate (shuffle 2) -> derived columns.  The guards are one aggregate over
the materialised result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emolens.functions.text import short_key
from emolens.operators.clean import (clean_reviews, drop_missing_required, exact_dedup,
                                     range_filter, validate_processed)
from emolens.operators.describe import derive_features, describe_per_key
from emolens.session import cut_lineage


def valid_reviews(raw: DataFrame, label: str = "emotion") -> DataFrame:
    """clean -> drop rows missing essentials -> keep ratings in 1..10."""
    return range_filter(drop_missing_required(clean_reviews(raw, label)))


def unique_reviews(raw: DataFrame, label: str = "emotion") -> DataFrame:
    return exact_dedup(valid_reviews(raw, label))


def prepare_descriptions(raw: DataFrame, label: str = "emotion", *,
                         check: bool = True, unique_key: bool = True) -> DataFrame:
    """The 20-column description table, checked.

    The table is materialised once (reliable checkpoint) and its checks are
    one aggregate over it; a description with two labels is two rows of one
    key and fails the key check, or with ``unique_key=False`` only warns.
    ``check=False`` gives the lazy plan.

    Reviews are only told apart and counted, so long ones are shuffled as
    digests.
    """
    reviews = valid_reviews(raw, label).withColumn("Reviews", short_key("Reviews"))
    desc = derive_features(describe_per_key(exact_dedup(reviews), "Description", label))
    if check:
        desc = cut_lineage(desc)
        validate_processed(desc, "description table", unique_key=unique_key)
    return desc


def modelling_table(desc: DataFrame, min_class_size: int = 5, label: str = "emotion") -> DataFrame:
    """Description table without the classes that have fewer rows than
    ``min_class_size`` (the number of folds): they cannot be stratified."""
    sizes = desc.groupBy(label).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < min_class_size)
    return desc.join(sizes.select(label), label, "left_anti").select(*desc.columns)
