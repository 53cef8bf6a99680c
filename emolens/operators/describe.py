"""Collapse review rows to one row per described item.

``describe_per_key`` is the central group-by of the preparation step and
``derive_features`` adds the 10 derived columns, giving the 20-column
description table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emolens.functions.text import (LIST_SEPARATOR, char_count, parse_list_literal,
                                    tokens_text, trim_unicode, unknown_category, word_count)
from emolens.operators.clean import ORDER_KEY

DESCRIPTION_COLUMNS = [
    "Description", "emotion", "movie_name", "all_movie_names", "movie_name_count", "genres",
    "mean_rating", "median_rating", "minimum_rating", "maximum_rating", "review_count",
    "unique_review_count", "genre_list", "genre_count", "genres_text",
    "description_word_count", "description_character_count", "rating_range",
    "log_review_count", "log_unique_review_count",
]

NUMERIC_FEATURES = [
    "mean_rating", "median_rating", "genre_count", "description_word_count",
    "description_character_count", "rating_range", "log_review_count",
    "log_unique_review_count",
]


def first_in_order(column: str, order_key: str = ORDER_KEY):
    """First non-null value in input order (never a bare ``first``)."""
    return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), F.col(order_key)))


def join_unique(values):
    """Sorted, de-duplicated, non-blank trimmed values joined by ``' | '``."""
    cleaned = F.filter(F.transform(values, lambda x: trim_unicode(x)), lambda x: x != "")
    return F.array_join(F.array_sort(F.array_distinct(cleaned)), LIST_SEPARATOR)


def describe_per_key(reviews: DataFrame, key: str = "Description", label: str = "emotion",
                     order_key: str = ORDER_KEY) -> DataFrame:
    """One row per (key, label) with the 10 named aggregates.

    * one shuffle, by (key, label): the window brings a group's rows together
      in order of the review (spilling, so a group of any size fits), and the
      aggregate reads them where they are.  Distinct reviews are the rows that
      begin one; a DISTINCT aggregate would build all buffers per review first;
    * one ``collect_set(movie_name)`` serves both the joined unique names and
      their distinct count;
    * ``median`` is Spark's exact percentile, which keeps one (value -> count)
      map per group and combines it map-side: its memory is bounded by the
      number of distinct ratings in a group, not by the group's row count.
    """
    names = F.collect_set("movie_name")
    along = Window.partitionBy(key, label).orderBy("Reviews")
    begins = F.col("Reviews").isNotNull() & ~F.col("Reviews").eqNullSafe(F.lag("Reviews").over(along))
    return reviews.withColumn("_begins", begins).groupBy(key, label).agg(
        first_in_order("movie_name", order_key).alias("movie_name"),
        join_unique(names).alias("all_movie_names"),
        F.size(names).cast("bigint").alias("movie_name_count"),
        first_in_order("genres", order_key).alias("genres"),
        F.avg("Ratings").alias("mean_rating"),
        F.median("Ratings").alias("median_rating"),
        F.min("Ratings").alias("minimum_rating"),
        F.max("Ratings").alias("maximum_rating"),
        F.count(F.lit(1)).alias("review_count"),
        F.count_if("_begins").alias("unique_review_count"),
    )


def derive_features(desc: DataFrame) -> DataFrame:
    """Add genre list/count/text, lengths, rating range and log counts."""
    genre_list = parse_list_literal("genres")
    out = desc.withColumn("genre_list", genre_list)
    out = out.withColumns({
        "genre_count": F.size("genre_list").cast("bigint"),
        "genres_text": unknown_category(tokens_text("genre_list")),
        "description_word_count": word_count("Description"),
        "description_character_count": char_count("Description"),
        "rating_range": F.col("maximum_rating") - F.col("minimum_rating"),
        "log_review_count": F.log1p("review_count"),
        "log_unique_review_count": F.log1p("unique_review_count"),
    })
    return out.select(*DESCRIPTION_COLUMNS)


def list_literal(arr) -> "F.Column":
    """Render an array the way the source writes lists: ``['a', 'b']``.

    An item that holds an apostrophe and no double quote is put in double
    quotes; otherwise apostrophes are escaped, as are backslashes."""
    def quoted(x):
        plain = F.replace(x, F.lit("\\"), F.lit("\\\\"))
        return F.when(F.contains(x, F.lit("'")) & ~F.contains(x, F.lit('"')), F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'")))

    return F.concat(F.lit("["), F.array_join(F.transform(arr, quoted), ", "), F.lit("]"))


def stable_sort(desc: DataFrame) -> DataFrame:
    """Deterministic order used at the sinks (emotion, movie_name, key)."""
    return desc.orderBy("emotion", "movie_name", "Description")
