"""Explode, n-grams and term statistics.

Documents stay rows until the explode; term frequencies are computed in two
levels — (doc, term) then term — each with a map-side partial aggregate, so
a very frequent term never funnels raw token rows into one task.  Top-k per
group uses ``row_number() <= k``, which Spark plans with a per-partition
``WindowGroupLimit`` before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emolens.functions.text import UNKNOWN_CATEGORY, ngram_range, tokenize


def explode_tokens(df: DataFrame, column: str = "genres_text", token: str = "genre_token",
                   filler: str = UNKNOWN_CATEGORY) -> DataFrame:
    """One row per (row, whitespace token); an empty text yields one filler row."""
    toks = F.regexp_extract_all(F.coalesce(F.col(column), F.lit("")), F.lit(r"(?U)\S+"), 0)
    out = df.select("*", F.explode_outer(toks).alias(token))
    return out.withColumn(token, F.coalesce(F.col(token), F.lit(filler)))


def top_k_tokens(long: DataFrame, token: str = "genre_token", k: int = 15,
                 name: str = "description_count") -> DataFrame:
    """The k most frequent tokens (ties by token)."""
    counts = long.groupBy(token).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), F.asc(token)).limit(k)


def restrict_to_top(long: DataFrame, top: DataFrame, token: str = "genre_token") -> DataFrame:
    """Semi-join on a top-k table; its size is bounded by k, so it is
    broadcast."""
    return long.join(F.broadcast(top.select(token)), token, "left_semi")


def text_key(column: str):
    """Compact 128-bit document key for a text used as its own key.

    Shuffling (doc, term) pairs keyed by a whole description would move the
    text once per term; the md5 digest is 32 characters.
    """
    return F.md5(F.col(column))


def doc_terms(docs: DataFrame, text: str, doc_key: str, ngram: tuple[int, int] = (1, 1),
              stop_words=None, keep=()) -> DataFrame:
    """(doc, term, tf): tokenise, build n-grams, explode, count per doc.

    When the key column is the text itself, its md5 digest stands in for it.
    Texts are dealt by document first: counting then shuffles no terms.
    """
    key = text_key(doc_key).alias(doc_key) if doc_key == text else F.col(doc_key)
    rows = docs.select(key, *keep, F.col(text).alias("_text")).repartition(doc_key)
    grams = ngram_range(tokenize("_text", stop_words), *ngram)
    exploded = rows.select(doc_key, *keep, F.explode(grams).alias("term"))
    return exploded.groupBy(doc_key, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_stats(tf: DataFrame, doc_key: str, by=()) -> DataFrame:
    """Corpus frequency and document frequency per term (optionally per group)."""
    return tf.groupBy(*by, "term").agg(F.sum("tf").cast("bigint").alias("frequency"),
                                       F.count(F.lit(1)).alias("document_frequency"))


def top_terms(docs: DataFrame, text: str = "Description", doc_key: str = "Description",
              ngram: tuple[int, int] = (1, 1), k: int = 20, min_df: int = 2) -> DataFrame:
    """k most frequent n-grams among those in >= ``min_df`` documents."""
    st = term_stats(doc_terms(docs, text, doc_key, ngram), doc_key)
    st = st.where(F.col("document_frequency") >= min_df)
    return st.orderBy(F.desc("frequency"), F.asc("term")).limit(k).select("term", "frequency")


def top_terms_by_class(docs: DataFrame, label: str = "emotion", text: str = "Description",
                       doc_key: str = "Description", k: int = 5, min_df: int = 2) -> DataFrame:
    """Per class, the k most frequent terms with document frequency >= min_df
    counted inside the class."""
    tf = doc_terms(docs, text, doc_key, keep=(label,))
    st = term_stats(tf, doc_key, by=(label,)).where(F.col("document_frequency") >= min_df)
    w = Window.partitionBy(label).orderBy(F.desc("frequency"), F.asc("term"))
    return (st.withColumn("position", F.row_number().over(w))
            .where(F.col("position") <= k)
            .select(label, "term", "frequency", F.col("position").cast("bigint")))


def vocabulary_grid(stats: DataFrame, min_dfs, sizes, most_df=None) -> DataFrame:
    """Per (min_df, max_features): the terms kept and the occurrences they
    cover, for every setting from one table of term statistics.

    Terms of equal (document frequency, frequency) are interchangeable here,
    so a histogram of the two stands for the vocabulary: a minimum is a range
    of it, and the most frequent terms are its head.  No text is read again.
    A size of 0 means no limit."""
    kept = stats if most_df is None else stats.where(F.col("document_frequency") <= most_df)
    hist = kept.groupBy("document_frequency", "frequency").agg(F.count(F.lit(1)).alias("n"))
    least = F.explode(F.filter(F.array(*[F.lit(m) for m in min_dfs]), lambda m: m <= F.col("document_frequency")))
    runs = hist.select(least.alias("min_df"), "frequency", "n").groupBy("min_df", "frequency").agg(F.sum("n").alias("n"))
    head = Window.partitionBy("min_df").orderBy(F.desc("frequency")).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(head), F.lit(0)))
    each = runs.withColumn("max_features", F.explode(F.array(*[F.lit(k) for k in sizes])))
    room = F.greatest(F.col("max_features") - F.col("before"), F.lit(0))
    taken = F.when(F.col("max_features") == 0, F.col("n")).otherwise(F.least(F.col("n"), room))
    return each.groupBy("min_df", "max_features").agg(
        F.sum(taken).alias("terms"), F.sum(taken * F.col("frequency")).alias("occurrences"),
        F.min(F.when(taken > 0, F.col("frequency"))).alias("least_frequency"))
