"""Queries for tokens, n-grams and term statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from emolens.functions.text import english_stop_words, ngrams, sql_string_list, tokenize
from emolens.operators import terms as T
from emolens.plans.catalog import register
from emolens.plans.q_prep import _desc, _with
from emolens.plans.q_stats import _LONG, _major

STOPS = "[" + sql_string_list(english_stop_words()) + "]"


def tokens_sql(col: str) -> str:
    return ("list_filter(regexp_extract_all(lower(" + col + "), '[\\p{L}\\p{N}_]{2,}'), "
            "lambda t: NOT list_contains(" + STOPS + ", t))")


def bigrams_sql(col: str) -> str:
    return f"list_transform(range(1, len({col})), lambda i: {col}[i] || ' ' || {col}[i + 1])"


def _toks_cte(extra=""):
    return f""", toks AS (SELECT Description, emotion{extra}, {tokens_sql('Description')} AS toks FROM descriptions)"""


@register("explode_tokens", _with() + _LONG.format(k=15) + " SELECT Description, genre_token FROM long")
def q_explode(spark, sf):
    """One row per (description, genre token); empty lists give unknown_genre."""
    return T.explode_tokens(_desc(spark, sf)).select("Description", "genre_token")


@register("top_k_tokens", _with() + _LONG.format(k=15) + " SELECT genre_token, c AS description_count FROM top")
def q_top_k_tokens(spark, sf):
    return T.top_k_tokens(T.explode_tokens(_desc(spark, sf)), k=15)


@register("restrict_to_top", _with() + _LONG.format(k=12) + " SELECT Description, emotion, genre_token FROM major")
def q_restrict(spark, sf):
    return _major(spark, sf, 12).select("Description", "emotion", "genre_token")


@register("is_in_top", _with() + _LONG.format(k=12) + """ SELECT genre_token IN (SELECT genre_token FROM top) AS in_top,
 count(*) AS count FROM long GROUP BY 1""")
def q_is_in_top(spark, sf):
    long = T.explode_tokens(_desc(spark, sf))
    top = T.top_k_tokens(long, k=12).select("genre_token", F.lit(True).alias("in_top"))
    flagged = long.join(F.broadcast(top), "genre_token", "left")
    return flagged.groupBy(F.coalesce("in_top", F.lit(False)).alias("in_top")).agg(
        F.count(F.lit(1)).alias("count"))


@register("tokenize", _with() + _toks_cte() + """ SELECT Description, CAST(len(toks) AS BIGINT) AS token_count,
 array_to_string(toks, ' ') AS tokens FROM toks""")
def q_tokenize(spark, sf):
    """Lower-cased word tokens (>= 2 word characters) without stop words, whole texts."""
    t = tokenize("Description")
    return _desc(spark, sf).select("Description", F.size(t).cast("bigint").alias("token_count"),
                                   F.array_join(t, " ").alias("tokens"))


@register("ngrams", _with() + _toks_cte() + f""" SELECT Description, CAST(len({bigrams_sql('toks')}) AS BIGINT) AS bigram_count,
 array_to_string({bigrams_sql('toks')}, '|') AS bigrams FROM toks""")
def q_ngrams(spark, sf):
    """Bigrams built after stop-word removal."""
    b = ngrams(tokenize("Description"), 2)
    return _desc(spark, sf).select("Description", F.size(b).cast("bigint").alias("bigram_count"),
                                   F.array_join(b, "|").alias("bigrams"))


def _top_sql(grams: str, k: int, by_class: bool = False):
    unn = f"SELECT Description, emotion, unnest({grams}) AS term FROM toks"
    if not by_class:
        return f""", g AS ({unn}),
 st AS (SELECT term, count(*) AS frequency, count(DISTINCT Description) AS document_frequency FROM g GROUP BY term)
 SELECT term, frequency FROM st WHERE document_frequency >= 2 ORDER BY frequency DESC, term LIMIT {k}"""
    return f""", g AS ({unn}),
 st AS (SELECT emotion, term, count(*) AS frequency, count(DISTINCT Description) AS document_frequency
   FROM g GROUP BY emotion, term),
 r AS (SELECT emotion, term, frequency, row_number() OVER (PARTITION BY emotion ORDER BY frequency DESC, term) AS position
   FROM st WHERE document_frequency >= 2)
 SELECT emotion, term, frequency, position FROM r WHERE position <= {k}"""


@register("top_terms", _with() + _toks_cte() + _top_sql("toks", 20))
def q_top_terms(spark, sf):
    """20 most frequent unigrams among terms in >= 2 descriptions."""
    return T.top_terms(_desc(spark, sf), ngram=(1, 1), k=20)


@register("top_bigrams", _with() + _toks_cte() + _top_sql(bigrams_sql("toks"), 20))
def q_top_bigrams(spark, sf):
    return T.top_terms(_desc(spark, sf), ngram=(2, 2), k=20)


@register("top_terms_by_class", _with() + _toks_cte() + _top_sql("toks", 5, by_class=True))
def q_top_terms_by_class(spark, sf):
    """5 most frequent terms per emotion, min_df counted inside the class."""
    return T.top_terms_by_class(_desc(spark, sf), k=5)


@register("term_stats", _with() + _toks_cte() + f""", g AS (SELECT Description, unnest(list_concat(toks, {bigrams_sql('toks')})) AS term FROM toks)
 SELECT term, count(*) AS frequency, count(DISTINCT Description) AS document_frequency FROM g GROUP BY term""")
def q_term_stats(spark, sf):
    """Corpus and document frequency of every unigram and bigram."""
    tf = T.doc_terms(_desc(spark, sf), "Description", "Description", (1, 2))
    return T.term_stats(tf, "Description")


MIN_DFS, MAX_FEATURES = (1, 2, 3, 5, 10), (500, 1000, 2000, 5000, 0)


@register("vocabulary_grid", _with() + _toks_cte() + f""", g AS (SELECT Description, unnest(toks) AS term FROM toks),
 st AS (SELECT term, count(*) AS cf, count(DISTINCT Description) AS df FROM g GROUP BY term),
 s AS (SELECT m.v AS min_df, k.v AS max_features FROM (VALUES {", ".join(f"({m})" for m in MIN_DFS)}) m(v)
   CROSS JOIN (VALUES {", ".join(f"({k})" for k in MAX_FEATURES)}) k(v)),
 r AS (SELECT min_df, max_features, cf, row_number() OVER (PARTITION BY min_df, max_features ORDER BY cf DESC, term) AS pos
   FROM st JOIN s ON df >= min_df WHERE df <= 0.95 * (SELECT count(*) FROM descriptions))
 SELECT min_df, max_features, count(*) AS terms, CAST(sum(cf) AS BIGINT) AS occurrences, min(cf) AS least_frequency
 FROM r WHERE max_features = 0 OR pos <= max_features GROUP BY min_df, max_features""")
def q_vocabulary_grid(spark, sf):
    """Vocabulary size and coverage of every (min_df, max_features) setting."""
    d = _desc(spark, sf)
    stats = T.term_stats(T.doc_terms(d, "Description", "Description"), "Description")
    return T.vocabulary_grid(stats, MIN_DFS, MAX_FEATURES, F.lit(0.95) * d.select(F.count(F.lit(1))).scalar())
