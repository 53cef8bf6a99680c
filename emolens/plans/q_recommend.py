"""Queries for catalogue scoring and recommendation (SURVEY §2.4 scores,
§2.6 dedup/top-n, §2.11 recommend*).

The workload with given labels.  Catalogue: one row per part from the
line-item reviews (title = part name, label = part type, genres = the words of
the name).  Requests: one per ``benchmark`` item; the genre, minimum rating
and label follow from the text length.  Catalogue and requests whose labels a
fitted pipeline predicts are in `q_pipeline`.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from emolens.operators import recommend as R
from emolens.plans.catalog import register
from emolens.plans.q_prep import _desc, _with
from emolens.plans.sqlparts import r6
from emolens.session import cut_lineage
from emolens.sources.fixtures import table

LABELS = ["economy", "large", "medium", "promo", "small", "standard"]


def catalogue(spark, sf):
    d = _desc(spark, sf, "big").select(
        "Description", "movie_name", F.col("emotion").alias("predicted_emotion"), "genres_text",
        "mean_rating", "review_count", "log_review_count")
    return R.score_catalogue(d)


def requests(spark, sf):
    b = table(spark, sf, "benchmark")
    n = F.length("text")
    return b.select(
        F.col("item_id").alias("request_id"), F.col("text").alias("description"),
        F.when(n % 3 == 0, F.lit(None).cast("string")).when(n % 3 == 1, F.lit("Red"))
         .otherwise(F.lit(" small ")).alias("preferred_genre"),
        F.when(n % 2 == 0, F.lit(0.0)).otherwise(F.lit(5.0)).alias("minimum_rating"),
        F.lit(5).alias("n"),
        F.element_at(F.array(*[F.lit(x) for x in LABELS]), (n % 6 + 1).cast("int"))
         .alias("predicted_label"))


CAT_SQL = _with("big") + """,
 cb AS (SELECT min(mean_rating) AS rlo, max(mean_rating) AS rhi, min(log_review_count) AS plo,
   max(log_review_count) AS phi FROM descriptions),
 c0 AS (SELECT Description, movie_name, emotion AS predicted_emotion, genres_text, mean_rating, review_count,
   log_review_count,
   CASE WHEN rhi = rlo THEN 0.0 ELSE (mean_rating - rlo) / (rhi - rlo) END AS rating_score,
   CASE WHEN phi = plo THEN 0.0 ELSE (log_review_count - plo) / (phi - plo) END AS popularity_score
   FROM descriptions, cb),
 cat AS (SELECT *, 0.75 * rating_score + 0.25 * popularity_score AS recommendation_score FROM c0)"""

REQ_SQL = """,
 req AS (SELECT item_id AS request_id, text AS description,
   CASE length(text) % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Red' ELSE ' small ' END AS preferred_genre,
   CASE length(text) % 2 WHEN 0 THEN 0.0 ELSE 5.0 END AS minimum_rating, 5 AS n,
   (['economy', 'large', 'medium', 'promo', 'small', 'standard'])[length(text) % 6 + 1] AS predicted_label
   FROM benchmark),
 rk AS (SELECT request_id, lower(predicted_label) AS lbl,
   replace(lower(trim(coalesce(preferred_genre, ''))), ' ', '_') AS g, minimum_rating, n FROM req)"""

OUT6 = f"movie_name, predicted_emotion, genres_text, {r6('mean_rating')} AS mean_rating, review_count, {r6('recommendation_score')} AS recommendation_score"


@register("min_max_score", CAT_SQL + f" SELECT Description, {r6('rating_score')} AS rating_score, {r6('popularity_score')} AS popularity_score FROM cat")
def q_minmax(spark, sf):
    return catalogue(spark, sf).select("Description", "rating_score", "popularity_score")


@register("weighted_score", CAT_SQL + f" SELECT Description, {r6('recommendation_score')} AS recommendation_score FROM cat")
def q_weighted(spark, sf):
    return catalogue(spark, sf).select("Description", "recommendation_score")


@register("score_catalogue_big", CAT_SQL + f""" SELECT Description, movie_name, predicted_emotion, genres_text,
 {r6('mean_rating')} AS mean_rating, review_count, {r6('log_review_count')} AS log_review_count,
 {r6('rating_score')} AS rating_score, {r6('popularity_score')} AS popularity_score,
 {r6('recommendation_score')} AS recommendation_score FROM cat""")
def q_score(spark, sf):
    """Every catalogue row with its rating, popularity and combined score."""
    return catalogue(spark, sf)


@register("dedup_keep_best", CAT_SQL + f""" SELECT predicted_emotion, movie_name, Description,
 {r6('recommendation_score')} AS recommendation_score FROM cat
 QUALIFY row_number() OVER (PARTITION BY predicted_emotion, movie_name
   ORDER BY round(recommendation_score, 9) DESC, round(mean_rating, 9) DESC, Description) = 1""")
def q_dedup_best(spark, sf):
    """Best row per (label, title): score, then rating, then key."""
    best = R.dedup_keep_best(catalogue(spark, sf), "movie_name", ("predicted_emotion",))
    return best.select("predicted_emotion", "movie_name", "Description", "recommendation_score")


@register("top_n", CAT_SQL + f""" SELECT Description, {r6('recommendation_score')} AS recommendation_score FROM cat
 ORDER BY round(recommendation_score, 9) DESC, round(mean_rating, 9) DESC, movie_name, Description LIMIT 10""")
def q_top_n(spark, sf):
    c = catalogue(spark, sf)
    return c.orderBy(F.round("recommendation_score", 9).desc(), F.round("mean_rating", 9).desc(),
                     "movie_name", "Description").limit(10).select("Description", "recommendation_score")


@register("recommend", CAT_SQL + f""", f AS (SELECT * FROM cat WHERE lower(predicted_emotion) = 'promo'
   AND mean_rating >= 5.0 AND list_contains(string_split(genres_text, ' '), 'red')),
 b AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY movie_name
   ORDER BY round(recommendation_score, 9) DESC, round(mean_rating, 9) DESC, Description) = 1)
 SELECT {OUT6} FROM b ORDER BY round(recommendation_score, 9) DESC, round(mean_rating, 9) DESC, movie_name LIMIT 10""")
def q_recommend(spark, sf):
    """One request: label 'promo', genre 'Red', minimum rating 5, top 10."""
    return R.recommend(catalogue(spark, sf), "Promo", "Red", 5.0, 10)


def batch_sql(fallback: bool, base: str) -> str:
    """Answers of batch requests; ``base`` has the tables ``cat`` and ``rk``."""
    ans = """
 cand AS (SELECT k.*, c.* FROM {keys} k JOIN cat c ON lower(c.predicted_emotion) = k.lbl
   WHERE c.mean_rating >= k.minimum_rating {genre}),
 best AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY lbl, g, minimum_rating, n, movie_name
   ORDER BY round(recommendation_score, 9) DESC, round(mean_rating, 9) DESC, Description) = 1),
 top AS (SELECT *, row_number() OVER (PARTITION BY lbl, g, minimum_rating, n
   ORDER BY round(recommendation_score, 9) DESC, round(mean_rating, 9) DESC, movie_name) AS position FROM best
   QUALIFY position <= n)"""
    sql = base + ", keys AS (SELECT DISTINCT lbl, g, minimum_rating, n FROM rk)," + ans.format(
        keys="keys", genre="AND (k.g = '' OR list_contains(string_split(c.genres_text, ' '), k.g))") + """,
 hits AS (SELECT r.request_id, t.*, false AS fallback FROM rk r JOIN top t USING (lbl, g, minimum_rating, n))"""
    if not fallback:
        return sql + f" SELECT request_id, CAST(position AS INTEGER) AS position, {OUT6}, fallback FROM hits"
    relaxed = ans.replace("cand AS", "cand2 AS").replace("best AS", "best2 AS").replace(
        "FROM cand ", "FROM cand2 ").replace("top AS", "top2 AS").replace("FROM best\n", "FROM best2\n")
    sql += """,
 miss AS (SELECT * FROM rk WHERE request_id NOT IN (SELECT request_id FROM hits)),
 keys2 AS (SELECT DISTINCT lbl, '' AS g, minimum_rating, n FROM miss),""" + relaxed.format(keys="keys2", genre="")
    sql += f""",
 back AS (SELECT m.request_id, t.*, true AS fallback FROM miss m JOIN top2 t USING (lbl, minimum_rating, n))
 SELECT request_id, CAST(position AS INTEGER) AS position, {OUT6}, fallback FROM hits
 UNION ALL SELECT request_id, CAST(position AS INTEGER) AS position, {OUT6}, fallback FROM back"""
    return sql


def served_catalogue(spark, sf):
    """The scored catalogue is read by every request key and by the
    fallback branch: materialise it once (reliable checkpoint)."""
    return cut_lineage(catalogue(spark, sf))


@register("recommend_given_label", batch_sql(False, CAT_SQL + REQ_SQL))
def q_rec_text(spark, sf):
    """All benchmark requests answered in one job (per distinct key)."""
    return R.recommend_batch(requests(spark, sf), served_catalogue(spark, sf), fallback=False).withColumn(
        "position", F.col("position").cast("int"))


@register("recommend_given_label_fallback", batch_sql(True, CAT_SQL + REQ_SQL))
def q_rec_fallback(spark, sf):
    """Same, and requests without any hit are answered without the genre."""
    return R.recommend_batch(requests(spark, sf), served_catalogue(spark, sf), fallback=True).withColumn(
        "position", F.col("position").cast("int"))


@register("feature_row", """SELECT item_id AS request_id, trim(text) AS Description,
 CASE WHEN lower(trim(coalesce(g, ''))) = '' THEN 'unknown_genre' ELSE lower(trim(coalesce(g, ''))) END AS genres_text,
 5.5 AS mean_rating, 5.5 AS median_rating,
 CAST(CASE WHEN trim(coalesce(g, '')) = '' THEN 1
      ELSE len(regexp_extract_all(trim(g), '\\S+')) END AS BIGINT) AS genre_count,
 CAST(len(regexp_extract_all(trim(text), '\\S+')) AS BIGINT) AS description_word_count,
 CAST(length(trim(text)) AS BIGINT) AS description_character_count, 0.0 AS rating_range,
 """ + r6("ln(2.0)") + " AS log_review_count, " + r6("ln(2.0)") + """ AS log_unique_review_count
 FROM (SELECT *, CASE length(text) % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Red' ELSE ' small ' END AS g FROM benchmark)
 WHERE trim(text) <> ''""")
def q_feature_row(spark, sf):
    """Request text (+ optional genre) -> the 10 model inputs with defaults."""
    model_input, _ = R.feature_row(requests(spark, sf))
    return model_input
