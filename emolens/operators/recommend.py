"""Catalogue scoring and ranked recommendation.

* scores use table-wide min/max, obtained as one scalar subquery;
* "one row per title, the best first" is a ``min_by`` aggregate over a
  struct sort key — partial aggregation keeps a hot title from landing in
  one task, unlike a window partitioned by title;
* batch requests are answered per *distinct request key* (label, genre,
  minimum rating) from rating bands: the catalogue is cut into bands once per
  (label, genre), each band keeps its n best titles, and a key joins only
  those.  Requests with no hit fall back to the same search without the genre
  filter (``left_anti`` + union).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emolens.functions.text import UNKNOWN_CATEGORY, char_count, trim_unicode, word_count

# Fixed values that must equal the reference behaviour:
RATING_WEIGHT, POPULARITY_WEIGHT = 0.75, 0.25
DEFAULT_RATING, DEFAULT_REVIEWS, DEFAULT_N = 5.5, 1, 10
OUTPUT_COLUMNS = ["movie_name", "predicted_emotion", "genres_text", "mean_rating",
                  "review_count", "recommendation_score"]


def min_max_score(df: DataFrame, column: str) -> Column:
    """(x - min) / (max - min) over the whole table; 0.0 when constant."""
    b = df.select(F.struct(F.min(column).cast("double").alias("lo"),
                           F.max(column).cast("double").alias("hi"))).scalar()
    return F.when(b["hi"] == b["lo"], F.lit(0.0)).otherwise(
        (F.col(column) - b["lo"]) / (b["hi"] - b["lo"]))


def weighted_score(rating: str = "rating_score", popularity: str = "popularity_score") -> Column:
    return RATING_WEIGHT * F.col(rating) + POPULARITY_WEIGHT * F.col(popularity)


def score_catalogue(scored: DataFrame, predicted: str = "predicted_emotion") -> DataFrame:
    """Add rating / popularity / recommendation scores to predicted rows.

    Both min/max pairs come from one scalar subquery (one extra scan)."""
    b = scored.select(F.struct(
        F.min("mean_rating").cast("double").alias("rlo"), F.max("mean_rating").cast("double").alias("rhi"),
        F.min("log_review_count").cast("double").alias("plo"),
        F.max("log_review_count").cast("double").alias("phi"))).scalar()

    def mm(c, lo, hi):
        return F.when(b[hi] == b[lo], F.lit(0.0)).otherwise((F.col(c) - b[lo]) / (b[hi] - b[lo]))

    out = scored.withColumns({"rating_score": mm("mean_rating", "rlo", "rhi"),
                              "popularity_score": mm("log_review_count", "plo", "phi")})
    return out.withColumn("recommendation_score", weighted_score())


def genre_token(c: Column) -> Column:
    """Normalise a requested genre like the catalogue tokens."""
    return F.replace(F.lower(trim_unicode(c)), F.lit(" "), F.lit("_"))


def _ranked(c: str) -> Column:
    """Rank on values rounded to 9 decimals: averages differ in the last
    bits with summation order, which must not reorder equal scores."""
    return F.round(F.col(c), 9)


def _sort_key() -> Column:
    # best first: score desc, rating desc, then title and key as tie breakers
    return F.struct((-_ranked("recommendation_score")).alias("a"), (-_ranked("mean_rating")).alias("b"),
                    F.col("Description").alias("c"))


def dedup_keep_best(df: DataFrame, title: str = "movie_name", keys=()) -> DataFrame:
    """One row per (keys..., title): the best by score, rating, then key."""
    cols = [c for c in df.columns if c not in (*keys, title)]
    best = df.groupBy(*keys, title).agg(F.min_by(F.struct(*cols), _sort_key()).alias("_r"))
    return best.select(*keys, title, "_r.*")


def top_n(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(_ranked("recommendation_score").desc(), _ranked("mean_rating").desc(),
                      F.asc("movie_name")).limit(int(n))


def recommend(catalogue: DataFrame, emotion: str, preferred_genre: str | None = None,
              minimum_rating: float = 0.0, n: int = DEFAULT_N) -> DataFrame:
    """Single request: filter label and rating, optional exact genre token,
    best row per title, top n, six output columns."""
    c = catalogue.where((F.lower("predicted_emotion") == emotion.strip().lower())
                        & (F.col("mean_rating") >= float(minimum_rating)))
    if preferred_genre:
        g = preferred_genre.strip().lower().replace(" ", "_")
        c = c.where(F.array_contains(F.split("genres_text", " "), g))
    return top_n(dedup_keep_best(c), n).select(*OUTPUT_COLUMNS)


def _answer(keys: DataFrame, catalogue: DataFrame, use_genre: bool) -> DataFrame:
    """Top-n per request key (label, genre, minimum_rating, n); genre ''
    means no genre filter.

    The thresholds asked for a (label, genre) cut the ratings into bands, and
    a catalogue row is sorted into its band once per genre of its own that is
    asked for, however many thresholds there are.  Each band keeps its best n
    titles (combined map-side, the group limit before the shuffle).  A key is
    answered from the bands at or above its threshold: a title among the n
    best of all of them is among the n best of its own band, so nothing is
    lost, and no key meets more than bands x n rows."""
    wide = keys.groupBy("_label", "_genre").agg(F.sort_array(F.collect_set("minimum_rating")).alias("_cuts"), F.max("n").alias("_most"))
    genres = F.array_union(F.array(F.lit("")), F.split("genres_text", " ")) if use_genre else F.array(F.lit(""))
    cat = catalogue.select(*OUTPUT_COLUMNS, "Description", F.lower("predicted_emotion").alias("_label"), F.explode(
        F.coalesce(genres, F.array(F.lit("")))).alias("_genre"))
    band = F.size(F.filter("_cuts", lambda t: t <= F.col("mean_rating")))
    cand = cat.join(wide, ["_label", "_genre"]).withColumn("_band", band).where(F.col("_band") > 0).drop("_cuts")
    best = dedup_keep_best(cand, "movie_name", ["_label", "_genre", "_band", "_most"])
    tops = _numbered(best, ["_label", "_genre", "_band"]).where(F.col("position") <= F.col("_most")).drop("position", "_most")
    placed = keys.join(wide.drop("_most"), ["_label", "_genre"]).withColumn("_from", F.array_position("_cuts", F.col("minimum_rating"))).drop("_cuts")
    met = placed.join(tops, ["_label", "_genre"]).where(F.col("_band") >= F.col("_from")).drop("_band", "_from")
    ranked = _numbered(dedup_keep_best(met, "movie_name", KEY_COLUMNS), KEY_COLUMNS)
    return ranked.where(F.col("position") <= F.col("n")).drop("Description")


def _numbered(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows with their ``position`` per group, the best first."""
    w = Window.partitionBy(*by).orderBy(_ranked("recommendation_score").desc(), _ranked("mean_rating").desc(), F.asc("movie_name"))
    return df.withColumn("position", F.row_number().over(w))


KEY_COLUMNS = ["_label", "_genre", "minimum_rating", "n"]


def request_keys(requests: DataFrame, label: str = "predicted_label") -> DataFrame:
    return requests.select(
        "request_id", F.lower(F.col(label)).alias("_label"),
        genre_token(F.coalesce(F.col("preferred_genre"), F.lit(""))).alias("_genre"),
        F.coalesce(F.col("minimum_rating").cast("double"), F.lit(0.0)).alias("minimum_rating"),
        F.coalesce(F.col("n").cast("int"), F.lit(DEFAULT_N)).alias("n"))


def recommend_batch(requests: DataFrame, catalogue: DataFrame, label: str = "predicted_label",
                    fallback: bool = True) -> DataFrame:
    """Many requests in one job.  ``requests`` has request_id, ``label``,
    preferred_genre, minimum_rating, n; output one row per recommendation
    with its position and whether it came from the genre-free fallback."""
    req = request_keys(requests, label)
    keys = req.select(*KEY_COLUMNS).distinct()
    hits = req.join(_answer(keys, catalogue, True), KEY_COLUMNS).withColumn("fallback", F.lit(False))
    out = hits
    if fallback:
        missing = req.join(hits.select("request_id").distinct(), "request_id", "left_anti")
        relaxed_keys = (missing.select("_label", "minimum_rating", "n").distinct()
                        .withColumn("_genre", F.lit("")))
        relaxed = _answer(relaxed_keys, catalogue, False).drop("_genre")
        back = missing.join(relaxed, ["_label", "minimum_rating", "n"])
        out = out.unionByName(back.withColumn("fallback", F.lit(True)))
    return out.select("request_id", "position", *OUTPUT_COLUMNS, "fallback")


def feature_row(requests: DataFrame, text: str = "description", genre: str = "preferred_genre",
                rating: str = "mean_rating", reviews: str = "review_count",
                median: str = "median_rating", compat: bool = True) -> tuple[DataFrame, DataFrame]:
    """Request rows -> model input (the 10 model columns) and rejects.

    Defaults: rating 5.5, the median as given or else the mean, 1 review,
    genre ``unknown_genre``; a negative review count becomes 0; blank text is
    rejected.  Genres are the words of the lower-case genre text and
    ``unknown_genre`` counts as one; ``compat=False`` applies the training
    semantics (``unknown_genre`` counts 0, a genre's spaces become ``_``).
    """
    d = trim_unicode(F.col(text))
    g_raw = F.lower(trim_unicode(F.coalesce(F.col(genre), F.lit(""))))
    g = g_raw if compat else F.replace(g_raw, F.lit(" "), F.lit("_"))
    g = F.when(g == "", F.lit(UNKNOWN_CATEGORY)).otherwise(g)
    n_genres = word_count(g)
    if not compat:
        n_genres = F.when(g == UNKNOWN_CATEGORY, F.lit(0).cast("bigint")).otherwise(n_genres)
    mean = F.coalesce(F.col(rating).cast("double"), F.lit(DEFAULT_RATING)) if rating in requests.columns \
        else F.lit(DEFAULT_RATING)
    med = F.coalesce(F.col(median).cast("double"), mean) if median in requests.columns else mean
    rc = F.col(reviews).cast("bigint") if reviews in requests.columns else F.lit(DEFAULT_REVIEWS)
    rc = F.greatest(F.coalesce(rc, F.lit(DEFAULT_REVIEWS)), F.lit(0))
    rows = requests.withColumn("_d", d)
    ok = rows.where(F.col("_d") != "")
    rejects = rows.where((F.col("_d") == "") | F.col("_d").isNull()).drop("_d")
    model_input = ok.select(
        "request_id", F.col("_d").alias("Description"), g.alias("genres_text"),
        mean.alias("mean_rating"), med.alias("median_rating"), n_genres.alias("genre_count"),
        word_count("_d").alias("description_word_count"),
        char_count("_d").alias("description_character_count"),
        F.lit(0.0).alias("rating_range"), F.log1p(rc).alias("log_review_count"),
        F.log1p(rc).alias("log_unique_review_count"))
    return model_input, rejects


def classified_requests(requests: DataFrame, classify, doc: str, label: str = "predicted_label", **names) -> DataFrame:
    """Requests with the label that ``classify`` (rows, output column) gives
    their text; a request with a blank text cannot be answered and goes."""
    model_input, _ = feature_row(requests, **names)
    rows = model_input.withColumn(doc, F.concat(F.lit("r:"), F.col("request_id").cast("string")))
    return requests.join(classify(rows, label).select("request_id", label), "request_id")
