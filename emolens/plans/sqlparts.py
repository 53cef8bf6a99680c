"""DuckDB SQL building blocks for the oracle side of each registered query.

These strings mirror the DataFrame plans in ``emolens.operators`` one CTE at
a time.  They are only used by ``oracle_sql()``; the library never runs SQL
text through DuckDB itself.
"""

from __future__ import annotations

from emolens.sources.fixtures import source_reviews_sql


def r6(expr: str) -> str:
    """Round a double the way the Spark side does (and turn -0.0 into 0.0).

    Averages of one-decimal ratings are often exact binary fractions lying
    on a rounding tie, where the two engines can differ by one ulp; a
    relative nudge of 1e-12 (same on both sides) resolves ties identically.
    """
    return f"(round(CAST({expr} AS DOUBLE) * (1 + 1e-12), 6) + 0.0)"


def trim(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


def blank(expr: str) -> str:
    return f"CASE WHEN regexp_full_match({expr}, '\\s*') THEN NULL ELSE {expr} END"


def cleaned_ctes(kind: str = "documents") -> str:
    """raw -> cleaned -> valid -> dedup CTEs (no WITH keyword)."""
    ratings_text = kind == "documents"
    rating = blank("Ratings") if ratings_text else "Ratings"
    cols = ["Reviews", "movie_name", "Resenhas", "genres", "Description"]
    text = ",\n    ".join(f"{blank(trim(c))} AS {c}" for c in cols)
    return f"""
raw AS ({source_reviews_sql(kind)}),
cleaned AS (
  SELECT _row_id,
    CASE WHEN isnan(TRY_CAST(r AS DOUBLE)) THEN NULL ELSE TRY_CAST(r AS DOUBLE) END AS Ratings,
    Reviews, movie_name, Resenhas, genres, Description, emotion
  FROM (
    SELECT "Unnamed: 0" AS _row_id, {rating} AS r,
    {text},
    {blank('lower(' + trim('emotion') + ')')} AS emotion
    FROM raw)
),
valid AS (
  SELECT * FROM cleaned
  WHERE Description IS NOT NULL AND emotion IS NOT NULL AND movie_name IS NOT NULL
    AND genres IS NOT NULL AND Ratings IS NOT NULL AND Ratings BETWEEN 1 AND 10
),
dedup AS (
  SELECT min(_row_id) AS _row_id, Ratings, Reviews, movie_name, Resenhas, genres, Description, emotion
  FROM valid GROUP BY Ratings, Reviews, movie_name, Resenhas, genres, Description, emotion
)"""


GENRE_LIST = (
    "CASE WHEN regexp_full_match(genres, '\\[\\s*(''[^'']*''(\\s*,\\s*''[^'']*'')*)?\\s*\\]') "
    "THEN list_filter(list_transform(regexp_extract_all(genres, '''([^'']*)''', 1), "
    f"lambda x: {trim('x')}), lambda x: x <> '') ELSE []::VARCHAR[] END"
)


def list_literal(expr: str) -> str:
    plain = "replace(x, '\\', '\\\\')"
    quoted = (f"CASE WHEN contains(x, '\'\'') AND NOT contains(x, '\"') THEN '\"' || {plain} || '\"' "
              f"ELSE '\'\'' || replace({plain}, '\'\'', '\\\'\'') || '\'\'' END")
    return f"'[' || array_to_string(list_transform({expr}, lambda x: {quoted}), ', ') || ']'"


def descriptions_ctes(kind: str = "documents") -> str:
    """... -> described -> descriptions (20 columns, genre_list as list)."""
    return cleaned_ctes(kind) + f""",
described AS (
  SELECT Description, emotion,
    arg_min(movie_name, _row_id) FILTER (WHERE movie_name IS NOT NULL) AS movie_name,
    array_to_string(list_sort(list_distinct(list({trim('movie_name')})
        FILTER (WHERE movie_name IS NOT NULL AND {trim('movie_name')} <> ''))), ' | ') AS all_movie_names,
    count(DISTINCT movie_name) AS movie_name_count,
    arg_min(genres, _row_id) FILTER (WHERE genres IS NOT NULL) AS genres,
    avg(Ratings) AS mean_rating,
    quantile_cont(Ratings, 0.5) AS median_rating,
    min(Ratings) AS minimum_rating,
    max(Ratings) AS maximum_rating,
    count(*) AS review_count,
    count(DISTINCT Reviews) AS unique_review_count
  FROM dedup GROUP BY Description, emotion
),
described_l AS (SELECT *, {GENRE_LIST} AS genre_list FROM described),
descriptions AS (
  SELECT Description, emotion, movie_name, all_movie_names, movie_name_count, genres,
    mean_rating, median_rating, minimum_rating, maximum_rating, review_count,
    unique_review_count, genre_list,
    CAST(len(genre_list) AS BIGINT) AS genre_count,
    coalesce(nullif({trim("array_to_string(list_transform(genre_list, lambda x: replace(lower(" + trim('x') + "), ' ', '_')), ' ')")}, ''),
             'unknown_genre') AS genres_text,
    CAST(len(regexp_extract_all(Description, '\\S+')) AS BIGINT) AS description_word_count,
    CAST(length(Description) AS BIGINT) AS description_character_count,
    maximum_rating - minimum_rating AS rating_range,
    ln(1 + review_count) AS log_review_count,
    ln(1 + unique_review_count) AS log_unique_review_count
  FROM described_l
)"""


DESCRIPTION_SELECT = (
    "Description, emotion, movie_name, all_movie_names, movie_name_count, genres, "
    + ", ".join(r6(c) + " AS " + c for c in ("mean_rating", "median_rating", "minimum_rating",
                                             "maximum_rating"))
    + ", review_count, unique_review_count, "
    + list_literal("genre_list") + " AS genre_list, genre_count, genres_text, "
    + "description_word_count, description_character_count, "
    + ", ".join(r6(c) + " AS " + c for c in ("rating_range", "log_review_count",
                                             "log_unique_review_count"))
)
