"""Map the driver's test tables onto the logical review tables.

The reference works on a review CSV that is not available, so the logical
tables are derived from ``/root/testdata`` (see FIXTURES.md §3).  Each
derivation exists twice: as a DataFrame expression (used by the library and
the bench) and as the equivalent DuckDB SQL (used by the oracle).  Both
derive every value from row *content* (``n_chars``, ``source``, ``lang``), so
exact copies of a document become exact duplicate reviews, as in real data.
No row is dropped or capped by the derivation: every document and every line
item becomes one review.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one test table (projection/filter pushdown applies)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- raw reviews
# Data-quality injections keyed on document length (content, not id):
#   n_chars % 97 = 0  -> rating text 'bad' (coerced to NULL, row dropped)
#   n_chars % 89 = 0  -> rating '11' (outside 1..10, row dropped)
#   n_chars % 11 = 0  -> NULL review text (kept; review_count counts it)
#   n_chars % 101 = 0 -> blank movie name (becomes NULL, row dropped)
#   n_chars % 57 = 0  -> genres '[]' ; n_chars % 61 = 0 -> malformed 'broken'
# Otherwise the rating is 1.0 .. 10.0 in steps of 0.1.

def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    r = n % 91
    rating_text = F.concat(
        (F.lit(1) + F.floor(r / 10)).cast("bigint").cast("string"), F.lit("."),
        (r % 10).cast("string"))
    genres = (
        F.when(n % 57 == 0, F.lit("[]"))
        .when(n % 61 == 0, F.lit("broken"))
        .otherwise(F.concat(
            F.lit("['Src "), F.expr("substring(source, 4)"), F.lit("', '"),
            F.when(n >= 1500, F.lit("Long")).otherwise(F.lit("Short")), F.lit("']")))
    )
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("Unnamed: 0"),
        F.when(n % 97 == 0, F.lit("bad")).when(n % 89 == 0, F.lit("11"))
         .otherwise(rating_text).alias("Ratings"),
        F.when(n % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("Reviews"),
        F.when(n % 101 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("source")))
         .alias("movie_name"),
        F.col("lang").alias("Resenhas"),
        genres.alias("genres"),
        F.col("text").alias("Description"),
        F.upper("lang").alias("emotion"),
    )


RAW_REVIEWS_SQL = """
SELECT
  doc_id AS "Unnamed: 0",
  CASE WHEN n_chars % 97 = 0 THEN 'bad'
       WHEN n_chars % 89 = 0 THEN '11'
       ELSE CAST(1 + (n_chars % 91) // 10 AS VARCHAR) || '.' || CAST((n_chars % 91) % 10 AS VARCHAR)
  END AS Ratings,
  CASE WHEN n_chars % 11 = 0 THEN NULL ELSE text END AS Reviews,
  CASE WHEN n_chars % 101 = 0 THEN '  ' ELSE ' ' || source END AS movie_name,
  lang AS Resenhas,
  CASE WHEN n_chars % 57 = 0 THEN '[]'
       WHEN n_chars % 61 = 0 THEN 'broken'
       ELSE '[''Src ' || substr(source, 4) || ''', ''' ||
            CASE WHEN n_chars >= 1500 THEN 'Long' ELSE 'Short' END || ''']'
  END AS genres,
  text AS Description,
  upper(lang) AS emotion
FROM documents
"""


# ------------------------------------------------------------- big reviews
# One review per line item: the part is the described item, its type the
# label (6 classes), the discount the rating (1.0 .. 10.0).

def reviews_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount",
        "l_returnflag", "l_linestatus")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    j = li.join(pa, li.l_partkey == pa.p_partkey, "inner")
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("Unnamed: 0"),
        F.round(F.lit(1.0) + F.lit(90.0) * F.col("l_discount"), 1).alias("Ratings"),
        F.concat_ws("-", "l_returnflag", "l_linestatus", F.col("l_suppkey").cast("string"))
         .alias("Reviews"),
        F.col("p_name").alias("movie_name"),
        F.col("p_brand").alias("Resenhas"),
        F.concat(F.lit("['"), F.replace("p_name", F.lit(" "), F.lit("', '")), F.lit("']"))
         .alias("genres"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("Description"),
        F.col("p_type").alias("emotion"),
    )


REVIEWS_BIG_SQL = """
SELECT
  l_orderkey * 8 + l_linenumber AS "Unnamed: 0",
  round(1.0 + 90.0 * l_discount, 1) AS Ratings,
  concat_ws('-', l_returnflag, l_linestatus, CAST(l_suppkey AS VARCHAR)) AS Reviews,
  p_name AS movie_name,
  p_brand AS Resenhas,
  '[''' || replace(p_name, ' ', ''', ''') || ''']' AS genres,
  'part ' || CAST(l_partkey AS VARCHAR) AS Description,
  p_type AS emotion
FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def source_reviews(spark: SparkSession, sf_dir: str, kind: str = "documents") -> DataFrame:
    return raw_reviews(spark, sf_dir) if kind == "documents" else reviews_big(spark, sf_dir)


def source_reviews_sql(kind: str = "documents") -> str:
    return RAW_REVIEWS_SQL if kind == "documents" else REVIEWS_BIG_SQL
