"""Readers and writers.

Everything goes through ``spark.read`` / ``df.write``; nothing is assembled
on the driver.  CSV is read with an explicit schema (no inference pass).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from emolens.operators.describe import list_literal

# The spellings a pandas CSV read treats as missing by default.
NULL_SPELLINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                  "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                  "nan", "null"]

RAW_SCHEMA = StructType([
    StructField("Unnamed: 0", LongType()),
    StructField("Ratings", StringType()),
    StructField("Reviews", StringType()),
    StructField("movie_name", StringType()),
    StructField("Resenhas", StringType()),
    StructField("genres", StringType()),
    StructField("Description", StringType()),
    StructField("emotion", StringType()),
])

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
               # the CSV writer strips edge whitespace unless told not to
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_reviews_csv(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA,
                     null_spellings=NULL_SPELLINGS) -> DataFrame:
    """Raw review CSV with the given schema; pandas-style null spellings
    become NULL (the list is a parameter)."""
    df = spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)
    spell = list(null_spellings)
    return df.withColumns({f.name: F.when(F.col(f"`{f.name}`").isin(spell), F.lit(None).cast("string"))
                           .otherwise(F.col(f"`{f.name}`"))
                           for f in schema.fields if isinstance(f.dataType, StringType)})


def write_reviews_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_descriptions(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Parquet keeps the list column; CSV renders it as ``['a', 'b']``."""
    if fmt == "csv":
        df = df.withColumn("genre_list", list_literal(F.col("genre_list")))
        df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_results(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Result tables (metrics, reports, comparisons, predictions)."""
    w = df.write.mode("overwrite")
    if fmt == "json":
        w.json(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        w.options(header="true").csv(path)


def read_metrics_long(spark: SparkSession, path: str, key: str = "model") -> DataFrame:
    """``(key, metric, score)`` CSV -> one row per key, one column per metric."""
    long = spark.read.options(header="true").schema(
        f"`{key}` string, metric string, score double").csv(path)
    return long.groupBy(key).pivot("metric").agg(F.first("score"))


SUMMARY_SCHEMA = ("model string, random_state int, best_parameters map<string,string>, "
                  "metrics map<string,double>")


def read_summary_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Model summaries (nested parameters and metrics): one pretty-printed
    document per file (``multi_line``) or JSON Lines as Spark writes them."""
    return spark.read.option("multiLine", str(multi_line).lower()).schema(SUMMARY_SCHEMA).json(path)


def write_model_result(metrics: DataFrame, base: str, model: str, parameters: dict) -> None:
    """A model's (metric, score) rows and its parameters as one row below
    ``base/model=<name>``.  Families need not agree in either."""
    wide = metrics.groupBy().pivot("metric").agg(F.first("score"))
    wide = wide.withColumns({f"param_{k}": F.lit(v) for k, v in parameters.items()})
    wide.coalesce(1).write.mode("overwrite").parquet(f"{base}/model={model}")


def collect_model_results(spark: SparkSession, base: str) -> DataFrame:
    """All models' folders below ``base`` in one read: a ranked row per model
    with every metric and parameter that any of them has (NULL where a model
    has none).  A missing accuracy gap is train less test accuracy."""
    from emolens.operators.evaluate import LEADERBOARD_METRICS, model_leaderboard

    # model names are text, whatever they look like
    rows = spark.read.option("mergeSchema", "true").parquet(base).withColumn("model", F.col("model").cast("string"))
    have = [m for m in LEADERBOARD_METRICS if m in rows.columns]
    board = model_leaderboard(rows.select("model", *have).unpivot(["model"], have, "metric", "score").where("score IS NOT NULL"))
    rest = [c for c in rows.columns if c not in LEADERBOARD_METRICS and c != "model"]
    return board.join(rows.select("model", *rest), "model")
