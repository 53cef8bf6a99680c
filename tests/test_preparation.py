"""The preparation step on texts with two labels, and its cheaper parts
against the plain ones."""

import duckdb
import pytest
from pyspark.sql import functions as F

from emolens.functions.text import (blank_to_null, nan_to_null, short_key, to_double, trim_or_null,
                                    trim_unicode)
from emolens.operators.clean import clean_reviews, validate_processed
from emolens.operators.describe import describe_per_key

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def two_labels(spark, tmp_path_factory):
    """Documents of which one text is in two languages."""
    sf = str(tmp_path_factory.mktemp("two_labels"))
    rows = [(i, f"some text number {i} of the table", "en" if i % 2 else "de", f"src{i % 3}", 100 + i) for i in range(40)]
    rows += [(100, rows[3][1], "de", "src1", 140), (101, rows[3][1], "en", "src2", 141)]
    spark.createDataFrame(rows, DOCUMENTS).coalesce(1).write.parquet(f"{sf}/documents.parquet")
    return sf


@pytest.mark.parametrize("name", [
    "describe_per_key", "array_count", "char_count", "class_weight_balanced", "crosstab", "correlation_pair",
    "discrete_histogram", "exclude_class", "explode_tokens", "group_mean_nunique", "histogram_word_count",
    "validate_unique_key"])
def test_texts_with_two_labels_are_two_rows(spark, two_labels, name):
    from __spark_entry__ import oracle_sql, queries
    from scripts.oracle_check import rows_of
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{two_labels}/documents.parquet/*.parquet')")
    with pytest.warns(UserWarning, match="key check") if name == "describe_per_key" else _nothing():
        got = queries()[name](spark, two_labels).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


class _nothing:
    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False


def test_other_checks_still_raise_where_keys_may_repeat(spark):
    rows = [("d", 5.0, "g"), ("d", 50.0, "g")]
    bad = spark.createDataFrame(rows, "Description string, mean_rating double, genres_text string")
    with pytest.raises(ValueError, match="key check"):
        validate_processed(bad)
    with pytest.warns(UserWarning, match="key check"), pytest.raises(ValueError, match="rating check"):
        validate_processed(bad, unique_key=False)


def test_distinct_reviews_in_one_shuffle(spark):
    rows = [(i, float(i % 3), r, "m", "g", d, e) for i, (d, e, r) in enumerate([
        ("a", "x", "r"), ("a", "x", "r"), ("a", "x", None), ("a", "x", "s"), ("a", "y", "r"), ("b", "x", None),
        (None, "x", "r"), (None, "x", "q"), ("c", "x", ""), ("c", "x", None), ("c", "x", "")])]
    df = spark.createDataFrame(rows, "_row_id long, Ratings double, Reviews string, movie_name string, genres string, Description string, emotion string")
    out = describe_per_key(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    got = {(r.Description, r.emotion): (r.unique_review_count, r.review_count) for r in out.collect()}
    want = {(r[0], r[1]): (r[2], r[3]) for r in df.groupBy("Description", "emotion").agg(
        F.count_distinct("Reviews"), F.count(F.lit(1))).collect()}
    assert got == want


def test_trim_and_numbers_as_before(spark):
    texts = ["", " ", "　", "a", " a", "a ", "\t\n", "a b", None, " x y ", "1", "5d", "nan", "inf", "-1e3", " 7 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(trim_or_null("t").alias("a"), F.when(trim_unicode("t") == "", None).otherwise(trim_unicode("t")).alias("b"),
                    blank_to_null("t").alias("c"), to_double("t").alias("d")).collect()
    assert all(r.a == r.b for r in got)
    assert [r.d for r in got] == [None] * 10 + [1.0, None, None, float("inf"), -1000.0, 7.0]
    nums = spark.createDataFrame([(1.5,), (None,), (float("nan"),), (float("inf"),), (-0.0,)], "x double")
    r = [tuple(x) for x in nums.select(nan_to_null("x"), to_double("x")).collect()]
    assert all(a == b for a, b in r) and [a for a, _ in r] == [1.5, None, None, float("inf"), 0.0]


def test_numbers_are_not_made_to_text(spark):
    schema = "`Unnamed: 0` long, Ratings double, Reviews string, movie_name string, Resenhas string, genres string, Description string, emotion string"
    df = clean_reviews(spark.createDataFrame([(1, 5.0, "r", "m", "x", "g", "d", "e")], schema))
    assert "RLIKE" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_short_keys_tell_texts_apart(spark):
    texts = ["x" * 63, "x" * 64, "x" * 65, "y" * 64, "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(short_key("t")).collect()]
    assert got[0] == texts[0] and got[4] == "" and got[5] is None
    assert len(set(got)) == len(texts) and all(len(x) == 64 for x in got[1:4])
