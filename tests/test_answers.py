"""Inputs that the test tables avoid: NULLs, quotes, odd numbers, guards."""

import math

import pytest
from pyspark.sql import functions as F

from emolens.functions.text import parse_list_literal, to_double
from emolens.ml.models import Candidate, make_estimator
from emolens.operators import clean, eda
from emolens.operators.describe import list_literal
from emolens.plans.prepare import modelling_table


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "c string").select(expr.alias("x")).first().x


@pytest.mark.parametrize(("text", "value"), [
    ("5", 5.0), (" -1.5e2 ", -150.0), (".5", 0.5), ("5.", 5.0), ("inf", math.inf), ("5d", None), ("5f", None), ("1e", None),
    ("nan", None), ("", None), ("abc", None), (None, None), ("1_000", None),
])
def test_to_double(spark, text, value):
    assert one(spark, text, to_double("c")) == value


@pytest.mark.parametrize(("text", "items"), [
    ("['Drama', 'Romance']", ["Drama", "Romance"]), ("['Drama',]", ["Drama"]), ("['a'] junk", []), ("[None]", ["None"]),
    ("[True, 1.5]", ["True", "1.5"]), ("[\"Children's\", 'Drama']", ["Children's", "Drama"]), (r"['a\'b']", ["a'b"]),
    ("['a, b', 'c]']", ["a, b", "c]"]), ("[]", []), ("[ ]", []), ("broken", []), ("['a' 'b']", ["ab"]), ("[,]", []), ("['', ' x ']", ["x"]),
    ("[['a']]", ["['a']"]), (None, []), ("[1.2.3]", []), (r"['\x41\tb', '\d']", ["A\tb", r"\d"]), ("[007]", []), ("[1.50, -2, 1e3]", ["1.5", "-2", "1000.0"]),
    ("(['a'])", ["a"]), ("{'a': ['b']}", []), ("['a', b]", []), ("['unclosed", []), ("[" * 500 + "]" * 500, []), ("[[[]], 'a']", ["[[]]", "a"]), ("['a'],", []),
])
def test_parse_list_literal(spark, text, items):
    assert one(spark, text, parse_list_literal("c")) == items


@pytest.mark.parametrize("items", [["a", "b"], ["Children's", "Drama"], ['say "x"'], ["it's \"x\""], ["back\\slash"], []])
def test_list_literal_round_trip(spark, items):
    text = spark.createDataFrame([(items,)], "c array<string>").select(list_literal(F.col("c")).alias("x")).first().x
    assert text == str(items)
    assert one(spark, text, parse_list_literal("c")) == items


def test_correlation_uses_rows_with_both_values(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (1000.0, None), (None, -500.0)], "x double, y double")
    assert eda.correlation_pair(df, "x", "y").first()[0] == pytest.approx(1.0)
    got = {(r.feature_x, r.feature_y): r.correlation for r in eda.correlation_matrix(df, ["x", "y"]).collect()}
    assert got["x", "y"] == got["y", "x"] == pytest.approx(1.0)


def test_modelling_table_drops_only_small_classes(spark):
    df = spark.createDataFrame([("a", i) for i in range(6)] + [("b", i) for i in range(5)] + [("c", i) for i in range(4)], "emotion string, n int")
    assert {r.emotion for r in modelling_table(df, 5).collect()} == {"a", "b"}


def test_guards_raise(spark):
    two = spark.createDataFrame([("d", "joy"), ("d", "fear")], "Description string, emotion string")
    with pytest.raises(ValueError, match="more than one"):
        clean.assert_no_conflicts(two)
    good = ("d", 5.0, "g")
    for rows, what in (([good, good], "key"), ([("d", None, "g")], "missing"), ([("d", 11.0, "g")], "rating"), ([("d", 5.0, " ")], "text")):
        bad = spark.createDataFrame(rows, "Description string, mean_rating double, genres_text string")
        with pytest.raises(ValueError, match=f"{what}.*check"):
            clean.validate_processed(bad)
    clean.validate_processed(spark.createDataFrame([good], "Description string, mean_rating double, genres_text string"))


def test_candidates_say_what_they_fit():
    from pyspark.sql import SparkSession
    assert SparkSession.getActiveSession() is not None
    with pytest.raises(ValueError, match="depth 30"):
        make_estimator(Candidate("decision_tree", {"max_depth": 40}), 3, 2)
    assert make_estimator(Candidate("decision_tree", {"max_depth": None}), 3, 2).getMaxDepth() == 30
    assert make_estimator(Candidate("mlp", {"lr": 0.3}), 3, 2).getSolver() == "gd"
    assert make_estimator(Candidate("mlp", {}), 3, 2).getSolver() == "l-bfgs"


def test_svd_refuses_too_many_components(spark):
    from pyspark.ml.linalg import Vectors

    from emolens.ml.vectors import svd_fit
    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),), (Vectors.dense([0.5, 1.0]),)], ["features"])
    with pytest.raises(ValueError, match="components"):
        svd_fit(df, 2)


def test_feature_row_defaults_and_own_values(spark):
    from emolens.operators.recommend import feature_row
    req = spark.createDataFrame([(1, " A story ", "Comedy Drama", None, None, 3), (2, "B", None, 8.0, 7.5, -4), (3, " ", "x", None, None, None)],
                                "request_id int, description string, preferred_genre string, mean_rating double, median_rating double, review_count int")
    rows, rejects = feature_row(req)
    got = {r.request_id: r for r in rows.collect()}
    assert [r.request_id for r in rejects.collect()] == [3] and set(got) == {1, 2}
    assert (got[1].genres_text, got[1].genre_count, got[1].mean_rating, got[1].median_rating) == ("comedy drama", 2, 5.5, 5.5)
    assert (got[2].genres_text, got[2].genre_count, got[2].mean_rating, got[2].median_rating) == ("unknown_genre", 1, 8.0, 7.5)
    assert got[2].log_review_count == 0.0
    own, _ = feature_row(req, compat=False)
    assert {r.request_id: (r.genres_text, r.genre_count) for r in own.collect()} == {1: ("comedy_drama", 1), 2: ("unknown_genre", 0)}


def test_preparation_checks_by_default(spark):
    from emolens.plans.prepare import prepare_descriptions
    schema = "`Unnamed: 0` long, Ratings string, Reviews string, movie_name string, Resenhas string, genres string, Description string, emotion string"
    rows = [(0, "5", "r", "m", "x", "['a']", "d", "joy"), (1, "6", "s", "m", "x", "['a']", "d", "fear")]
    with pytest.raises(ValueError, match="key check"):
        prepare_descriptions(spark.createDataFrame(rows, schema))
    assert prepare_descriptions(spark.createDataFrame(rows[:1], schema)).count() == 1
    assert prepare_descriptions(spark.createDataFrame(rows, schema), check=False).count() == 2
