"""Models on vectors where a text has several labels: a vector per row."""

import pytest

from emolens.plans.q_features import DOC, LABEL, rows_apart, train_test_apart

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def several_labels(spark, tmp_path_factory):
    """60 texts of which every third is in two languages."""
    sf = str(tmp_path_factory.mktemp("several_labels"))
    words = ["river", "stone", "cloud", "ember", "frost", "grove"]
    rows = [(i, " ".join(words[(i + j) % 6] * (1 + j % 2) for j in range(4)) + f" number {i}", "en" if i % 2 else "de", f"src{i % 3}", 100 + i)
            for i in range(60)]
    rows += [(100 + i, t, "de" if lang == "en" else "en", s, n) for i, t, lang, s, n in rows if i % 3 == 0]
    spark.createDataFrame(rows, DOCUMENTS).coalesce(1).write.parquet(f"{sf}/documents.parquet")
    return sf


def test_rows_of_one_text_get_keys_of_their_own(spark):
    df = spark.createDataFrame([("a" * 32, "x"), ("a" * 32, "y"), ("b" * 32, "y")], f"{DOC} string, {LABEL} string")
    assert sorted(map(tuple, rows_apart(df).collect())) == [("a" * 32, "x"), ("a" * 32 + ":y", "y"), ("b" * 32, "y")]
    once = df.where("doc like 'b%'")
    assert rows_apart(once) is once


def test_a_vector_for_each_row(spark, several_labels):
    from __spark_entry__ import queries
    tr, te = train_test_apart(spark, several_labels)
    keys = [r[0] for part in (tr, te) for r in part.select(DOC).collect()]
    assert len(set(keys)) == len(keys) and any(":" in k for k in keys)
    got = queries()["clf_logistic"](spark, several_labels).collect()  # vectors of a text in two rows did not fit before
    assert sorted((r.doc, r.actual) for r in got) == sorted((r[0][:32], r[1]) for r in te.select(DOC, LABEL).collect())


def test_the_grid_has_a_key_for_each_row(spark, several_labels, monkeypatch):
    from emolens.plans import q_pipeline
    monkeypatch.setattr(q_pipeline, "grid_search_bayes", lambda train, doc, *_: train.select(doc))
    keys = [r[0] for r in q_pipeline.q_grid(spark, several_labels).collect()]  # one key for both rows of a text before
    assert len(set(keys)) == len(keys) and any(":" in k for k in keys)
