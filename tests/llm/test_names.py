"""Extra columns with names that hold a dot or that an operator uses itself."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from emolens.llm import bpe, line_dedup, pii
from tests.llm.data import awkward

NAMES = ["meta.url", "a", "b", "h_", "t_", "d_", "pos_", "drop_", "k_", "text_hash", "text_hash_", "plan_", "start", "spans", "kind", "entity",
         "draw", "chunk", "first", "n", "cut", "digest", "class_id", "bits", "words", "surrogate", "seq.id"]


def extended(spark):
    docs = awkward(spark)
    extra = {n: F.concat_ws("-", F.lit(n), F.col("doc_id")) for n in NAMES}
    return docs.withColumns(extra)


def own(df):
    """Rows of the test's columns, in order."""
    names = ["doc_id", "text", *NAMES]
    return sorted((tuple(r[n] for n in names) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=str)


def expected(docs, plain):
    """``plain``: the result without extra columns."""
    return sorted(((r["doc_id"], r["text"], *["-".join([n] + ([str(r["doc_id"])] if r["doc_id"] is not None else [])) for n in NAMES])
                   for r in plain.collect()), key=str)


@pytest.mark.parametrize("apply", [line_dedup.remove_shared_runs, line_dedup.remove_repeated_chunks, pii.replace_entities],
                         ids=["runs", "chunks", "surrogates"])
def test_texts_do_not_depend_on_other_columns(spark, apply):
    docs = extended(spark)
    out = apply(docs)
    assert out.columns == docs.columns
    assert own(out) == expected(docs, apply(awkward(spark)))


def test_counts_under_a_free_name(spark):
    docs = extended(spark)
    for apply, name in ((line_dedup.remove_shared_runs, "removed"), (pii.replace_entities, "replaced")):
        kw = {"removed": name} if name == "removed" else {"replaced": name}
        with_extra = apply(docs, **kw).groupBy().sum(name).first()[0]
        assert with_extra == apply(awkward(spark), **kw).groupBy().sum(name).first()[0] > 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_pass_other_columns_through(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = extended(spark)
    out = stage(spark, docs, "")
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    assert own(out) == expected(docs, stage(spark, awkward(spark), ""))


def test_packing_beside_other_columns(spark):
    stage = dict(corpus_pipeline.STAGES)["packing"]
    docs = extended(spark)
    got, want = stage(spark, docs, ""), stage(spark, awkward(spark), "")
    pieces = lambda df: sorted(((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect()), key=str)
    total = lambda p: sum(x[2] for x in p)
    assert total(pieces(got)) == total(pieces(want)) and {x[0] for x in pieces(got)} == {x[0] for x in pieces(want)}


def test_ids_beside_other_columns(spark):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert rows(bpe.round_trip_digests(extended(spark), path)) == rows(bpe.round_trip_digests(awkward(spark), path))
