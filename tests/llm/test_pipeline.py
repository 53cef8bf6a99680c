"""The pipeline against a brute-force version of its stages."""

import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from emolens.llm import pii, rules
from emolens.llm.common import shared_folder
from tests.llm.data import awkward, awkward_rows, empty
from tests.llm.test_line_dedup import brute_runs
from tests.llm.test_ngram_join import brute as classes
from tests.llm.test_rules import brute as measures

W = re.compile(r"[^\x20\x09-\x0D]")


def stages(spark, docs):
    out = []
    for _, stage in corpus_pipeline.STAGES:
        path = shared_folder(spark, "test-stage")
        stage(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_every_stage_on_its_own_input(spark):
    docs = awkward(spark)
    ruled, cut, single, private, packed = stages(spark, docs)
    for df in (ruled, cut, single, private):
        assert df.columns == docs.columns and [f.dataType for f in df.schema] == [f.dataType for f in docs.schema]

    def keeps(t):
        m = measures(t)
        bad = lambda r: bool(eval(r.fails, {}, m))  # noqa: E731, S307 - the rules' own text
        return not any(bad(rules.BY_NAME[r]) for r in rules.POLICIES["v1"])

    assert texts(ruled) == sorted(((i, t) for i, t, *_ in awkward_rows() if keeps(t)), key=str)

    want = [(i, t) for i, t, _ in brute_runs([x for x in texts(ruled) if x[0] is not None]) if W.search(t)]
    assert [x for x in texts(cut) if x[0] is not None] == sorted(want, key=str)
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    rows = texts(cut)
    heads = {c for _, c, _ in classes(rows)}
    got = [i for i, _ in texts(single)]
    assert sorted(map(str, got)) == sorted(map(str, heads)) and set(texts(single)) <= set(rows)

    before, after = dict(texts(single)), dict(texts(private))
    assert before.keys() == after.keys()
    for i, t in before.items():
        found = pii.detect(t)
        assert [x[2] for x in pii.detect(after[i])] == [x[2] for x in found]
        assert all(e not in after[i] for *_, e in found) and (found or after[i] == t)

    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    n = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in after.items()}
    got = {}
    for r in packed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == n


def test_run_and_empty_table(spark, tmp_path):
    awkward(spark).write.parquet(f"{tmp_path}/a/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/a").agg({"length": "sum"}).first()[0] > 30_000
    empty(spark).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "surrogates", "packing"]
