"""The corpus pipeline: documents -> packed training sequences.

Five stages, each one operator of `emolens.llm` at its production parameters.
A stage gets the rows that its predecessor kept, as a table reread from the
shared folder, and returns the columns of documents (the last one: pieces of
sequences).

1. ``quality_rules``: documents that the rule policy rejects go;
2. ``line_dedup``: later places of repeated passages of lines are cut from the
   texts; a document of which nothing is left goes;
3. ``near_duplicates``: one document of each 5-word Jaccard class (0.8) stays;
4. ``surrogates``: personal data and secrets get surrogates;
5. ``packing``: texts become sequences of 4096 tokens along a Hilbert curve.

Nulls: a null text counts as empty and fails the rules; null ids, languages
and sources pass through.  Further columns, whatever their names, pass through
stages 1 to 4.  An empty table gives no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emolens.llm import line_dedup, ngram_join, packing, pii, rules
from emolens.llm.common import SPACES, free_name, written

VOCABULARY = "word_bpe_49k.json"


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a change of the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.passing(docs, "v1")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = free_name(docs.columns, "cut")
    out = line_dedup.remove_shared_runs(docs, removed=cut)
    emptied = (F.col(cut) > 0) & (F.btrim("text", F.lit(SPACES)) == "")
    return _recounted(out.where(~F.coalesce(emptied, F.lit(False))).drop(cut))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_per_class(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(pii.replace_entities(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(VOCABULARY), checksums=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("surrogates", surrogates),
    ("packing", packed),
]

#: Keyed surrogates and the tokeniser are not expressible in SQL; the tests
#: hold `run` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
