"""Registered queries: SQL where there is any, else shape and whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
WITH_SQL = ["op3_warc_round_trip", "op5_top_k_search", "op10_quality_rules", "op11_chat_format", "op12_spelling_variants",
            "op13_merkle_manifest"]


def test_all_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {k.split("_")[0] for k in names} and "pipeline" in names
    assert set(WITH_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", WITH_SQL)
def test_same_rows_as_sql(spark, name):
    got = entry.queries()[name](spark, SF)
    db = duckdb.connect()
    for f in os.listdir(SF):
        db.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    want = db.sql(entry.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = lambda r: sorted(map(str, r))
    assert rows(tuple(x) for x in got.select(*cols).collect()) == rows(want.select(", ".join(cols)).fetchall())


@pytest.mark.parametrize(("name", "rows"), [("op2_main_text", "pages"), ("op4_line_chunk_dedup", "documents"), ("op8_surrogates", "documents")])
def test_one_row_per_input_row(spark, name, rows):
    assert entry.queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/{rows}.parquet").count()
