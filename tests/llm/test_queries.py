import re

import duckdb
import pytest

import __spark_entry__ as entry
from repolens.llm.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    want = con.sql(SQL[name])
    names = sorted(want.columns)
    got = QUERIES[name](spark, DIR).select(*names)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.select(*names).fetchall(), key=str)


@pytest.mark.parametrize("name,columns", [
    ("op1_simhash", "doc_id fingerprint component_id"), ("op3_toxicity", "doc_id held_out score predicted"),
    ("op4_chat", "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars"), ("op5_pii", "doc_id text n_entities kinds"),
    ("op7_mixing", "doc_id size source_size target taken"), ("op8_bpe", "doc_id n_tokens ids_sha256 decoded_sha256"),
    ("op9_html", "page_id url text n_chars"), ("op10_suffix", "doc_id n_bytes n_removed n_spans kept_sha256"),
    ("op11_language", "doc_id held_out lang_pred score")])
def test_contract_columns_and_rows(spark, name, columns):
    out = QUERIES[name](spark, DIR)
    assert out.columns == columns.split()
    table = {"op4_chat": "conversations", "op9_html": "pages"}.get(name, "documents")
    key = out.columns[0]
    rows = spark.read.parquet(f"{DIR}/{table}.parquet").select(key).distinct().count() + (name == "op4_chat")
    ids = [r[0] for r in out.select(key).collect()]
    assert len(ids) == len(set(ids)) == rows


@pytest.mark.parametrize("name", ["op3_toxicity", "op11_language"])
def test_null_ids_are_not_held_out(spark, tmp_path, name):
    rows = [(i, f"some plain words {i}", "en") for i in range(20)] + [(None, "no id at all", "en"), (None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES[name](spark, str(tmp_path)).collect()
    assert len(got) == 22 and all(r.held_out is not None for r in got) and not any(r.held_out for r in got if r.doc_id is None)
