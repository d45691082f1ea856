"""Registered queries against their SQL over whole tables, and what their contracts fix."""

import os

import duckdb
import pytest

from chainloom.llm import registry

DATA = os.environ.get("LLM_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def plain(value):
    return round(value, 4) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    frame = registry.QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    expected = connection.sql(f"SELECT {', '.join(columns)} FROM ({registry.ORACLES[name]})").fetchall()
    got = frame.select(*columns).collect()
    assert sorted((tuple(map(plain, r)) for r in got), key=str) == sorted((tuple(map(plain, r)) for r in expected), key=str)


CONTRACT = {
    "op1_warc_members": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op2_minimax_shards": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op3_ngram_trie": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op4_lsh_forest": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7_page_diff": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op11_cross_parse": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op10_concat_and_cut": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
}


CONTRACT_12 = {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"}
CONTRACT_13 = {"part": "string", "filter_order": "string", "step": "int", **dict.fromkeys(["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"], "bigint")}


def test_columns_of_reports(spark):
    for name, columns in (("op12_collocations", CONTRACT_12), ("op13_filter_audit", CONTRACT_13)):
        assert {c: t for c, t in registry.QUERIES[name](spark, DATA).dtypes if c in columns} == columns


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_rows(spark, name):
    frame = registry.QUERIES[name](spark, DATA)
    assert {c: t for c, t in frame.dtypes if c in CONTRACT[name]} == CONTRACT[name]
    table = "pages" if "page_id" in CONTRACT[name] else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    everything = {r[0] for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in frame.select(key).distinct().collect()} == everything
