"""The registered queries: against their SQL, and their shape on the given tables."""

import pytest

import __spark_entry__ as entry_points
from comparing import difference

from quotemill.llm import oracles, queries

COLUMNS = {
    "op1_mix_sources": ["doc_id", "size", "source_size", "target", "taken"],
    "op2_exact_top_k": ["query_id", "rank", "vec_id", "score"],
    "op3_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op4_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op5_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op6_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op7_nearest": ["query_id", "rank", "vec_id", "score"],
    "op8_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op9_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op10_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op11_align_tokens": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op12_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13_personal_data": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
}


def test_all_are_registered():
    assert list(COLUMNS) == list(queries.QUERIES) and {*COLUMNS, "pipeline"} <= set(entry_points.queries())
    assert set(oracles.ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_equals_its_sql(name, spark, given, duck):
    assert difference(queries.QUERIES[name](spark, given), duck, oracles.ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in COLUMNS if n not in oracles.ORACLES])
def test_has_its_columns_and_all_rows(name, spark, given):
    got = queries.QUERIES[name](spark, given)
    assert got.columns == COLUMNS[name]
    docs = spark.read.parquet(f"{given}/documents.parquet").count()
    vectors = spark.read.parquet(f"{given}/embeddings.parquet")
    of_vectors = {"op7_nearest": 10 * vectors.where("vec_id % 100 = 0").count(), "op12_whitening": 8 * vectors.count()}
    assert got.count() == of_vectors.get(name, docs)
