"""Registered queries: against their SQL where there is one, and their columns."""

import pytest

from strataflow.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_simhash": ["doc_id", "fingerprint", "component_id"],
    "op2_rules": [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior",
    ],
    "op3_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op4_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op5_mixing": ["doc_id", "source", "size", "source_size", "target", "taken"],
    "op6_line_templates": ["doc_id", "text", "n_lines", "n_dropped"],
    "op7_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op8_histogram_sort": [
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard",
    ],
    "op9_quality": ["doc_id", "held_out", "score", "predicted"],
    "op10_vectors": ["vec_id", "n_links", "component_id", "kept"],
    "op12_prefix_trie": [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    ],
    "op13_merkle": [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
    ],
    "op11_word_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, name, sf_dir):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = sql_rows(connect(sf_dir), ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    assert got.columns == COLUMNS[name]
    if name == "op12_prefix_trie":  # one row a node, counted in its own tests
        return
    source = "embeddings" if name == "op10_vectors" else "documents"
    assert got.count() == spark.read.parquet(f"{SF_DIR}/{source}.parquet").count()


def test_every_operator_is_registered():
    assert set(QUERIES) == {*COLUMNS, "pipeline"}
