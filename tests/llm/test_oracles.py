"""Registered queries against their SQL, and the contract's column names."""

import pytest

from conftest import SMALL
from oracle_check import compare, connect
from plantlens.llm.catalog import ORACLES, QUERIES

COLUMNS = {
    1: {"doc_id", "held_out", "score", "predicted"},
    2: {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    3: {"doc_id", "held_out", "score", "predicted"},
    4: {"doc_id", "text", "n_dropped"},
    5: {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    6: {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    7: {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    8: {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    9: {"doc_id", "n_shingles", "component_id"},
    10: {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"},
    11: {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
    12: {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
}
#: Rows a row of the table: a row for each component; pieces are counted in test_numbers.
TABLES = {11: ("embeddings", 4), 12: ("documents", None)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_row_a_document(spark, name):
    df, number = QUERIES[name](spark, SMALL), int(name[2:].split("_")[0])
    table, times = TABLES.get(number, ("documents", 1))
    assert set(df.columns) >= COLUMNS[number]
    assert times is None or df.count() == times * spark.read.parquet(f"{SMALL}/{table}.parquet").count()
