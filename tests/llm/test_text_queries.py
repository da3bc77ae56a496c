"""The registered queries: their columns, and their SQL where there is one."""

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as contract
from tabprep.llm.queries import ORACLE, QUERIES

COLUMNS = {
    "op1_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op2_simhash": ["doc_id", "fingerprint", "component_id"],
    "op3_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op4_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op5_language": ["doc_id", "held_out", "lang_pred", "score", "rejected"],
    "op6_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op7_token_file": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_token_counts": ["doc_id", "n_tokens", "n_words"],
    "op10_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op11_conversation_trie": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op12_divergence": ["lang", "source", "part", "item", "value", "rank"],
    "op13_quality": ["doc_id", "held_out", "score", "predicted"],
}
#: Queries whose rows aren't the documents.
OTHER_ROWS = {"op6_packing", "op11_conversation_trie", "op12_divergence"}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and {*QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, sf, corpus, name):
    frame = QUERIES[name](spark, sf)
    assert frame.columns == COLUMNS[name]
    if name not in OTHER_ROWS:
        assert frame.count() == corpus.count()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_its_sql(spark, sf, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/sf0.001/{table}.parquet'")
    cursor = connection.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]

    def ordered(rows):
        return sorted(map(tuple, rows), key=lambda r: [(v is not None, v) for v in r])

    got = ordered(QUERIES[name](spark, sf).select(*names).collect())
    assert got and got == ordered(cursor.fetchall())
    if name == "op4_decontamination":
        assert any(r[names.index("n_hit")] for r in got)
