"""The registered queries: names, columns, and the SQL of those that have one."""

import duckdb
import pytest

import __spark_entry__ as contract
from farelens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_simhash": ["doc_id", "fingerprint", "component_id"],
    "op2_pivots": ["vec_id", "n_links", "component_id", "kept"],
    "op3_pitman_yor": [
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    ],
    "op4_mixing": ["doc_id"],
    "op5_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op6_token_counts": ["doc_id", "n_words", "n_tokens"],
    "op7_packing": [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    ],
    "op8_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op9_personal_data": [
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    ],
    "op10_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op12_token_alignment": [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    ],
    "op13_phrases": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op11_best_fit_packing": [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    ],
}


def test_every_query_is_registered():
    assert set(QUERIES) == set(COLUMNS)
    assert {*COLUMNS, "pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, name):
    found = QUERIES[name](spark, SF)
    wanted = COLUMNS[name]
    assert found.columns[: len(wanted)] == wanted
    table = "embeddings" if name in ("op2_pivots", "op8_neighbours") else "documents"
    rows, given = found.count(), spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name == "op8_neighbours":
        assert rows == 10 * -(-given // 100)
    elif name == "op13_phrases":
        assert rows > 0
    elif name in ("op7_packing", "op11_best_fit_packing"):
        assert rows >= given
    else:
        assert rows == given


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    sql = duckdb.connect()
    for table in ("documents", "embeddings"):
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = sql.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    found = QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(expected.fetchall())
