"""Registered queries on the given tables: against their SQL, and all at once on columns."""

import os

import pytest
from oracle import spark_rows, sql_rows

from feedworks.llm.oracles import ORACLE_SQL
from feedworks.llm.queries import QUERIES

SF_DIR = os.environ.get("FEEDWORKS_SF_DIR", "/root/testdata/sf0.001")

COLUMNS = {
    "op2_window_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op6_page_language": ["page_id", "lang", "probability", "text_lang", "declared", "host"],
    "op7_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op8_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op10_personal_data": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op11_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op12_simhash_near_duplicates": ["doc_id", "fingerprint", "component_id"],
}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(ORACLE_SQL[name], SF_DIR)
    assert columns == expected_columns
    assert len(rows) == len(expected) > 0
    assert rows == expected


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    assert found.columns == COLUMNS[name]
    table = "pages" if name == "op6_page_language" else "documents"
    count = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    assert found.count() == count if name != "op2_window_packing" else found.count() >= count


def test_every_query_is_covered():
    assert ORACLE_SQL.keys() | COLUMNS.keys() == QUERIES.keys()
