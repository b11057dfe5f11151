import os

import pytest
from oracle import spark_rows, sql_rows

from __spark_entry__ import entry, oracle_sql, queries
from feedworks.plans.oracles import ORACLE_SQL
from feedworks.plans.queries import QUERIES

SF_DIR = os.environ.get("FEEDWORKS_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= queries().keys()
    assert oracle_sql().keys() <= queries().keys()


def test_entry(spark):
    assert len(entry(spark).columns) == 24


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(ORACLE_SQL[name], SF_DIR)
    assert columns == expected_columns
    assert len(rows) == len(expected) > 0
    assert rows == expected
