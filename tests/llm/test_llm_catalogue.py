"""Queries with SQL against DuckDB on the same tables."""

import pytest

from oracle_check import arranged, connect, same, sql_rows
from parlato.llm.catalogue import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert same(arranged(df.columns, [tuple(row) for row in df.collect()]), arranged(*sql_rows(con, ORACLE[name])))


def test_one_query_each():
    assert sorted(int(name.split("_")[0][2:]) for name in QUERIES) == list(range(1, 14))
