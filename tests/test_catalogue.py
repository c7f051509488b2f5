"""Every query of the library against its SQL on the same tables."""

import pytest

import __spark_entry__ as entry
from oracle_check import arranged, connect, same, sql_rows
from parlato.catalogue import QUERIES
from parlato.oracle import ORACLE

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    mine = arranged(df.columns, [tuple(row) for row in df.collect()])
    assert same(mine, arranged(*sql_rows(con, ORACLE[name])))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
