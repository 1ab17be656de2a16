"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from verify import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert compare(df, connection, ORACLES[name]) == ""
    else:
        assert df.count() > 0
