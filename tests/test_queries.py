"""Every registered query against its SQL; those without SQL must return rows."""

import pytest

import __spark_entry__ as entry
from oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        assert difference(spark, con, FOLDER, QUERIES[name], ORACLES[name])[0] == ""
    else:
        assert QUERIES[name](spark, FOLDER).count() > 0
