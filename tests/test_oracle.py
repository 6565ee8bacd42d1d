"""Every catalog query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, oracle

FOLDER = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert compare(df, con, SQL[name]) == []
    else:
        assert df.count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
