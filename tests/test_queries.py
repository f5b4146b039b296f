"""Every registered query against its SQL on the smallest data folder."""

import pytest

from quipu.plans import load
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
QUERIES = load()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    q = QUERIES[name]
    df = q(spark, FOLDER)
    if q.sql is None:
        assert df.count() > 0
    else:
        assert differences(df, con, q.sql) == []


def test_every_query_has_sql():
    assert [n for n, q in QUERIES.items() if q.sql is None] == []
