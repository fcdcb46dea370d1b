import pytest

from __spark_entry__ import entry
from tests.oracle import connect, difference
from tierlake.catalog import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def connection():
    from tests.conftest import TESTDATA

    return connect(f"{TESTDATA}/sf0.001")


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, connection, name):
    assert difference(QUERIES[name](spark, sf_dir), connection, ORACLE_SQL[name]) == []


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["event_type", "visitor", "event_count"]
    assert result.count() > 0
