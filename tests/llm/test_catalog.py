import pytest

from __spark_entry__ import oracle_sql, queries
from tests.oracle import connect, difference
from tierlake.llm.catalog import ORACLE_SQL, QUERIES

ROWS = {"op3_text_to_tag": "pages", "op13_warc_ranges": "pages"}


@pytest.fixture(scope="module")
def connection():
    from tests.conftest import TESTDATA

    return connect(f"{TESTDATA}/sf0.001")


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert QUERIES.items() <= queries().items() and "pipeline" in queries()
    assert ORACLE_SQL.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, connection, name):
    result = QUERIES[name](spark, sf_dir)
    if name in ORACLE_SQL:
        assert difference(result, connection, ORACLE_SQL[name]) == []
    elif name != "op5_best_two_fit":  # pieces; its own tests count them
        table = ROWS.get(name, "documents")
        assert result.count() == connection.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
