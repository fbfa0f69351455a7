"""Every registered query against its DuckDB SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
# The queries of this library's own operators; others bring tests of their own.
QUERIES = {name: q for area in entry._AREAS for name, q in area.QUERIES.items()}
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_check_sql():
    assert set(QUERIES) <= set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, FOLDER, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["page_id", "title", "url", "content"]
    assert rows.count() > 0
