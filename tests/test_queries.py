"""Every registered query against its DuckDB twin."""

import pytest
from compare import compare, connect

from __spark_entry__ import _QUERIES, oracle_sql, queries


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_twins_cover_the_queries():
    """Every query of the engine has a twin, and no twin is without its query."""
    assert set(oracle_sql()) <= set(queries())
    assert {q.__name__ for q in _QUERIES} <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, con, sf, name):
    assert compare(spark, con, name, sf) is None
