"""Every registered query against DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from millrace.catalog import ORACLES, QUERIES

from .compare import compare, connect
from .conftest import SF


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches(spark, duck, name):
    assert name in ORACLES, "no SQL to compare with"
    assert compare(QUERIES[name](spark, SF), duck, ORACLES[name]) == []


def test_entry_has_them_all():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0
