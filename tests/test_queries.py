"""Every registered query against its DuckDB statement at the smallest scale factor."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
from registry import base, compare

QUERIES, ORACLE = base.QUERIES, base.ORACLE


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    _, diff = compare.difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name])
    assert diff == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
