"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from oracle_check import connect, difference
from storespark.testbed import oracle, registry

SF_DIR = "/root/testdata/sf0.001"
SQL = oracle.sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_registry_is_complete():
    assert set(registry.QUERIES) == set(SQL)
    assert set(registry.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(registry.QUERIES))
def test_query_equals_sql(spark, con, key):
    frame = registry.QUERIES[key](spark, SF_DIR)
    assert difference(frame, con, SQL[key]) is None


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()
