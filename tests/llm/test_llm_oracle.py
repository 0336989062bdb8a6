"""Registered queries against their SQL twins, where SQL can express them."""

import pytest

import __spark_entry__ as entry
from oracle_check import connect, difference
from storespark.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_all_queries_are_offered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_equals_sql(spark, key):
    con = connect(SF_DIR)
    for name in ("embeddings", "conversations"):
        con.execute(f"create or replace view {name} as select * from '{SF_DIR}/{name}.parquet'")
    assert difference(queries.QUERIES[key](spark, SF_DIR), con, queries.ORACLE[key]) is None
