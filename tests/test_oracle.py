"""Every registered query against its DuckDB twin on sf0.001 (the driver
checks sf0.01 the same way)."""
import pytest

import __spark_entry__ as E
from conftest import SF0001
from oracle_check import compare

QUERIES = E.queries()
SQL = E.oracle_sql()


def test_every_query_of_the_core_has_a_twin():
    rows_only = set(QUERIES) - set(SQL)
    training = {q for q in rows_only if q == "pipeline" or q.startswith("op")}  # tested in tests/llm
    assert rows_only == training
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, duck, name):
    msg, ok = compare(spark, name, QUERIES[name], SQL[name], SF0001, duck, verbose=True)
    assert ok, msg


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["store_region", "product_category", "total_revenue", "order_count"]
    assert df.count() > 0
