"""Every registered query with oracle SQL matches DuckDB on the same parquet
(row count, column names, order-insensitive values) -- the driver's gate,
run here on sf0.001 so the suite stays quick.  Streaming keys included."""

import pytest

import __spark_entry__ as E
from logstream.plans.registry import all_queries, all_sql
from conftest import SF_SMALL
from oracle_harness import compare, duck

SQL = all_sql()
QUERIES = all_queries()


def test_every_sql_key_is_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, QUERIES[name], SQL[name], SF_SMALL)
    assert res["ok"], res


def test_rows_only_queries_run(spark):
    for name in sorted(set(QUERIES) - set(SQL)):     # none at present
        assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "url", "n", "rank"]
