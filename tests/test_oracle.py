"""Every SQL-checkable registered query equals its DuckDB oracle (row count,
column names, order-insensitive values rounded to 6 places)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duck

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_a_callable():
    assert set(SQL) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"community", "n_posts", "n_positive", "positive_ratio"} <= set(df.columns)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, E.queries()[name], SQL[name], con)
    assert r["status"] == "ok", r
