"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from cloudcost import registry
from harness import compare, duck

SF = "/root/testdata/sf0.001"
# the queries of the training-data operators are compared in tests/llm
KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) and set(KEYS) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "parent_category" in df.columns
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    ok, msg = compare(spark, con, key, SF, E.queries()[key], E.oracle_sql()[key])
    assert ok, msg
