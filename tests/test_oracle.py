"""Every registered query against its DuckDB oracle on the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from shoplens import registry
from tests.oracle_check import compare, duck_conn

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "cart_rate_pct" in df.columns


def test_every_query_has_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck_conn(SF).execute(entry.oracle_sql()[name])
    msgs = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert not msgs, msgs
