"""Every registered query with SQL gives the same rows as DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck_connection
from checks.registry import REGISTRY

SF = "/root/testdata/sf0.001"
entry.queries()  # fills the registry
NAMES = [name for name, (_, sql) in REGISTRY.items() if sql]


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, SF, entry.queries()[name], entry.oracle_sql().get(name), con)
    assert ok, note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "region" in df.columns


def test_every_query_is_named_for_what_it_computes():
    assert set(entry.oracle_sql()) <= set(entry.queries())
