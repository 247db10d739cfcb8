"""Every registered query with SQL gives the same rows in both engines."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_registry_is_consistent():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    without = set(registry.queries()) - set(registry.oracle_sql())
    assert all(name == "pipeline" or name.startswith("op") for name in without)


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, con, name):
    ok, note = compare(con, spark, SF, registry.queries()[name], registry.oracle_sql()[name])
    assert ok, note
