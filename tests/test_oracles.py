"""Every query that SQL can express, over whole tables; the others run and have rows."""

import pytest

import corpusloom.plans  # noqa: F401
from corpusloom.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_as_sql(same_as_sql, name):
    assert same_as_sql(registry.QUERIES[name], registry.ORACLES[name], "/root/testdata/sf0.001") > 0


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
