"""The queries that SQL can express, over whole tables."""

import pytest

from corpusloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_same_as_sql(same_as_sql, name, folder):
    assert same_as_sql(queries.QUERIES[name], queries.ORACLES[name], folder)
