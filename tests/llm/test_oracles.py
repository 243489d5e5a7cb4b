"""Queries that SQL can express agree with it."""

import pytest
from oracle import compare

from lattica.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    assert compare(spark, "/root/testdata/sf0.01", queries.QUERIES[name], queries.ORACLES[name])
