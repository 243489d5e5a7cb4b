"""Every query that has SQL agrees with it."""

import pytest
from oracle import compare

from lattica import queries

#: Empty results agree with anything, so they are only expected here.
MAY_BE_EMPTY = {"severity_counts", "validation_report", "rule_threshold", "report_turtle", "shacl_message"}


def test_every_operator_has_sql():
    assert set(queries.QUERIES) == set(queries.ORACLES) and len(queries.QUERIES) == 63


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, name):
    assert compare(spark, sf, queries.QUERIES[name], queries.ORACLES[name]) or name in MAY_BE_EMPTY


@pytest.mark.parametrize("name", ["literal_escape", "nquad_format", "rule_threshold", "severity_counts", "validation_report", "report_turtle", "shacl_message"])
def test_query_on_more_rows(spark, name):
    """Quotes in texts and rows past the thresholds occur only here."""
    assert compare(spark, "/root/testdata/sf0.01", queries.QUERIES[name], queries.ORACLES[name])
