"""Every query that has SQL gives the SQL's rows; the others give rows of a stable schema."""

import pytest
from oracle import rows_of, rows_of_sql

from tidewatch.plans import lakehouse, learning, pipeline_data, relational, streams

QUERIES = pipeline_data.QUERIES | lakehouse.QUERIES | relational.QUERIES | learning.QUERIES | streams.QUERIES
SQL = pipeline_data.SQL | lakehouse.SQL | relational.SQL | streams.SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, larger, name):
    assert rows_of(QUERIES[name](spark, larger)) == rows_of_sql(SQL[name], larger)


@pytest.mark.parametrize("name", ["partition_balance", "semantic_ask", "export_campaigns", "export_watchlist"])
def test_rows_without_sql(spark, larger, name):
    assert QUERIES[name](spark, larger).count() > 0


def test_every_sql_has_a_query():
    assert SQL.keys() <= QUERIES.keys()
