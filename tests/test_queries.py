"""Every registered query against its SQL on the test tables."""

from __future__ import annotations

import pytest
from compare import database, spark_rows, sql_rows

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()
STREAMS = {
    "batch_preview",
    "per_batch_callback",
    "sgd_predictions",
    "sgd_stream_weights",
    "sgd_two_streams",
    "tumbling_append_stream",
    "user_holdout_stream",
    "user_state_changes",
    "user_state_custom",
    "user_state_from_history",
    "user_state_read",
    "user_state_snapshots",
    "user_state_stream",
}


@pytest.fixture(scope="module")
def sql(tables):
    return database(tables)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert STREAMS <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(name, spark, tables, sql):
    columns, rows = spark_rows(QUERIES[name](spark, tables))
    expected_columns, expected = sql_rows(sql, ORACLES[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_without_sql(name, spark, tables):
    assert QUERIES[name](spark, tables).count() > 0


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == [
        "window_start",
        "purchases",
        "unique_users",
        "revenue",
        "top_product",
        "top_count",
    ]
    assert result.count() == 30
