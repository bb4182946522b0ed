"""Every registered query against its SQL twin on the smallest data."""

import pytest

import check_all
from conftest import DATA
from orderloom.plans import oracle, queries

QUERIES, SQL = queries.as_queries(), oracle.statements()


@pytest.fixture(scope="module")
def con():
    return check_all.connect(DATA)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_a_wrong_result_is_noticed(spark, con):
    assert check_all.compare(QUERIES["order_stats"](spark, DATA), con, SQL["order_stats_us"])
    assert check_all.compare(QUERIES["credit_gap"](spark, DATA), con, SQL["credit_gap_all_orders"])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert check_all.compare(QUERIES[name](spark, DATA), con, SQL[name]) is None
