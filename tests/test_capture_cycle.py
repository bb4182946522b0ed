"""The capture cycle goes through all its steps: listing, new orders, detail pages, first write, inactive orders."""

import datetime

import pytest

from conftest import rows
from orderloom.operators import capture
from orderloom.plans import queries


@pytest.fixture
def folder(spark, tmp_path):
    """Tables of a few rows: an order that is stored, one whose page has items with missing parts."""
    day = datetime.datetime(2024, 1, 2)
    tables = {
        "nation": ("n_nationkey int, n_regionkey int", [(0, 1)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int", [(5, "five", 0)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                   "o_orderdate timestamp, o_orderpriority string",
                   [(k, 5, status, 12.5, day, "1-URGENT") for k, status in
                    ((1, "P"), (2, "F"), (3, "P"), (6, "F"), (10, "P"), (30, "P"))]),
        "lineitem": ("l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_shipdate timestamp, "
                     "l_extendedprice double, l_quantity double",
                     [(1, 1, 1, 7, day, 1.0, 1.0), (2, 1, 1, 7, day, 1.0, 1.0), (6, 1, 1, 7, day, 1.0, 1.0),
                      (3, 3, 1, 7, day, 3.0, 3.0), (3, 1, 1, 9, day, 5.0, 5.0), (3, 2, 1, 9, day, 2.0, 2.0),
                      (3, 4, 1, None, day, 1.0, 1.0), (3, 5, 1, 11, day, None, 1.0),
                      (3, 6, 1, 12, day, 1.0, None), (10, 1, 1, 8, day, 1.0, 1.0), (30, 1, 1, 8, day, 4.0, 4.0)])}
    for name, (schema, found) in tables.items():
        spark.createDataFrame(found, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_the_cycle_reads_pages_and_skips_items_with_missing_parts(spark, folder):
    got = queries.as_queries()["reconcile_snapshot"](spark, folder)
    assert rows(got) == [
        ("north", "10", "8", "$1.00", "1"), ("north", "30", "8", "$4.00", "4"), ("south", "1", "7", "$1.00", "1"),
        ("south", "3", "7", "$3.00", "3"), ("south", "3", "9", "$5.00", "5")]


def test_the_cycle_calls_its_operators(spark, folder, monkeypatch):
    steps, seen = ["dedupe_listing", "new_orders", "order_headers", "explode_items"], []
    for name in steps:
        monkeypatch.setattr(capture, name, lambda *a, _n=name, _r=getattr(capture, name): seen.append(_n) or _r(*a))
    queries.as_queries()["reconcile_snapshot"](spark, folder)
    assert seen == steps
