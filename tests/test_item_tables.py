"""The item tables: joins carry values, texts are made above them, no row is shuffled again to be picked."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom.plans.bindings import Tables, dotted


@pytest.fixture
def made(spark, tmp_path):
    """Tables of a few rows: nulls, a product twice in an order, rows that come twice; joins shuffle."""
    day = datetime.datetime(2024, 1, 2)
    tables = {
        "nation": ("n_nationkey int, n_regionkey int", [(0, 1)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double",
                     [(5, "five", 0, 1.0), (42, None, 0, None), (6, "no nation", None, 1.0)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                   "o_orderdate timestamp, o_orderpriority string",
                   [(1, 5, "P", 12.5, day, "1-URGENT"), (2, 42, "F", None, day, None),
                    (3, 5, "P", 3.0, day, "2-HIGH"), (4, 6, "P", 4.0, day, "2-HIGH"),
                    (None, 5, "P", 1.0, day, "2-HIGH"), (10, 5, None, 1234567.0, None, "5")]),
        "lineitem": ("l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_shipdate timestamp, "
                     "l_extendedprice double, l_quantity double",
                     [(1, 3, 1, 7, day, 3.0, 3.0), (1, 2, 1, 7, day, 2.0, 2.0), (1, 2, 1, 7, day, 2.0, 2.0),
                      (1, 4, 1, None, day, 4.0, 4.0), (1, 1, 1, None, None, None, None),
                      (2, None, 1, 8, day, 1.0, 1.0), (2, 1, 1, 8, day, 5.0, 5.0),
                      (3, 1, 1, 9, day, 1.0, 1.0), (4, 1, 1, 9, day, 1.0, 1.0),
                      (None, 1, 1, 9, day, 1.0, 1.0), (10, 1, 1, 50, day, 10.0, 10.0)])}
    for name, (schema, found) in tables.items():
        spark.createDataFrame(found, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Tables(spark, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_shuffle_values_and_no_texts(made):
    plan = physical(made.items.select("business_id", "product_name", "price", "phone_1"))
    above, below = plan.split("Exchange", 1)
    for made_text in ("neg-", "Produto ", "+55(21)9", "$"):
        assert made_text in above and made_text not in below


def test_items_of_made_orders(made):
    got = made.items.select("order_no", "sku", "price", "quantity", "trade_name", "payment", "order_total")
    assert rows(got.where("order_no in ('2', '10')")) == [
        ("10", "50", "$10.00", "0", "five", "Cartão de Crédito na Entrega (Somente em 1x)", "$1,234,567.00"),
        ("2", "8", "$1.00", "1", None, None, None), ("2", "8", "$5.00", "5", None, None, None)]
    assert made.items.count() == 9


def test_pages_are_gathered_where_the_join_has_their_lines(made):
    plan = physical(made.detail_capture.select("order_no", "items"))
    assert plan.index("SortMergeJoin") < plan.index("Exchange")


def test_pages_hold_all_lines_in_order(made):
    got = made.detail_capture.select("branch", "order_no", "items.sku", "items.quantity", "status")
    assert rows(got) == [
        ("south", "1", [None, "7", "7", "7", None], [None, "2", "2", "3", "4"], " A ser preparado"),
        ("south", "3", ["9"], ["1"], " A ser preparado")]


def test_stored_items_are_picked_where_the_join_has_them(made):
    plan = physical(made.stored_items.select("order_no", "sku", "price"))
    assert plan.index("SortMergeJoin") < plan.index("Exchange")


def test_stored_items_are_the_first_per_order_and_product(made):
    assert rows(made.stored_items.select("order_no", "sku", "quantity", "ord.l_linenumber")) == [
        ("1", "", "", 1), ("1", "7", "2", 2), ("10", "50", "0", 1), ("2", "8", "1", None)]
    assert set(made.stored_items.columns) == set(made.items.columns)


def test_item_texts_are_compiled(spark, made):
    """The virtual machine only interprets methods of 8,000 bytes or more."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = made.items._jdf.queryExecution()
        text = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_dotted_numbers(spark):
    cases = spark.createDataFrame([(12345678000195,), (42,), (-5,), (None,), (123456789012345,)], "n long")
    assert [r[0] for r in cases.select(dotted(F.col("n"))).collect()] == [
        "12.345.678/0001-95", "00.000.000/0000-42", "00.000.000/0000--5", None, "12.345.678/9012-34"]
