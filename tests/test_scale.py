"""Hot keys: a third of all rows under one key must be split, not gathered."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom.operators import credit, dashboard, erp, outbox, picking, routing, state
from orderloom.plans import jobs, queries
from orderloom.plans.bindings import Tables


@pytest.fixture
def skewed(t):
    """Items of which a third belong to the order ``77``."""
    hot = F.col("ord.l_linenumber") <= 2
    return t.items.withColumn("order_no", F.when(hot, "77").otherwise(F.col("order_no")))


def plan(df):
    return df._jdf.queryExecution().toString()


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_rows_are_cut_before_the_shuffle(t):
    for by_hash in (False, True):
        text = plan(picking.first_rows(t.items, ["order_no"], ["ord"], by_hash))
        assert re.search(r"row_number\(\), 1, Final(.|\n)*Exchange(.|\n)*row_number\(\), 1, Partial", text)


def test_first_rows_by_hash_are_the_same(skewed):
    a = picking.first_rows(skewed, ["order_no"], ["ord"]).select("order_no", "sku", "ord")
    b = picking.first_rows(skewed, ["order_no"], ["ord"], by_hash=True).select("order_no", "sku", "ord")
    assert rows(a) == rows(b)


def test_positions_are_a_gapless_global_order(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).repartition(5)
    placed = sorted(picking.positions(df, ["k", "v"]).collect(), key=lambda r: r.position)
    assert [r.position for r in placed] == list(range(1000))
    assert [(r.k, r.v) for r in placed] == sorted((r.k, r.v) for r in placed)


def test_grouped_orders_gather_nothing_and_run_nothing_early(spark, skewed):
    """The same rows for an order of any size, no aggregate of arrays, no job while planning."""
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    before = jobs()
    plans = [dashboard.orders_grouped(skewed), routing.order_messages(skewed),
             dashboard.flat_orders(skewed), outbox.sent_registry_lines(skewed)]
    assert jobs() == before
    for df in plans:
        assert "collect_list" not in plan(df)
    grouped = dashboard.orders_grouped(skewed)
    assert grouped.where("kind = 'item'").count() == skewed.count()
    assert (grouped.where("kind = 'order'").count()
            == skewed.select("order_no").distinct().count())


def test_sent_set_is_written_a_number_a_row(spark, tmp_path):
    from orderloom.sources.files import sent_registry
    sent = spark.range(1000).select(F.concat(F.col("id"), F.lit(",x")).alias("order_no"))
    outbox.write_sent_registry(sent, str(tmp_path / "sent"))
    assert spark.read.text(str(tmp_path / "sent")).count() == 1000
    assert rows(sent_registry(spark, str(tmp_path / "sent"), "fail")) == rows(sent)


@pytest.fixture
def split_small(spark):
    """Let Spark split skewed join partitions of test size; only rules are broadcast."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "2k",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def skew_of(df, *keys):
    """Whether the join on exactly these columns was split at run time."""
    # A subquery prints plans of its own, further to the right.
    text = final_plan(df).split("\n+- == Initial Plan ==")[0]
    wanted = "[" + ", ".join(keys) + "]"
    lines = [re.sub(r"#\d+L?", "", x) for x in text.splitlines() if "SortMergeJoin" in x]
    lines = [x for x in lines if wanted in x]
    assert lines, "no such join in the plan"
    return any("skew=true" in x for x in lines)


def many_items(spark, hot, field):
    """Item rows, of which two thirds share one document or order if ``hot``."""
    key = F.col("id")
    number = F.when((key % 3 > 0) & F.lit(hot), F.lit(4)).otherwise(key)
    values = {"order_no": key, "doc": key, field: number}
    return spark.range(0, 200_000, 1, 4).select(
        values["order_no"].cast("string").alias("order_no"),
        F.when(key % 2 == 0, "north").otherwise("outlet").alias("branch"),
        F.concat(F.lit("CNPJ: "), F.lpad(values["doc"].cast("string"), 14, "0")).alias("document"),
        F.lit("CD-0").alias("center"), F.lit("$1.00").alias("order_total"),
        F.lit("Dinheiro").alias("payment"), key.cast("string").alias("sku"),
        F.sha2(key.cast("string"), 256).alias("product_name"), F.struct("id").alias("ord"))


def many_clients(spark, hot):
    key = F.col("id")
    number = F.when((key % 3 > 0) & F.lit(hot), F.lit(4)).otherwise(key)
    return spark.range(0, 200_000, 1, 4).select(
        F.when(key >= 0, "erp-1").otherwise("erp-2").alias("source"),
        key.cast("string").alias("codcli"), F.lpad(number.cast("string"), 14, "0").alias("cgcent"),
        F.lit("N").alias("bloqueio"), F.sha2(key.cast("string"), 256).alias("limcred"))


@pytest.mark.parametrize("hot", [True, False])
def test_hot_document_is_split_in_the_customer_lookup(spark, t, split_small, hot):
    found = erp.codcli_lookup(many_items(spark, hot, "doc"), many_clients(spark, False),
                              queries.branch_sources(t))
    assert skew_of(found, "source", "doc_key") == hot


@pytest.mark.parametrize("hot", [True, False])
def test_document_shared_by_many_customers_is_split(spark, t, split_small, hot):
    known = erp.clients_per_branch(many_clients(spark, hot), queries.credit_sources(t))
    requests = credit.credit_requests(many_items(spark, False, "doc"), queries.centers(t))
    assert skew_of(credit.order_client_join(requests, known), "doc_key", "branch") == hot


@pytest.mark.parametrize("hot", [True, False])
def test_hot_order_is_split_when_inactive_orders_are_deleted(spark, t, split_small, hot):
    captured = t.rules([("north", True), ("outlet", True)], "branch string, complete boolean")
    active = many_items(spark, False, "doc").select("branch", "order_no")
    kept = state.delete_inactive(many_items(spark, hot, "order_no"), captured, active)
    assert skew_of(kept, "branch", "order_no") == hot


@pytest.mark.parametrize("hot", [True, False])
def test_hot_order_is_split_among_the_rows_of_a_capture(spark, split_small, monkeypatch, hot):
    monkeypatch.setattr(jobs, "_reconciled", lambda items, batch, *rest: batch)
    batch = many_items(spark, hot, "order_no")
    listing = many_items(spark, False, "doc").select("branch", "order_no", F.lit(1).alias("pos"))
    wanted = jobs.reconcile_rows(batch.where("sku = '-1'"), listing, batch, None)
    assert skew_of(wanted, "branch", "order_no") == hot


HEAVY = ["credit_gap", "credit_outbox", "orders_grouped", "route_orders", "reconcile_snapshot",
         "insert_ignore_items", "codcli_lookup", "registry_erp_match", "order_message",
         "company_backfill", "dashboard_columns", "flatten_company"]


@pytest.mark.parametrize("name", HEAVY)
def test_plans_stay_in_the_jvm_without_products(spark, name):
    text = plan(queries.as_queries()[name](spark, "/root/testdata/sf0.001"))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython",
                "MapInPandas", "BatchEvalPython"):
        assert bad not in text, bad


def test_scans_read_only_the_needed_columns(spark):
    text = plan(dashboard.order_stats(Tables(spark, "/root/testdata/sf0.001").items))
    assert "l_extendedprice" in text and "l_discount" not in text.split("== Physical Plan ==")[1]
