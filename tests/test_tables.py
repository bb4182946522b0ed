"""Kept tables: buckets, grams, ranges, rule tables and totals by deltas equal the plain operators."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom.operators import bucketed, dashboard, paging, routing, search, state
from orderloom.plans import jobs
from orderloom.streaming import jobs as streams, views


def above(plan, mark):
    """The operators above each line of a plan that has a mark, nearest first."""
    lines, out = plan.split("\n"), []
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    for i, line in enumerate(lines):
        if mark in line:
            path, now = [], depth(line)
            for up in reversed(lines[:i]):
                if depth(up) < now:
                    path.append(up.strip(" :+-"))
                    now = depth(up)
            out.append(path)
    return out


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def without_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_items_are_joined_where_they_lie(spark, t, without_broadcasts):
    items = bucketed.store(t.stored_items, "items_in_place", buckets=5)
    for df in (bucketed.delete_inactive(items, t.captured, t.listing),
               items.join(bucketed._in_every_slot(t.listing.select("order_no").distinct()),
                          bucketed.PLACE, "left_semi")):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("\n+- == Initial Plan")[0]
        paths = above(plan, "items_in_place")
        assert paths and "Bucketed: true" in plan and "SortMergeJoin" in plan
        assert not [p for path in paths for p in path if "Exchange" in p], plan


def test_bucketed_cycle_equals_the_plain_one(spark, t):
    batch = t.order_items.where("o_orderstatus = 'P'").drop("o_orderkey", "o_orderstatus")
    items = bucketed.store(t.stored_items, "items_cycle_0", buckets=4)
    shown = ["branch", "order_no", "sku", "price"]
    want = jobs.reconcile_rows(t.stored_items, t.listing, batch, t.captured)
    got = bucketed.reconcile_rows(items, t.listing, batch, t.captured, "items_cycle_1", buckets=4)
    assert rows(got.select(*shown)) == rows(want.select(*shown))
    # The next cycle works on what the last one wrote.
    part = t.listing.where("order_no < '3'")
    again = jobs.reconcile_rows(want, part, batch, t.captured)
    got = bucketed.reconcile_rows(got, part, batch, t.captured, "items_cycle_2", buckets=4)
    assert rows(got.select(*shown)) == rows(again.select(*shown))


def test_a_very_large_order_lies_in_several_buckets(spark, t):
    big = t.items.limit(1).select("branch", F.lit("1").alias("order_no"), "ord").crossJoin(
        spark.range(2000).select(F.col("id").cast("string").alias("sku")))
    stored = bucketed.store(big, "items_large", buckets=16)
    sizes = [r[1] for r in rows(stored.groupBy("_slot").count())]
    assert len(sizes) == bucketed.SLOTS and max(sizes) < 2 * 2000 / bucketed.SLOTS
    assert bucketed.fresh_items(stored, big.withColumn("sku", F.concat("sku", F.lit("x")))).count() == 2000
    assert bucketed.fresh_items(stored, big).count() == 0


def test_null_keys_and_branches_behave_as_in_the_plain_form(spark):
    stored = spark.createDataFrame(
        [("north", "1", "a"), ("north", None, "a"), (None, "1", "a"), ("south", "2", None), ("east", "3", "c")],
        "branch string, order_no string, sku string")
    captured = spark.createDataFrame([("north", True), ("south", True), ("east", False)],
                                     "branch string, complete boolean")
    active = spark.createDataFrame([("south", "2"), ("south", "1"), ("north", None), (None, "1")],
                                   "branch string, order_no string")
    kept = bucketed.store(stored, "items_nulls", buckets=2)
    got = bucketed.delete_inactive(kept, captured, active).drop("_slot")
    assert rows(got) == rows(state.delete_inactive(stored, captured, active))


PATTERNS = [("regional", "PARATY"), ("regional", "a"), ("interior", "ITA"), ("interior", None), ("other", "")]


def test_pattern_table_equals_the_expressions(spark):
    rng = random.Random(5)
    cities = [None, "", "Paraty", "paraty - rj", "ITAITA", "x", *("".join(
        rng.choices("AITRPY j", k=rng.randint(0, 9))) for _ in range(300))]
    items = spark.createDataFrame(
        [(str(i), i, c, rng.choice(["CPF 1", "CNPJ", None])) for i, c in enumerate(cities)],
        "order_no string, ord int, city_uf string, document string")
    sent = spark.createDataFrame([("3",)], "order_no string")
    table = spark.createDataFrame(PATTERNS, "list string, pattern string")
    by_list = {k: [p for n, p in PATTERNS if n == k and p is not None] for k in ("regional", "interior")}
    got = routing.route_orders_by_rules(items, sent, table)
    assert rows(got) == rows(routing.route_orders(items, sent, by_list["regional"], by_list["interior"]))
    nothing = routing.route_orders_by_rules(items, sent, table.where("false"))
    assert rows(nothing) == rows(routing.route_orders(items, sent, [], []))


def test_ten_thousand_patterns_need_no_nested_loop(spark, t):
    rng = random.Random(2)
    many = [("interior", "".join(rng.choices("ABCDEFGH", k=rng.randint(3, 12)))) for _ in range(10_000)]
    many += [("regional", "ANGRA"), ("interior", "PETR")]
    got = routing.route_orders_by_rules(t.items, t.queue, spark.createDataFrame(many, "list string, pattern string"))
    plan = final_plan(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = routing.route_orders(t.items, t.queue, ["ANGRA"], sorted({p for k, p in many if k == "interior"})[:0]
                                + ["PETR"])
    cities = {r[0] for r in t.headers.select(F.upper("city_uf")).distinct().collect()}
    assert not [p for k, p in many[:-2] if any(p in c for c in cities if c)]
    assert rows(got) == rows(want)


@pytest.fixture(scope="module")
def heads(spark, t):
    return dashboard.order_list(t.items).where("cast(order_no as int) % 7 < 3").cache()


@pytest.mark.parametrize("needle", ["c", "cp", "CPF", " cpf: 0 ", "cnpj: 00000", "resp 1", "zzz", "", "  ", "é",
                                    "customer#00000001", "cd-1", "%", "_"])
def test_indexed_search_equals_the_scan(spark, heads, tmp_path_factory, needle, _index=[]):  # noqa: B006
    if not _index:
        _index.append(str(tmp_path_factory.mktemp("grams")))
        search.write_index(heads, _index[0], parts=8)
    for branch in ("", "north"):
        got = search.search_indexed(heads, _index[0], needle, branch, parts=8)
        assert rows(got.select("order_no")) == rows(
            dashboard.search_orders(heads, needle, branch).select("order_no"))


def test_grams_are_not_shuffled_and_orders_of_several_rows_are_found(spark, heads, tmp_path):
    plan = search.grams(heads.limit(5).localCheckpoint())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    some = heads.where("cast(order_no as int) < 200")
    twice = some.unionByName(some).unionByName(some.withColumn("document", F.lit("CPF: 77")))
    search.write_index(twice, str(tmp_path), parts=4)
    for needle in ("cpf", "77", "cpf: 77", "customer"):
        assert rows(search.search_indexed(twice, str(tmp_path), needle, parts=4)) == rows(
            dashboard.search_orders(twice, needle))


def test_a_search_opens_only_partitions_of_its_grams(spark, heads, tmp_path):
    search.write_index(heads, str(tmp_path), parts=32)
    found = search.candidates(spark, str(tmp_path), "cnpj: 0000", parts=32)
    files = {f.split("part=")[1].split("/")[0] for f in found.inputFiles()}
    assert "PartitionFilters: [" in final_plan(found) and len(files) <= 32
    assert found.count() < heads.count()


@pytest.mark.parametrize("page", [1, 2, 7, 10**6, 0])
def test_stored_pages_equal_the_sorted_ones(spark, heads, tmp_path, page):
    some = heads.select("order_no", "trade_name")
    paging.write_ranges(some, str(tmp_path))
    want = dashboard.paginate(some, page)
    got = paging.page_of(spark, str(tmp_path), some.schema, page)
    assert rows(got.select(*want.columns)) == rows(want) and got.count() > 0


def test_a_stored_page_reads_one_or_two_ranges(spark, tmp_path):
    many = spark.range(5000).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("order_no"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paging.write_ranges(many.repartition(4), str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    starts = [r["rows"] for r in spark.read.parquet(f"{tmp_path}/ranges").orderBy("_range").collect()]
    assert len(starts) == 4 and sum(starts) == 5000
    edge = starts[0] // 20 + 1
    for page in (1, edge, edge + 1, 250):
        got = paging.page_of(spark, str(tmp_path), many.schema, page)
        assert [r[0] for r in rows(got.select("order_no"))] == [f"{i:05}" for i in range(20 * page - 20, 20 * page)]
        plan = final_plan(got)
        read = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "_range" in read and plan.count("_range") and read.count(",") <= 3


def test_pages_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "order_no string")
    paging.write_ranges(none, str(tmp_path))
    assert paging.page_of(spark, str(tmp_path), none.schema, 1).collect() == []
    assert dashboard.paginate(none, 1).collect() == [] == dashboard.paginate(none, 99).collect()


def test_early_pages_are_not_sorted_as_a_whole(spark, heads):
    early = final_plan(dashboard.paginate(heads, 3))
    assert "TakeOrderedAndProject" in early and "rangepartitioning" not in early
    some = heads.select("order_no", "branch")
    for page in (dashboard.EARLY_PAGES, dashboard.EARLY_PAGES + 1):
        got = dashboard.paginate(some, page, size=2)
        want = sorted(r[0] for r in rows(some.select("order_no")))[2 * page - 2:2 * page]
        assert sorted(r.order_no for r in got.collect()) == want


def test_totals_by_deltas_equal_the_batch(spark, tmp_path):
    rng, table, each = random.Random(7), {}, views.totals_batches(str(tmp_path))
    schema = "order_no string, branch string, collected_at timestamp, value decimal(18,2)"
    frame = lambda d: spark.sql("select * from values ('x', 'x', 0L, 0D) as t(order_no, branch, s, v)").where(
        "false") if not d else spark.createDataFrame(
            [(k, *v) for k, v in d.items()], "order_no string, branch string, s long, v double")
    shaped = lambda d: frame(d).select(
        "order_no", "branch", F.timestamp_seconds("s").alias("collected_at"),
        F.col("v").cast("decimal(18,2)").alias("value"))
    before = {}
    for n in range(7):
        table = dict(before)
        for _ in range(12):
            k = str(rng.randint(0, 20))
            if rng.random() < 0.4:
                table.pop(k, None)
            else:
                table[k] = (rng.choice("AB") if n < 5 else "A", rng.randint(1, 10**6), rng.randint(0, 9) / 4)
        if n == 6:
            table = {k: v for k, v in table.items() if v[0] != "B"}
        changes = views.signed_changes(shaped(before), shaped(table))
        each(changes, n)
        each(changes, n)  # a batch that is run again
        before = table
        want = streams.order_stats_stream(shaped(table))
        assert rows(views.totals(spark, str(tmp_path)).select("branch", "orders", F.col("value").cast("double"),
                                                              "last_update")) == rows(
            want.select("branch", "orders", F.col("value").cast("double"), "last_update"))
    assert schema and not rows(views.signed_changes(shaped(table), shaped(table)))
