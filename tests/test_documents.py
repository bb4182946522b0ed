"""Order documents parse to the header fields and the items of each order; counted runs."""

import json
from collections import defaultdict

from pyspark.sql import functions as F

from conftest import rows
from orderloom.operators import dashboard, documents


def parsed(folder):
    out, decoder = [], json.JSONDecoder()
    for path in sorted(folder.glob("part-*")):
        text = path.read_text()
        at = 0
        while at < len(text):
            doc, at = decoder.raw_decode(text, at)
            out.append(doc)
            while at < len(text) and text[at].isspace():
                at += 1
    return out


def test_compressed_documents_are_small_and_read_the_same(spark, t, tmp_path):
    items = t.items.where("cast(order_no as int) < 300")
    sizes, found = [], []
    for kind in ("none", "gzip"):
        folder = tmp_path / kind
        documents.write_documents(items, str(folder), compression=kind)
        sizes.append(sum(f.stat().st_size for f in folder.glob("part-*")))
        found.append(rows(documents.read_documents(spark, str(folder))))
    assert found[0] == found[1] and 3 * sizes[1] < sizes[0]


def test_documents_have_all_fields_and_items_in_order(spark, t, tmp_path):
    odd = spark.createDataFrame([("q\"uo]}te\n", 1, None), ("q\"uo]}te\n", 0, "]}\n")],
                                "order_no string, n int, sku string")
    items = (t.items.where("cast(order_no as int) < 300").withColumn("ord", F.col("ord.l_linenumber"))
             .unionByName(odd.select("order_no", F.col("n").alias("ord"), "sku"), allowMissingColumns=True))
    documents.write_documents(items, str(tmp_path / "docs"))
    got = parsed(tmp_path / "docs")
    want = defaultdict(list)
    for r in items.collect():
        want[r.order_no].append(r.asDict())
    assert sorted(d["Numero Pedido"] for d in got) == sorted(want)
    for doc in got:
        own = sorted(want[doc["Numero Pedido"]], key=lambda r: r["ord"])
        assert list(doc) == [*documents.HEADER_KEYS, "itens"] and len(doc) == 23
        assert {k: doc[k] for k in documents.HEADER_KEYS} == {k: own[0][c] for k, c in documents.HEADER_KEYS.items()}
        assert [list(i.values()) for i in doc["itens"]] == [[r[c] for c in documents.ITEM_KEYS.values()] for r in own]
    back = documents.read_documents(spark, str(tmp_path / "docs"))
    assert rows(back.select("order.Numero Pedido", F.size("order.itens"))) == sorted(
        ((k, len(v)) for k, v in want.items()), key=repr)


def test_documents_come_from_one_shuffle_and_gather_nothing(t):
    df = documents.document_lines(t.items)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan")[0]
    assert "collect_list" not in plan
    lines = plan[:plan.index("Window")] if "Window" in plan else ""
    assert "Window" in plan and "Exchange" not in lines


def test_no_items_make_no_documents(spark, t, tmp_path):
    documents.write_documents(t.items.where("false"), str(tmp_path / "none"))
    assert parsed(tmp_path / "none") == [] == documents.read_documents(spark, str(tmp_path / "none")).collect()


def test_counts_of_a_run_compute_each_stage_once(spark):
    ran = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b

    first = spark.range(100).repartition(3).mapInArrow(counted, "id long")
    got = dashboard.run_counts({"first": first, "none": spark.range(0), "odd": spark.range(10).where("id % 2 = 1"),
                                "distinct": spark.range(20).select((F.col("id") % 4).alias("k")).distinct()})
    assert rows(got) == [("distinct", 4), ("first", 100), ("none", 0), ("odd", 5)]
    assert ran.value == 100
