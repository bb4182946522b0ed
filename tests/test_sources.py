"""File readers, on files the tests write."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom.schemas import REGISTRY_LABELS
from orderloom.session import new_folder, settle, shared_folder
from orderloom.sources import captures, files, tables


def test_order_csvs_nested_bom_long_and_short_lines(spark, tmp_path):
    deep = tmp_path / "a" / "b"
    deep.mkdir(parents=True)
    (tmp_path / "Pedidos_A_Preparar_1.csv").write_text(
        "﻿Numero Pedido,SKU,Preço\n1,10,\"$1,234.56\"\n2,20\n3,30,$1,surplus\n4,40,$2\n",
        encoding="utf-8")
    (deep / "Pedidos_A_Preparar_2.csv").write_text("SKU,Numero Pedido,CEP\n50,5,123\n")
    (deep / "Outro.csv").write_text("Numero Pedido,SKU\n6,60\n")
    got = files.order_csvs(spark, str(tmp_path)).select("Numero Pedido", "SKU", "Preço", "CEP")
    assert rows(got) == [("1", "10", "$1,234.56", None), ("2", "20", None, None),
                         ("4", "40", "$2", None), ("5", "50", None, "123")]
    assert got.count() == 4
    assert files.order_csvs(spark, str(tmp_path), name_glob="none*.csv").count() == 0
    same = files.order_csvs(spark, str(tmp_path), ["Numero Pedido", "SKU", "Preço"], "*_1.csv")
    assert rows(same) == [("1", "10", "$1,234.56"), ("2", "20", None), ("4", "40", "$2")]


def test_registry_csv_is_all_text(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("CNPJ,Nome,Nome Fantasia\n00012,Ação,\n")
    got = files.registry_csv(spark, str(path))
    assert rows(got) == [("00012", "Ação", None)]


def test_registry_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Nome,CNPJ\nAcme,123\n")
    (tmp_path / "b.csv").write_text("Extra,CNPJ,Nome\n,456,CNPJ\n")
    got = files.registry_csv(spark, str(tmp_path)).select("CNPJ", "Nome")
    assert rows(got) == [("123", "Acme"), ("456", "CNPJ")]


def test_a_label_as_a_value_is_no_header(spark, tmp_path):
    path = tmp_path / "Pedidos_A_Preparar_1.csv"
    path.write_text("Numero Pedido,SKU\n1,a\n2,Numero Pedido\nNumero Pedido,c\n")
    assert rows(files.order_csvs(spark, str(tmp_path))) == [
        ("1", "a"), ("2", "Numero Pedido"), ("Numero Pedido", "c")]
    (tmp_path / "Pedidos_A_Preparar_2.csv").write_text("SKU,Outro\n1,2\n")
    with pytest.raises(ValueError, match="Numero Pedido"):
        files.order_csvs(spark, str(tmp_path))


@pytest.mark.parametrize("content, expected", [
    ('["1", "2", "2"]', ["1", "2"]),
    ('[\n  "1",\n  "2"\n]', ["1", "2"]),
    ('["a\\"b"]', ['a"b']), ('["a,b", "c"]', ["a,b", "c"]), ('["[x]", ","]', [",", "[x]"]),
    ('["x"]\n["y","z"]\n', ["x", "y", "z"]),
    ('["a\\\\"]', ["a\\"]), ('["\\"", "\\\\\\"x", "\\u00e9"]', ['"', '\\"x', "é"]), ('[""]', [""]),
    ('[] ["x"]', ["x"]), ('[]\n[]', []), ('["a" "b"]', []), ('["a",,"b"]', []), ('["a",]', []), ('[,"a"]', []),
    ('"a"', []), ('["a"],["b"]', []), ('[["a"]]', []), ('["a', []), ('["a"]]', []), ('["a\nb"]', []),
    ('["a\\x"]', []), ('["a"] x', []), ('{"a"}', []), (" ", []), ('["a"]["b"', []),
    ("[]", []), ("", []), ('["1", 2]', []), ('["1", "2"', []), ("{}", []),
])
def test_sent_registry(spark, tmp_path, content, expected):
    path = tmp_path / "sent.json"
    path.write_text(content)
    assert sorted(r[0] for r in files.sent_registry(spark, str(path)).collect()) == expected


def test_one_long_line_is_read_by_several_tasks(spark, tmp_path):
    want = [f'{i},"]\\{"x" * (i % 9)}' for i in range(3000)]
    (tmp_path / "sent.json").write_text(json.dumps(want))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        pieces = files._quoted(spark, str(tmp_path / "sent.json"))
        assert pieces.select("place.block").distinct().count() > 10
        got = files.sent_registry(spark, str(tmp_path), on_corrupt="fail")
        assert sorted(r[0] for r in got.collect()) == sorted(want)
        (tmp_path / "sent.json").write_text(json.dumps(want)[:-1])
        assert files.sent_registry(spark, str(tmp_path)).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_header_names_with_commas_and_quotes(spark, tmp_path):
    (tmp_path / "r.csv").write_text('"Razao, Social",CNPJ,"No""me"\n"Acme, Ltda",123,Acme\n')
    got = files.registry_csv(spark, str(tmp_path))
    assert rows(got.select("Razao, Social", "CNPJ", 'No"me')) == [("Acme, Ltda", "123", "Acme")]


def test_a_source_whose_query_fails_is_left_out(spark):
    one = spark.createDataFrame([("1",)], "codcli string")
    failing = one.select(F.raise_error(F.lit("no such view")).cast("string").alias("codcli"))
    with pytest.raises(Exception, match="no such view"):
        tables.multi_source_union({"n": one, "x": failing}).collect()
    assert rows(tables.multi_source_union({"n": one, "x": failing}, skip_failed=True)) == [("1", "n")]


def test_missing_and_corrupt_sent_registry(spark, tmp_path):
    assert files.sent_registry(spark, str(tmp_path / "none.json")).count() == 0
    bad = tmp_path / "bad.json"
    bad.write_text("[1]")
    with pytest.raises(ValueError):
        files.sent_registry(spark, str(bad), on_corrupt="fail")


def test_ledger_document(spark, tmp_path):
    doc = {"A": {"ultima_saudacao": "2024-01-02", "horario": "10:00:00",
                 "clientes": {"2024-01-01": ["1", "2"], "2024-01-02": ["3"]}},
           "B": {"ultima_saudacao": "", "clientes": {}}}
    (tmp_path / "ledger.json").write_text(json.dumps(doc, indent=2))
    docs = files.ledger_documents(spark, str(tmp_path / "ledger.json"), whole_files=True)
    got = files.explode_ledger(docs).select("branch", "codcli", F.col("sent_day").cast("string"), "sent_time")
    assert rows(got) == [("A", "1", "2024-01-01", "10:00:00"), ("A", "2", "2024-01-01", "10:00:00"),
                         ("A", "3", "2024-01-02", "10:00:00")]


def test_listing_rows_skip_short_ones_and_trim(spark):
    df = spark.createDataFrame([("n", 1, [" 7 ", "a", "b", "c", "\t$1"]), ("n", 2, ["8", "a"])],
                               "branch string, pos int, cells array<string>")
    assert rows(captures.listing_rows(df)) == [("n", 1, "7", "a", "b", "c", "$1")]


def test_multi_source_union(spark):
    one = spark.createDataFrame([("1",)], "codcli string")

    def failing():
        return spark.read.parquet("/nowhere/at/all")
    ok = tables.multi_source_union({"n": one, "w": None, "s": lambda: one})
    assert rows(ok) == [("1", "n"), ("1", "s")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.multi_source_union({"n": one, "x": failing})
    assert rows(tables.multi_source_union({"n": one, "x": failing}, skip_failed=True)) == [("1", "n")]


def test_receivables_sum_counts_open_ones_only(spark):
    df = spark.createDataFrame([("1", "1.50", None), ("1", "2.00", "0"), ("1", "9.00", "5"), ("2", "1", "1")],
                               "codcli string, valor string, vpago string")
    assert [(c, str(v)) for c, v in rows(tables.receivables_sum(df))] == [("1", "3.50")]


def test_upper_case_source_columns_come_back_lower(spark):
    df = spark.createDataFrame([(1, "x")], "CODCLI int, CGCENT string")
    assert tables.as_text(df, "codcli", "CGCENT").columns == ["codcli", "cgcent"]


class FakeSession:
    """A session with the given master and checkpoint folder."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.sql.warehouse.dir": "file:/w"}
        if folder is not None:
            self.conf["spark.checkpoint.dir"] = folder
        self.sparkContext = self
        self.master, self.applicationId = master, "app"

    def getCheckpointDir(self):
        return None


def test_shared_folder_is_the_one_the_cluster_names(monkeypatch):
    assert shared_folder(FakeSession("yarn", "hdfs:///work/")) == "hdfs:///work"
    with pytest.raises(RuntimeError):
        shared_folder(FakeSession("yarn"))
    assert shared_folder(FakeSession("local[2]")) == "file:/w/_scratch"


def test_a_new_folder_lies_in_the_shared_one(spark):
    assert new_folder(spark, "x").startswith(shared_folder(spark) + "/x/")


def test_settled_rows_are_read_back(spark):
    assert rows(settle(spark.range(3).toDF("v"), "kept")) == [(0,), (1,), (2,)]
