"""Operators on small literal tables: the edge rows of each rule."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom import rules
from orderloom.operators import (credit, dashboard, erp, ledger, outbox, picking, registry,
                                 routing, shaping, state)
from orderloom.plans import jobs
from orderloom.schemas import HEADER_FIELDS, ITEM_FIELDS, LEDGER_SCHEMA, REGISTRY_LABELS

ITEM_COLUMNS = ["ord", "order_no", *HEADER_FIELDS, "coordinates", *ITEM_FIELDS]
SCHEMA = ", ".join(f"{c} {'int' if c == 'ord' else 'string'}" for c in ITEM_COLUMNS)


def items(spark, *given):
    """Item rows from dictionaries; unnamed fields are null, ``ord`` counts up."""
    table = [tuple({"ord": i, "branch": "north", **g}.get(c) for c in ITEM_COLUMNS)
             for i, g in enumerate(given)]
    return spark.createDataFrame(table, SCHEMA)


def table(spark, schema, *given):
    return spark.createDataFrame(list(given), schema)


# --------------------------------------------------------------- picking

def test_first_row_keeps_nulls_and_null_keys_form_a_group(spark):
    df = table(spark, "k string, v string, o int", ("a", None, 1), ("a", "x", 2), (None, "n2", 5),
               (None, "n1", 3))
    assert rows(picking.first_rows(df, ["k"], ["o"]).select("k", "v")) == [("a", None), (None, "n1")]


def test_first_filled_value_skips_nulls(spark):
    df = table(spark, "v string, o int", (None, 1), ("x", 2), ("y", 3))
    assert df.agg(picking.first_filled_value("v", "o")).first()[0] == "x"


# ---------------------------------------------------------------- state

def test_insert_ignore_keeps_the_stored_and_the_first_row(spark):
    stored = items(spark, {"order_no": "1", "sku": "a", "price": "old"})
    batch = items(spark, {"order_no": "1", "sku": "a", "price": "new", "branch": "south"},
                  {"order_no": "2", "sku": "b", "price": "first"},
                  {"order_no": "2", "sku": "b", "price": "second"},
                  {"order_no": None, "sku": "c", "price": None})
    new = state.insert_ignore_items(stored, batch)
    got = rows(new.select("branch", "order_no", "sku", "price"))
    assert got == [("north", "", "c", ""), ("north", "1", "a", "old"), ("north", "2", "b", "first")]
    assert rows(state.insert_ignore_items(new, batch)) == rows(new)


def test_stored_values_are_text_and_never_nan(spark):
    df = table(spark, "order_no string, price double", ("1", float("nan")), ("2", None), ("3", 1.5))
    assert rows(state.as_stored(df)) == [("1", ""), ("2", ""), ("3", "1.5")]


def registry_table(spark, *given):
    names = [*REGISTRY_LABELS.values()]
    schema = ", ".join(f"{n} string" for n in names) + ", consultado_em timestamp"
    then = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(*[g.get(n) for n in names], then) for g in given], schema)


def test_upsert_overwrites_supplied_columns_only(spark):
    old = registry_table(spark, {"cnpj": "1", "nome": "a", "status": "Ativa", "cidade": "x"},
                         {"cnpj": "2", "nome": "b"})
    batch = table(spark, "cnpj string, nome string, status string, seq int", ("1", "A", None, 1),
                  ("3", "old", "Ativa", 1), ("3", "new", "Ativa", 2), (None, "n", "Ativa", 1),
                  ("", "n", "Ativa", 1))
    now = F.lit("2024-02-02").cast("timestamp")
    new = state.upsert_company(old, batch, now, order=["seq"])
    got = rows(new.select("cnpj", "nome", "status", "cidade", F.to_date("consultado_em").cast("string")))
    assert got == [("1", "A", None, "x", "2024-01-01"), ("2", "b", None, None, "2024-01-01"),
                   ("3", "new", "Ativa", None, "2024-02-02")]
    assert new.columns == old.columns


@pytest.mark.parametrize("captured, active, left", [
    ([("north", True)], [("north", "1")], ["1", "3"]),
    ([("north", True)], [], ["3"]),
    ([("north", False)], [], ["1", "2", "3"]),
    ([], [("north", "1")], ["1", "2", "3"]),
    ([("north", True), ("south", True)], [("north", "3")], []),
])
def test_inactive_orders_of_captured_branches_go(spark, captured, active, left):
    have = items(spark, {"order_no": "1"}, {"order_no": "2"}, {"order_no": "3", "branch": "south"})
    got = state.delete_inactive(have, table(spark, "branch string, complete boolean", *captured),
                                table(spark, "branch string, order_no string", *active))
    assert [r[0] for r in rows(got.select("order_no"))] == left


def test_codes_orders_and_queue(spark):
    have = items(spark, {"order_no": "1", "sku": "a"}, {"order_no": "1", "sku": "b", "codcli": "7"},
                 {"order_no": "2", "codcli": "9"})
    codes = table(spark, "order_no string, codcli int", ("1", 5), ("1", 4))  # in two branches
    assert rows(state.update_codcli(have, codes).select("order_no", "codcli")) == [
        ("1", "5"), ("1", "5"), ("2", "9")]
    assert rows(state.delete_orders(have, codes).select("order_no")) == [("2",)]
    queue = table(spark, "order_no string, sent_at timestamp", ("1", datetime.datetime(2024, 1, 1)))
    more = table(spark, "order_no string, sent_at timestamp", (" 1", datetime.datetime(2024, 1, 3)),
                 ("2 ", datetime.datetime(2024, 1, 5)), ("2", datetime.datetime(2024, 1, 4)))
    marked = state.mark_dispatched(queue, more)
    assert rows(marked.select("order_no", F.dayofmonth("sent_at"))) == [("1", 1), ("2", 4)]
    assert rows(state.drain_queue(marked, codes).select("order_no")) == [("2",)]


# ---------------------------------------------------------------- ledger

def stamped(spark, *given):
    return table(spark, "branch string, codcli string, ts timestamp",
                 *[(b, c, datetime.datetime.fromisoformat(ts)) for b, c, ts in given])


def test_ledger_greeting_is_refreshed_and_notice_is_not(spark):
    empty = spark.createDataFrame([], LEDGER_SCHEMA)
    one = ledger.upsert_greetings(empty, stamped(spark, ("A", None, "2024-01-01 08:00:00")))
    two = ledger.upsert_greetings(one, stamped(spark, ("A", None, "2024-01-01 09:00:00")))
    assert rows(two.select("codcli", "sent_time")) == [(rules.GREETING_CODE, "09:00:00")]
    notices = stamped(spark, ("A", "5", "2024-01-01 10:00:00"), ("A", "5", "2024-01-01 09:30:00"),
                      ("A", "5", "2024-01-02 00:00:00"))
    three = ledger.insert_clients(two, notices)
    four = ledger.insert_clients(three, stamped(spark, ("A", "5", "2024-01-01 07:00:00")))
    assert rows(four.where("codcli = '5'").select("sent_time")) == [("00:00:00",), ("09:30:00",)]
    days = table(spark, "branch string, day date", ("A", datetime.date(2024, 1, 1)),
                 ("A", datetime.date(2024, 1, 2)), ("B", datetime.date(2024, 1, 1)))
    assert rows(ledger.greeted(days, four).select("branch", F.dayofmonth("day"))) == [("A", 1)]


# ---------------------------------------------------------------- credit

CENTERS = ("center string, branch string", ("X", "A"), ("Y", "B"))
SOURCES = ("branch string, source string", ("A", "s"), ("B", "s2"), ("C", None))
CLIENTS = "source string, codcli string, cliente string, cgcent string, bloqueio string, limcred string"
DEBTS = "source string, codcli string, valor string, vpago string"


def gap(spark, given, clients, debts=(), **options):
    rows_ = items(spark, *[{"center": "X", "payment": "Dinheiro", **g} for g in given])
    df = credit.credit_gap(rows_, table(spark, CLIENTS, *[("s", c, "n", d, b, lim) for c, d, b, lim in clients]),
                           table(spark, DEBTS, *[("s", *d) for d in debts]),
                           table(spark, *CENTERS), table(spark, *SOURCES),
                           payments=rules.PAYMENT_CODES, **options)
    return [(c, str(total), p, b) for c, total, p, b in rows(df)]


def test_credit_is_short_only_below_the_total_or_when_blocked(spark):
    orders = [{"order_no": str(i), "order_total": "$10.00", "document": f"CNPJ: {i}"} for i in range(1, 6)]
    clients = [("1", "1", "N", "10.00"), ("2", "2", "N", "9.99"), ("3", "3", "S", "99"),
               ("4", "4", "N", None), ("5", "5", None, "20.00")]
    got = gap(spark, orders, clients, [("5", "5.00", None), ("5", "5.01", "0"), ("5", "99.00", "1")])
    assert got == [("2", "10.00", "D", "A"), ("3", "10.00", "D", "A"), ("4", "10.00", "D", "A"),
                   ("5", "10.00", "D", "A")]


def test_credit_takes_the_first_order_of_a_document(spark):
    orders = [{"order_no": "2", "order_total": "$50.00", "document": "CNPJ: 1"},
              {"order_no": "1", "order_total": "$20.00", "document": "CNPJ:1 ", "payment": None},
              {"order_no": "1", "order_total": "$20.00", "document": "CNPJ: 1", "payment": "Boleto"}]
    clients = [("7", "1", "N", "0")]
    assert gap(spark, orders, clients) == [("7", "20.00", None, "A")]
    assert gap(spark, orders, clients, grain="order") == [("7", "70.00", "D", "A")]


def test_credit_edge_rows(spark):
    orders = [{"order_no": "1", "order_total": "", "document": "CNPJ: 1"},
              {"order_no": "2", "order_total": "$5.00", "document": "CNPJ"},
              {"order_no": "3", "order_total": "$5.00", "document": None},
              {"order_no": "4", "order_total": "$5.00", "document": "CNPJ: "},
              {"order_no": "5", "order_total": "$5.00", "document": "CNPJ: 5", "center": "Z"},
              {"order_no": "6", "order_total": "$5.00", "document": "CNPJ: 6"}]
    clients = [("1", "1", "N", "-1"), ("2", "", "S", "0"), ("3", None, "S", "0"), ("5", "5", "S", "0"),
               ("6", "6", "N", "0"), ("66", "0-6", "S", "0"), ("666", "6", "S", "9")]
    assert gap(spark, orders, clients) == [("1", "0.00", "D", "A"), ("6", "5.00", "D", "A"),
                                           ("666", "5.00", "D", "A")]
    assert gap(spark, [], clients) == []


def outbox_rows(spark, gaps, done=(), contacts=(("A", "t", "Ana"), ("B", None, "x"))):
    day = datetime.date(2024, 1, 10)
    led = spark.createDataFrame([(b, c, day, "08:00:00", day if c == rules.GREETING_CODE else None)
                                 for b, c in done], LEDGER_SCHEMA)
    df = credit.credit_outbox(
        table(spark, "codcli string, total decimal(28,2), payment string, branch string", *gaps),
        table(spark, "branch string, target string, name string", *contacts), led,
        F.lit("2024-01-10 13:00:00").cast("timestamp"))
    return [(r.seq, r.kind, r.codcli, r.text) for r in df.orderBy("seq", "codcli").collect()]


def test_credit_outbox_messages(spark):
    from decimal import Decimal
    gaps = [("2", Decimal("10.5"), "D", "A"), ("10", Decimal("1234"), "QR", "A"), ("3", Decimal(1), "D", "B")]
    got = outbox_rows(spark, gaps)
    assert [g[:3] for g in got] == [(0, "greeting", None), (1, "request", "10"), (1, "request", "2"),
                                    (2, "closing", None)]
    assert got[0][3] == "Boa tarde, Ana! Seguem os clientes para solicitação de limite:"
    assert got[1][3] == ("👤 *Cod Cliente:* 10\n💰 *Valor do Pedido:* R$ 1234.00\n"
                         "💳 *Forma de Pagamento:* QR\n")
    assert got[3][3] == "Poderia liberar o limite para esses clientes, por favor? Obrigado!"


def test_credit_outbox_sends_once_a_day(spark):
    from decimal import Decimal
    gaps = [("2", Decimal(1), "D", "A"), ("3", Decimal(1), "D", "A")]
    hailed = ("A", rules.GREETING_CODE)
    kinds = lambda done: [g[1] for g in outbox_rows(spark, gaps, done)]
    assert kinds([hailed, ("A", "2")]) == ["request", "closing"]
    assert kinds([hailed, ("A", "2"), ("A", "3")]) == []
    assert kinds([("A", "2"), ("A", "3")]) == ["greeting"]
    assert outbox_rows(spark, [], []) == []


# --------------------------------------------------------------- routing

def routes(spark, given, sent=()):
    df = routing.route_orders(items(spark, *given), table(spark, "order_no string", *[(s,) for s in sent]),
                              rules.REGIONAL_CITIES, rules.INTERIOR_CITIES)
    return dict(rows(df))


def test_routes(spark):
    given = [{"order_no": "1", "city_uf": " paraty, rj"}, {"order_no": "2", "city_uf": "Niterói, RJ", "document": "cpf: 1"},
             {"order_no": "3", "city_uf": "Niterói, RJ", "document": "CNPJ: 1"}, {"order_no": "4", "city_uf": None},
             {"order_no": "5", "city_uf": "Areal, RJ", "document": "CPF: 1"}, {"order_no": None, "city_uf": "PARATY"},
             {"order_no": "6", "city_uf": "Lídice, RJ"}, {"order_no": "7", "city_uf": "Vitória, ES", "document": "CPF: 1"},
             {"order_no": "8", "city_uf": "Niterói"}, {"order_no": "8", "city_uf": "PARATY"}]
    assert routes(spark, given) == {"1": "regional", "2": "general", "3": None, "4": None, "5": None,
                                    "6": "regional", "7": None, "8": None}
    assert "1" not in routes(spark, given, [" 1 "])


def test_probe_has_its_own_city_list(spark):
    empty = table(spark, "order_no string")
    one = items(spark, {"order_no": "1", "city_uf": "ARROZAL"})
    assert routing.any_eligible(one, empty, rules.REGIONAL_PROBE_CITIES, rules.INTERIOR_CITIES).first()[0] is True
    assert routes(spark, [{"order_no": "1", "city_uf": "ARROZAL"}]) == {"1": None}
    assert routing.any_eligible(items(spark), empty, rules.REGIONAL_PROBE_CITIES,
                                rules.INTERIOR_CITIES).first()[0] is False


def test_message_text(spark):
    head = {"order_no": "9", "responsible": "R", "document": "CPF: 1", "trade_name": "Bar", "payment": "Pix",
            "order_total": "$3.00", "street": "Rua 1", "city_uf": " Niterói, rj ", "zip": "1", "delivery_date": "d",
            "phone_1": "+55(21)1-2.0", "phone_2": "", "email_1": None}
    df = items(spark, {**head, "product_name": "A", "price": "$10.00", "quantity": "3"},
               {"order_no": "9", "product_name": "B", "price": "$1,000.50", "quantity": "0"},
               {"order_no": "9", "product_name": "C", "price": "x", "quantity": "x"})
    got = routing.order_messages(df.withColumn("contact_3", F.lit("Zé")))
    text = "".join(r.text for r in got.orderBy(F.col("kind") == "line", "ord").collect())
    assert text == (
        "*Número Pedido*: *9*\n*Responsavel*: R\n*Documento*: CPF: 1\n*Estabelecimento*: Bar\n"
        "*Telefone 1*: 2112\n*Contato 3*: Zé\n*Forma de Pagamento*: Pix\n*Total Pedido*: $3.00\n"
        "*Endereço de Entrega*: Rua 1\n*Cidade/UF*: NITERÓI, RJ\n*CEP*: 1\n*Data Entrega*: d\n"
        "*Produto*: A | Quantidade: 3 | Preço Unitário: R$3.33\n"
        "*Produto*: B | Quantidade: 0 | Preço Total: R$1000.50 (Quantidade zero)\n"
        "*Produto*: C | Quantidade: 0 | Preço Total: R$0.00 (Quantidade zero)\n")


def test_routed_outbox_and_queue(spark):
    df = items(spark, {"order_no": "1", "city_uf": "PARATY"}, {"order_no": "2", "city_uf": "Niterói"})
    queue = table(spark, "order_no string, sent_at timestamp")
    now = F.lit("2024-01-10 20:00:00").cast("timestamp")
    sent = routing.routed_outbox(df, queue, "t", now, rules.REGIONAL_CITIES, rules.INTERIOR_CITIES)
    assert [(r.kind, r.order_no) for r in sent.orderBy("seq").collect()] == [
        ("greeting", None), ("order", "1"), ("line", "1")]
    assert sent.orderBy("seq").first().text == "Boa noite! Pedidos sendo enviados!"
    after = routing.queue_routed(queue, sent, now)
    assert rows(after.select("order_no")) == [("1",)]
    assert routing.routed_outbox(df, after, "t", now, rules.REGIONAL_CITIES,
                                 rules.INTERIOR_CITIES).count() == 0
    assert rows(outbox.outbox(sent).select("target", "key", "seq")) == [
        ("t", "1", 1), ("t", "1", 2), ("t", None, 0)]
    assert rows(routing.sent_after(after, table(spark, "order_no string", (" 1",), ("0",)))) == [("0",), ("1",)]


# -------------------------------------------------------------- registry

FULL = {"taxId": "1", "alias": None, "founded": "f", "statusDate": "s", "company": {
    "name": "N", "equity": 10000000.00, "nature": {"text": "LTDA"}, "size": {"text": "ME"},
    "simples": {"optant": True}, "simei": {"optant": False}}, "status": {"text": "Ativa"},
    "reason": {"text": None}, "address": {"street": "R", "number": "1", "details": "d", "district": "b",
                                          "city": "c", "state": "RJ", "zip": "z"},
    "phones": [{"area": "21", "number": "1"}, {"area": "11", "number": "2"}],
    "emails": [{"address": "a"}, {"address": "b"}], "mainActivity": {"text": "M"},
    "sideActivities": [{"text": "x"}, {"text": "y"}],
    "registrations": [{"state": "RJ", "number": "9", "status": {"text": "ok"}, "type": {"text": "t"},
                       "statusDate": "d"}, {"state": "SP"}]}


def test_company_record_is_flattened(spark):
    docs = table(spark, "doc string", (json.dumps(FULL),), ('{"taxId":"2"}',), ("no json",), ("[1]",),
                 ('{"taxId":"3","company":null,"address":null,"phones":null,"registrations":[{}]}',))
    got = {r.cnpj: r.asDict() for r in registry.flatten_company(docs).collect()}
    assert set(got) == {"1", "2", "3"}
    assert list(got["1"].values()) and got["1"] == {
        "cnpj": "1", "nome": "N", "nome_fantasia": None, "capital_social": "10000000.00",
        "natureza_juridica": "LTDA", "tamanho": "ME", "data_fundacao": "f", "status": "Ativa",
        "data_status": "s", "razao_status": None, "rua": "R", "numero": "1", "complemento": "d",
        "bairro": "b", "cidade": "c", "uf": "RJ", "cep": "z", "telefone": "(21) 1, (11) 2",
        "email": "a, b", "atividade_principal": "M", "atividades_secundarias": "x, y",
        "simples_optante": "True", "simei_optante": "False", "ie_estado": "RJ", "ie_numero": "9",
        "ie_status": "ok", "ie_tipo": "t", "ie_data_status": "d"}
    missing = {"nome": None, "nome_fantasia": "Não disponível", "capital_social": None,
               "natureza_juridica": "N/D", "status": None, "rua": "Não disponível", "telefone": "N/D",
               "email": "N/D", "atividades_secundarias": "Nenhuma", "simples_optante": "N/D",
               "ie_estado": "Não encontrada", "ie_status": "Não encontrada"}
    for cnpj in ("2", "3"):
        assert {k: got[cnpj][k] for k in missing} == missing
    assert set(registry.flatten_company(docs).columns) == set(REGISTRY_LABELS.values())


def test_company_problem_is_three_valued(spark):
    df = table(spark, "cnpj string, status string, ie_status string", ("1", "Ativa", "Sem restrição"),
               ("2", "Baixada", None), ("3", None, "Sem restrição"), ("4", None, "Outra"),
               ("5", "Ativa", None), ("6", "Ativa", "Não encontrada"))
    assert [r[0] for r in rows(registry.company_problems(df))] == ["2", "4"]


def test_unknown_and_pending_companies(spark):
    df = items(spark, {"order_no": "1", "account_id": "12.345.678/0001-90"},
               {"order_no": "2", "account_id": "12345678000191"}, {"order_no": "3", "account_id": "1234567890a123"},
               {"order_no": "4", "account_id": None}, {"order_no": "2", "account_id": "99999999999999"})
    reg = table(spark, "cnpj string, status string, ie_status string", ("12345678000190", "Baixada", None),
                ("12345678000191", "Baixada", None))
    assert rows(registry.unknown_companies(df, reg)) == [("99999999999999",)]
    assert rows(registry.fiscal_pending_orders(df, reg).select("order_no")) == [("2",)]
    assert rows(registry.fiscal_pending_orders(df, reg, clean_key=True).select("order_no")) == [("1",), ("2",)]


def test_backfill_stores_the_requested_number(spark):
    df = items(spark, {"order_no": "1", "account_id": "12345678000191"})
    answers = table(spark, "asked string, doc string", ("12345678000191", '{"taxId":"other","company":{"name":"N"}}'),
                    ("12345678000191", "<html>503</html>"), ("5", '{"taxId":"5"}'))
    new = jobs.company_backfill(df, registry_table(spark), answers, F.lit("2024-02-02").cast("timestamp"))
    assert rows(new.select("cnpj", "nome")) == [("12345678000191", "N")]


# -------------------------------------------------------------------- ERP

def test_codcli_lookup_takes_the_largest_code_and_no_blank_key(spark):
    df = items(spark, {"order_no": "1", "document": "CNPJ: 1-0"}, {"order_no": "2", "document": ""},
               {"order_no": "3", "document": None}, {"order_no": "4", "document": "CNPJ: 4", "branch": "west"},
               {"order_no": "1", "document": "CNPJ: 99"})
    clients = table(spark, CLIENTS, ("s", "9", "n", "10", "N", "0"), ("s", "20", "n", "1.0", "N", "0"),
                    ("s", "5", "n", "", "N", "0"), ("s", "4", "n", "4", "N", "0"), ("s", "6", "n", None, "N", "0"))
    sources = table(spark, "branch string, source string", ("north", "s"), ("west", None))
    assert rows(erp.codcli_lookup(df, clients, sources)) == [("1", "north", "9")]


def test_registry_match_fans_out_and_keeps_unmatched(spark):
    reg = registry_table(spark, {"cnpj": "1-0", "uf": "RJ", "status": "Ativa", "nome": "n"},
                         {"cnpj": "2", "uf": "RJ", "status": "Ativa"}, {"cnpj": "", "uf": "RJ", "status": "Ativa"},
                         {"cnpj": "3", "uf": "RJ", "status": "Baixada"}, {"cnpj": "4", "uf": "SP", "status": "Ativa"})
    clients = table(spark, CLIENTS, ("s", "7", "n", "10", "N", "0"), ("s", "8", "n", "10", "N", "0"),
                    ("s", "9", "n", None, "N", "0"))
    states = table(spark, "branch string, uf string, source string", ("B", "RJ", "s"))
    found = erp.registry_erp_match(reg, clients, states).select("cnpj", "codcli")
    assert rows(found) == [("", None), ("10", "7"), ("10", "8"), ("2", None)]
    safe = erp.registry_erp_match(reg, clients, states, null_safe=True).select("cnpj", "codcli")
    assert rows(safe) == [("", "9"), ("10", "7"), ("10", "8"), ("2", None)]


def test_erp_presence_changes_nothing_and_its_fix_does(spark):
    df = items(spark, {"order_no": "1"}, {"order_no": "2"})
    seen = table(spark, "numpedcli string", (None,), (None,), ("2",))
    assert rows(erp.erp_presence_join(df, seen).select("order_no")) == [("1",), ("2",)]
    assert rows(erp.exclude_orders_in_erp(df, seen).select("order_no")) == [("1",)]


# ---------------------------------------------------------------- capture

def test_capture_cycle(spark):
    stored = items(spark, {"order_no": "1", "sku": "a"}, {"order_no": "2", "sku": "a"},
                   {"order_no": "5", "sku": "a", "branch": "south"})
    listing = table(spark, "branch string, order_no string, pos int, order_date string, payment string, status string",
                    ("north", "1", 1, "d", None, None), ("north", "3", 2, "d3", "listed", "S"),
                    ("north", "3", 9, "late", "no", "no"))
    item = "struct<product_name:string,sku:string,price:string,quantity:string,quantity_prepared:string>"
    details = spark.createDataFrame(
        [("north", "3", {"pagamento": ["pagamento", ""], "Nome comercial": ["Nome comercial", "Bar"],
                         "Endereço de entrega": ["Endereço de entrega"]}, None, "CD",
          [("p", "x", "$1", "1", "1"), ("p", "x", "$2", "1", "1"), ("p", "y", None, "1", "1")])],
        f"branch string, order_no string, labels map<string,array<string>>, status string, center string, items array<{item}>")
    captured = table(spark, "branch string, complete boolean", ("north", True))
    new = jobs.reconcile(stored.drop("ord"), listing, details, captured)
    got = rows(new.select("branch", "order_no", "sku", "price", "payment", "status", "trade_name", "street",
                          "order_date", "state_reg"))
    assert [g[:3] for g in got] == [("north", "1", "a"), ("north", "3", "x"), ("south", "5", "a")]
    assert got[1][3:] == ("$1", "listed", "S", "Bar", "Não capturado", "d3", "ISENTO")


# -------------------------------------------------------------- dashboard

def test_totals_search_and_pages(spark):
    df = items(spark, {"order_no": "1", "order_total": "$1.000,50", "trade_name": "Bar Ção", "codcli": "77"},
               {"order_no": "1", "order_total": "$9", "branch": "south"},
               {"order_no": "2", "order_total": "x", "branch": None, "document": "CPF: 1"},
               {"order_no": "3", "order_total": None, "branch": "south"})
    assert [str(v) for v in dashboard.order_stats(df).first()] == ["3", "1000.50"]
    assert str(dashboard.order_stats(items(spark)).first()[1]) == "0.00"
    assert rows(dashboard.orders_per_branch(df)) == [("Desconhecida", 1), ("north", 1), ("south", 1)]
    heads = dashboard.order_list(df)
    found = lambda *a: [r[0] for r in rows(dashboard.search_orders(heads, *a).select("order_no"))]
    assert found(" ÇÃO ") == ["1"] and found("cpf") == ["2"] and found("77") == ["1"]
    assert found("", "south") == ["3"] and found() == ["1", "2", "3"] and found("zzz") == []
    page = dashboard.paginate(heads, 9, 2).collect()
    assert [(r.order_no, r.page, r.pages, r["first"], r["last"], r.total) for r in page] == [("3", 2, 2, 3, 3, 3)]
    assert dashboard.paginate(heads.where("false"), 1).count() == 0
    assert dashboard.orders_grouped(dashboard.point_lookup(df, " 2 ")).groupBy("kind").count().count() == 2


@pytest.mark.parametrize("page, left", [(1, 3), (2, 3), (4, 1), (99, 1)])
def test_pages_of_equal_and_null_keys(spark, page, left):
    df = table(spark, "k string, v int", *[("same", i) for i in range(6)], *[(None, i) for i in range(4)])
    got = dashboard.paginate(df, page, 3, ["k"])
    assert got.count() == left and got.first().total == 10
    pages = [tuple(r)[:2] for p in (1, 2, 3, 4) for r in dashboard.paginate(df, p, 3, ["k"]).collect()]
    assert sorted(pages, key=repr) == rows(df)


def test_grouped_orders_take_the_first_row_with_its_nulls(spark):
    df = items(spark, {"order_no": "1", "trade_name": None, "sku": "b"}, {"order_no": "1", "trade_name": "x", "sku": "a"})
    doc = dashboard.orders_grouped(df).orderBy("order_no", F.col("ord").asc_nulls_first()).collect()
    assert [(r.kind, r.trade_name, r.sku) for r in doc] == [
        ("order", None, None), ("item", None, "b"), ("item", None, "a")]
    back = dashboard.flat_orders(df).orderBy("ord").select("sku", "trade_name")
    assert [tuple(r) for r in back.collect()] == [("b", None), ("a", None)]


def test_last_update(spark):
    df = table(spark, "collected_at timestamp", (datetime.datetime(2024, 1, 1, 5, 6, 7),), (None,))
    assert dashboard.last_update(df).first()[0] == "05:06:07"
    assert dashboard.last_update(df.where("false")).first()[0] == "nunca"


def test_shaping(spark):
    df = table(spark, "a string, b string", ("1", "2"))
    assert shaping.rename_labels(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]
    assert shaping.upper_columns(df).columns == ["A", "B"]
    assert shaping.drop_columns(df, ["b", "c"]).columns == ["a"]
    with pytest.raises(ValueError):
        shaping.drop_columns(df, ["c"], strict=True)
    once = shaping.ensure_columns(df, ["c"])
    assert shaping.ensure_columns(once, ["c"]).columns == ["a", "b", "c"]
    code = lambda text: shaping.payment_code(F.lit(text), {"Dinheiro": "D"})
    assert rows(df.select(code("Dinheiro"), code("x"))) == [("D", "x")]
    empty = shaping.rule_table(spark, [], "a string, b int")
    assert empty.count() == 0 and empty.columns == ["a", "b"]
