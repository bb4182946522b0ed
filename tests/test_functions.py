"""Single-value rules, by literal inputs."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from orderloom.functions import clock, display, extract, money, text

D = decimal.Decimal


def values(spark, inputs, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


CASES = [
    (text.digits_only, ["CNPJ: 12.3-4", "", None, "²1"], ["1234", "", None, "1"]),
    (text.clean_tax_punct, [" 12.345/0-a ", None, ""], ["123450A", None, ""]),
    (text.valid_tax_number, ["123456789012", "12345678901", "12345678901A", "", None],
     [True, False, False, False, False]),
    (text.doc_number, ["CNPJ: 1 ", "CNPJ", "a:", "a: b : c", "", None],
     ["1", None, "", "b", None, None]),
    (text.doc_type, ["CNPJ: 1", "CNPJ", "a:b:c", None], ["CNPJ", "CNPJ", "a", None]),
    (text.is_personal_document, ["CPF: 1", "cpf: 1", "", None], [True, False, False, False]),
    (text.format_document, ["CNPJ: 1", "CPF: 2", "CPF: CPF: 3", "x", "", None],
     ["1", "2", "CPF: 3", "x", "—", "—"]),
    (text.clean_phone, ["+55(21)91234-5678.0", "1.05 6", " 7 ", None],
     ["21912345678", "15 6", "7", None]),
    (text.format_date_br, ["2024-03-09", "2024-03-09 10:00", "09/03/2024", "09/03/2024 x",
                           "2024-03", "soon", "", None, "2024-03-09-1"],
     ["09/03/2024", "09/03/2024", "09/03/2024", "09/03/2024", "2024-03", "soon", "—", "—",
      "09/03/2024"]),
    (text.upper_trim_city, ["\t São Paulo \n", None], ["SÃO PAULO", None]),
    (text.key_text, [" 1\n", "2", None], ["1", "2", None]),
    (text.null_to_dash, ["a", "", None], ["a", "—", "—"]),
    (text.stored_text, ["a", "", None], ["a", "", ""]),
    (money.parse_money_br, ["$1.234,56", "$1,234.56", "10", "R$ 10,00", "", "x", None],
     [D("1234.56"), D("1.23"), D("10.00"), None, None, None, None]),
    (money.parse_money_us, ["$1,234.56", "$1.234,56", " 7 ", "", "x", None],
     [D("1234.56"), D("1.23"), D("7.00"), None, None, None]),
    (lambda c: money.parse_money_us(c, "zero"), ["$2.50", "", None], [D("2.50"), D("0.00"), D("0.00")]),
    (money.to_number_or_zero, ["5", "2.5", "", "x", None],
     [D("5.000"), D("2.500"), D("0.000"), D("0.000"), D("0.000")]),
    (lambda c: money.quantity_text(money.to_number_or_zero(c)), ["5", "2.50", "100", "0", "x"],
     ["5", "2.5", "100", "0", "0"]),
    (money.format_total, ["$1.234,56", "1000000", "abc", "", None, "-5,5"],
     ["R$ 1.234,56", "R$ 1.000.000,00", "abc", "—", "—", "-R$ 5,50"]),
    (display.payment_family, ["Pix na entrega", "Dinheiro", "Cartão de Débito", "cartao x",
                              "BOLETO", "Vale troca", "", None],
     ["PIX", "Dinheiro", "Cartão", "Cartão", "Boleto", "Vale", "—", "—"]),
    (display.payment_badge, ["PIX", "dinheiro", "Cartão", "Boleto", "", None],
     ["badge-green", "badge-blue", "badge-yellow", "badge-gray", "badge-gray", "badge-gray"]),
    (display.status_badge, ["A ser preparado", "Entregue", "Cancelado", "Recusado", "Novo", "", None],
     ["badge-green", "badge-green", "badge-red", "badge-red", "badge-yellow", "badge-gray",
      "badge-gray"]),
    (extract.ocr_fix, ["OoI|a", None], ["001a", None]),
    (extract.first_tax_id, ["x 12.345.678/0001-90 98765432/0001-10", "12345678000190", "", None],
     ["12.345.678/0001-90", "Não encontrado", "Não encontrado", "Não encontrado"]),
    (extract.last_total, ["TOTAL 1,00 Nota R$: 2,50", "valor 3", None],
     ["2,50", "Não encontrado", "Não encontrado"]),
    (extract.first_access_key, ["k " + "1234 " * 11 + "fim", "1" * 43, "7" * 44, None],
     ["1234" * 11, "Não encontrada", "7" * 44, "Não encontrada"]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_text_rules(spark, case):
    fn, inputs, expected = CASES[case]
    assert values(spark, inputs, fn) == expected


def test_money_error_options(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["x"], lambda c: money.parse_money_us(c, "fail"))
    with pytest.raises(ValueError):
        money.parse_money_us(F.col("v"), "skip")


def test_unit_price_rounds_half_up_and_never_divides_by_zero(spark):
    df = spark.createDataFrame([("1.00", "3"), ("0.25", "2"), ("5.35", "2"), ("9.00", "0"), ("1.00", None)],
                               "p string, q string")
    price, quantity = money.parse_money_us(F.col("p")), money.to_number_or_zero(F.col("q"))
    got = df.select(money.unit_price(price, quantity), money.unit_price(price, quantity, "unit")).collect()
    assert [r[0] for r in got] == [D("0.33"), D("0.13"), D("2.68"), None, None]
    assert [r[1] for r in got] == [D("1.00"), D("0.25"), D("5.35"), None, None]


def test_greeting_and_hours(spark):
    hours = [4, 5, 11, 12, 17, 18, 23]
    day = datetime.datetime(2024, 1, 10)  # a Wednesday
    stamps = [day.replace(hour=h) for h in hours] + [datetime.datetime(2024, 1, 13, 10)]
    assert values(spark, stamps, clock.day_greeting, "timestamp")[:7] == [
        "Boa noite", "Bom dia", "Bom dia", "Boa tarde", "Boa tarde", "Boa noite", "Boa noite"]
    assert values(spark, stamps, clock.business_hours, "timestamp") == [
        False, False, True, True, True, False, False, False]
    named = values(spark, stamps[:1], lambda c: clock.day_greeting(c, F.lit("Ana")), "timestamp")
    unnamed = values(spark, stamps[:1], lambda c: clock.day_greeting(c, F.lit("")), "timestamp")
    assert (named, unnamed) == (["Boa noite, Ana"], ["Boa noite"])
    assert values(spark, [day.replace(hour=9, second=7)], clock.time_text, "timestamp") == ["09:00:07"]


def test_label_arrays(spark):
    df = spark.createDataFrame([(["L", " CNPJ: 1 ", "INSCRICAO_ESTADUAL: 9"],), (["L"],), ([],), (None,)],
                               "v array<string>")
    got = df.select(extract.label_values(F.col("v")).alias("v")).select(
        F.size("v"), extract.document_of(F.col("v")), extract.state_registration_of(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [(2, "CNPJ: 1", "9"), (0, None, "ISENTO"), (0, None, "ISENTO"),
                                       (0, None, "ISENTO")]
