"""Company registry: finding unknown companies and flattening their records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.money import MONEY
from orderloom.functions.text import bool_text, clean_tax_punct, stored_text, valid_tax_number
from orderloom.operators.picking import first_rows
from orderloom.rules import (ACTIVE_STATUS, NO_ACTIVITY, NO_DATA, NOT_AVAILABLE, NOT_FOUND_F,
                             REGISTRATION_OK)


def order_companies(items: DataFrame) -> DataFrame:
    """Distinct valid company numbers among the account ids of the orders."""
    cleaned = clean_tax_punct(stored_text(F.col("account_id"))).alias("cnpj")
    return items.select(cleaned).where(valid_tax_number(F.col("cnpj"))).distinct()


def unknown_companies(items: DataFrame, registry: DataFrame) -> DataFrame:
    """Companies of the orders that the registry table does not hold."""
    return order_companies(items).join(registry.select("cnpj"), "cnpj", "left_anti")


def company_problems(registry: DataFrame) -> DataFrame:
    """Companies that are not active or have a bad state registration; a null
    status or registration is no problem by itself (three-valued logic)."""
    return (registry.where((F.col("status") != ACTIVE_STATUS)
                           | ~F.col("ie_status").isin(REGISTRATION_OK))
            .select("cnpj", "status", "ie_status"))


def fiscal_pending_orders(items: DataFrame, registry: DataFrame,
                          clean_key: bool = False) -> DataFrame:
    """Orders (one row each) of companies with a problem, matched on the raw account
    id, or on the cleaned one with ``clean_key``. The account is the one of the order's
    first row, so the first row is picked before the match."""
    orders = first_rows(items.select("order_no", "account_id", "ord"), ["order_no"], ["ord"])
    account = F.col("account_id")
    key = clean_tax_punct(account) if clean_key else account
    return (company_problems(registry)
            .join(orders.select("order_no", "account_id", key.alias("cnpj")), "cnpj")
            .select("cnpj", "status", "ie_status", "order_no", "account_id"))


def _field(path: str, default: str | None = None, kind: str = "string") -> Column:
    """Text at a path. The default stands in for a *missing* value only; a JSON null
    stays null. A null object on the way counts as missing."""
    record = F.col("_record")
    value = F.try_variant_get(record, path, kind)
    if default is None:
        return value
    is_null = F.is_variant_null(F.try_variant_get(record, path, "variant"))
    return F.when(is_null, F.lit(None)).otherwise(F.coalesce(value, F.lit(default)))


def _flag(path: str) -> Column:
    is_null = F.is_variant_null(F.try_variant_get(F.col("_record"), path, "variant"))
    value = bool_text(F.try_variant_get(F.col("_record"), path, "boolean"))
    return F.when(is_null, F.lit(None)).otherwise(F.coalesce(value, F.lit(NO_DATA)))


def _joined(path: str, kind: str, text, empty: str) -> Column:
    parts = F.transform(F.try_variant_get(F.col("_record"), path, f"array<{kind}>"), text)
    return F.coalesce(F.nullif(F.array_join(parts, ", "), F.lit("")), F.lit(empty))


def join_phones() -> Column:
    return _joined("$.phones", "struct<area:string,number:string>",
                   lambda p: F.concat(F.lit("("), p["area"], F.lit(") "), p["number"]), NO_DATA)


def join_emails() -> Column:
    return _joined("$.emails", "struct<address:string>", lambda e: e["address"], NO_DATA)


def join_activities() -> Column:
    return _joined("$.sideActivities", "struct<text:string>", lambda a: a["text"], NO_ACTIVITY)


def parse_records(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """JSON texts -> ``_record`` variants; a text that is no JSON object is skipped."""
    return (docs.withColumn("_record", F.try_parse_json(doc))
            .where(F.schema_of_variant("_record").startswith("OBJECT")))


def flatten_company(docs: DataFrame, doc: str = "doc", keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested registry records -> the flat columns of the registry table."""
    equity = F.try_variant_get(F.col("_record"), "$.company.equity", MONEY).cast("string")
    columns = {
        "cnpj": _field("$.taxId"),
        "nome": _field("$.company.name"),
        "nome_fantasia": _field("$.alias", NOT_AVAILABLE),
        "capital_social": equity,
        "natureza_juridica": _field("$.company.nature.text", NO_DATA),
        "tamanho": _field("$.company.size.text", NO_DATA),
        "data_fundacao": _field("$.founded"),
        "status": _field("$.status.text"),
        "data_status": _field("$.statusDate"),
        "razao_status": _field("$.reason.text", NOT_AVAILABLE),
        "telefone": join_phones(),
        "email": join_emails(),
        "atividade_principal": _field("$.mainActivity.text", NO_DATA),
        "atividades_secundarias": join_activities(),
        "simples_optante": _flag("$.company.simples.optant"),
        "simei_optante": _flag("$.company.simei.optant"),
    }
    address = {"rua": "street", "numero": "number", "complemento": "details",
               "bairro": "district", "cidade": "city", "uf": "state", "cep": "zip"}
    columns |= {c: _field(f"$.address.{f}", NOT_AVAILABLE) for c, f in address.items()}
    registration = {"ie_estado": "state", "ie_numero": "number", "ie_status": "status.text",
                    "ie_tipo": "type.text", "ie_data_status": "statusDate"}
    columns |= {c: _field(f"$.registrations[0].{f}", NOT_FOUND_F)
                for c, f in registration.items()}
    return parse_records(docs, doc).select(*keep, *[v.alias(k) for k, v in columns.items()])
