"""From captured listing and detail pages to item rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.extract import document_of, label_values, state_registration_of
from orderloom.functions.text import first_filled
from orderloom.operators.picking import first_rows
from orderloom.rules import NOT_CAPTURED
from orderloom.schemas import ITEM_FIELDS

# Label texts of a captured detail page.
TAX_LABEL = "Tax ID"
TRADE_LABEL = "Nome comercial"
ADDRESS_LABEL = "Endereço de entrega"
PHONE_LABEL = "telefone"
EMAIL_LABEL = "E-mail"
PAYMENT_LABEL = "pagamento"
BUSINESS_LABEL = "ID do negócio"
ACCOUNT_LABEL = "ID da conta do cliente"


def dedupe_listing(listing: DataFrame) -> DataFrame:
    """An order captured on two pages counts once, where it was seen first."""
    return first_rows(listing, ["branch", "order_no"], ["pos"])


def new_orders(listing: DataFrame, items: DataFrame) -> DataFrame:
    """Listed orders of a branch that the branch has not stored yet."""
    return listing.join(stored_orders(items), ["branch", "order_no"], "left_anti")


def stored_orders(items: DataFrame) -> DataFrame:
    return items.select("branch", "order_no").distinct()


def texts_of(label: str) -> Column:
    return label_values(F.try_element_at(F.col("labels"), F.lit(label)))


def _at(label: str, i: int) -> Column:
    return F.get(texts_of(label), F.lit(i))


def order_headers(listing: DataFrame, details: DataFrame) -> DataFrame:
    """Header of each captured order: detail value, else what the listing showed.

    Payment, business and account fall back when blank; trade name, contacts, status
    and centre only when absent from the page.
    """
    detail = details.select(
        "branch", "order_no", "items", F.col("status").alias("d_status"),
        F.col("center").alias("d_center"),
        _at(PAYMENT_LABEL, 0).alias("d_payment"), _at(BUSINESS_LABEL, 0).alias("d_business_id"),
        _at(ACCOUNT_LABEL, 0).alias("d_account_id"), _at(TRADE_LABEL, 0).alias("d_trade_name"),
        document_of(texts_of(TAX_LABEL)).alias("document"),
        state_registration_of(texts_of(TAX_LABEL)).alias("state_reg"),
        F.coalesce(_at(ADDRESS_LABEL, 0), F.lit(NOT_CAPTURED)).alias("street"),
        F.coalesce(_at(ADDRESS_LABEL, 1), F.lit("")).alias("city_uf"),
        F.coalesce(_at(ADDRESS_LABEL, 2), F.lit("")).alias("zip"),
        F.coalesce(_at(ADDRESS_LABEL, 3), F.lit("")).alias("coordinates"),
        _at(PHONE_LABEL, 0).alias("d_phone_1"), _at(PHONE_LABEL, 1).alias("d_phone_2"),
        _at(EMAIL_LABEL, 0).alias("d_email_1"), _at(EMAIL_LABEL, 1).alias("d_email_2"))
    both = listing.join(detail, ["branch", "order_no"])

    def listed(name: str) -> Column:
        return F.col(name) if name in listing.columns else F.lit(None).cast("string")

    filled = {n: first_filled(F.col(f"d_{n}"), listed(n))
              for n in ("payment", "business_id", "account_id")}
    present = {n: F.coalesce(F.col(f"d_{n}"), listed(n))
               for n in ("status", "center", "trade_name", "phone_1", "phone_2",
                         "email_1", "email_2")}
    return both.withColumns({**filled, **present}).drop(
        *[f"d_{n}" for n in (*filled, *present)])


def explode_items(headers: DataFrame) -> DataFrame:
    """One row per item, header repeated; an item with a missing part is skipped."""
    rows = headers.select("*", F.posexplode("items").alias("item_pos", "item")).drop("items")
    whole = F.lit(True)
    for part in ITEM_FIELDS:
        whole = whole & F.col(f"item.{part}").isNotNull()
    return rows.where(whole).select("*", "item.*").drop("item")
