"""Matching orders and companies with the customers of the ERP sources."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import blank_to_null, digits_only
from orderloom.operators.picking import first_rows, lookup_groups
from orderloom.operators.shaping import prepare_registry
from orderloom.sources.tables import receivables_sum


def keyed_clients(clients: DataFrame) -> DataFrame:
    """Clients with a digit-only document; blank and null documents never match."""
    key = blank_to_null(digits_only(F.col("cgcent")))
    return clients.withColumn("doc_key", key).where("doc_key IS NOT NULL")


def clients_per_branch(clients: DataFrame, branch_sources: DataFrame) -> DataFrame:
    """Scan each source once and serve every branch that uses it; a branch without
    a source gets no clients."""
    rules = branch_sources.where("source IS NOT NULL").select("branch", "source")
    return clients.join(rules, "source")


def codcli_lookup(items: DataFrame, clients: DataFrame, branch_sources: DataFrame) -> DataFrame:
    """Order -> customer code by the digits of the order's document, in the source of
    the order's branch. Of several customers with one document the largest code, as
    text, is taken. Orders without a match are left out."""
    orders = first_rows(items.select("order_no", "branch", "document", "ord"),
                        ["order_no", "branch"], ["ord"])
    keyed = (orders.select("order_no", "branch",
                           blank_to_null(digits_only(F.col("document"))).alias("doc_key"))
             .where("doc_key IS NOT NULL")
             .join(branch_sources.where("source IS NOT NULL"), "branch"))
    keys = ["source", "doc_key"]
    codes = lookup_groups(keyed_clients(clients), keys).agg(
        F.max(F.col("codcli").cast("string")).alias("codcli"))
    return keyed.join(codes, keys).select("order_no", "branch", "codcli")


def registry_erp_match(registry: DataFrame, clients: DataFrame, branch_states: DataFrame,
                       null_safe: bool = False) -> DataFrame:
    """Active companies of each branch's state with their customer code, null where
    the company is not registered. A document with several customers gives several
    rows. ``null_safe`` also matches blank with blank documents."""
    companies = (prepare_registry(registry)
                 .select("cnpj", "nome", "cidade", "uf", blank_to_null(F.col("cnpj")).alias("doc_key"))
                 .join(branch_states.select("branch", "uf", "source"), "uf"))
    coded = clients.select("source", F.col("codcli").cast("string").alias("codcli"),
                           blank_to_null(digits_only(F.col("cgcent"))).alias("c_key"))
    coded = coded.withColumnRenamed("source", "c_source")
    if null_safe:
        same = F.coalesce("doc_key", F.lit("")) == F.coalesce("c_key", F.lit(""))
    else:
        same = F.col("doc_key") == F.col("c_key")
    return (companies.join(coded, (F.col("source") == F.col("c_source")) & same, "left")
            .select("cnpj", "nome", "cidade", "uf", "codcli", "branch"))


def clients_with_debt(clients: DataFrame, receivables: DataFrame) -> DataFrame:
    """Clients with the sum of their open receivables, null where there is none."""
    debt = receivables_sum(receivables, ("source", "codcli"))
    return clients.join(debt, ["source", "codcli"], "left")


def erp_presence_join(orders: DataFrame, erp_orders: DataFrame) -> DataFrame:
    """Orders left-joined with the ERP orders that carry no order number. Such a key
    equals nothing, so every order comes out once and unmatched."""
    keys = (erp_orders.where("numpedcli IS NULL")
            .select(F.col("numpedcli").cast("string").alias("numpedcli")))
    return orders.join(keys, orders["order_no"] == keys["numpedcli"], "left")


def exclude_orders_in_erp(orders: DataFrame, erp_orders: DataFrame) -> DataFrame:
    """The join the step above was meant to be: orders the ERP does not hold yet."""
    known = (erp_orders.where("numpedcli IS NOT NULL")
             .select(F.col("numpedcli").cast("string").alias("order_no")))
    return orders.join(known, "order_no", "left_anti")
