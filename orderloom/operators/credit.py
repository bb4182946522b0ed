"""Customers whose free credit does not cover their order, and the notices on it."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.clock import day_greeting
from orderloom.functions.money import MONEY, fixed2, parse_money_us
from orderloom.functions.text import blank_to_null, doc_number
from orderloom.operators.erp import (clients_per_branch, clients_with_debt,
                                     exclude_orders_in_erp, keyed_clients)
from orderloom.operators.picking import first_filled_value, first_rows
from orderloom.operators.shaping import payment_code
from orderloom.rules import CREDIT_CLOSING, CREDIT_OPENING

SUM = "decimal(28,2)"


def is_short(available: Column, total: Column, blocked: Column) -> Column:
    """Not enough free credit (equal is enough), or a blocked customer."""
    return (available < total) | F.coalesce(blocked == "S", F.lit(False))


def credit_requests(items: DataFrame, centers: DataFrame, grain: str = "document") -> DataFrame:
    """Orders that count for the credit check: the first order of each document in a
    branch, or with ``grain="order"`` every order. Items outside the listed centres
    and orders without a document number drop out before anything is shuffled."""
    rules = centers.select("center", "branch")
    candidates = (items.select("order_no", "center", "order_total", "payment", "ord",
                               blank_to_null(doc_number(F.col("document"))).alias("doc_key"))
                  .where("doc_key IS NOT NULL").join(rules, "center"))
    keys = {"document": ["doc_key", "branch"], "order": ["order_no", "branch"]}[grain]
    return first_rows(candidates, keys, ["order_no", "ord"], by_hash=True)


def order_client_join(requests: DataFrame, clients: DataFrame) -> DataFrame:
    """Requests with the branch's customers of the same document number."""
    return requests.join(keyed_clients(clients).drop("cgcent"), ["doc_key", "branch"])


def credit_gap(items: DataFrame, clients: DataFrame, receivables: DataFrame, centers: DataFrame,
               branch_sources: DataFrame, *, grain: str = "document",
               payments: Mapping[str, str],
               erp_orders: DataFrame | None = None) -> DataFrame:
    """Customers to ask a credit limit for: codcli, total, payment, branch.

    The requests are cut to one row per (branch, document) before they are shuffled
    and meet the customers; both sides of that join come straight from a shuffle, so a
    document shared by very many customers can be split. ``erp_orders`` leaves out the
    orders the ERP holds already.
    """
    requests = credit_requests(items, centers, grain)
    if erp_orders is not None:
        requests = exclude_orders_in_erp(requests, erp_orders)
    requests = requests.withColumns({
        "_order": F.struct("order_no", "ord"), "_value": parse_money_us(F.col("order_total")),
        "payment": payment_code(F.col("payment"), payments)})
    if grain == "order":  # one row per document, before it meets that document's customers
        requests = requests.groupBy("doc_key", "branch").agg(
            F.sum("_value").alias("_value"), F.min("_order").alias("_order"),
            first_filled_value("payment", "_order").alias("payment"))
    known = clients_per_branch(clients_with_debt(clients, receivables), branch_sources)
    matched = order_client_join(requests, known)
    limit = parse_money_us(F.col("limcred").cast("string"))
    per_client = matched.groupBy("branch", "codcli").agg(
        F.coalesce(F.sum("_value"), F.lit(0)).cast(SUM).alias("total"),
        first_filled_value("bloqueio", "_order").alias("bloqueio"),
        first_filled_value(limit, "_order").alias("limit"),
        first_filled_value("valor", "_order").alias("debt"),
        first_filled_value("payment", "_order").alias("payment"))
    zero = F.lit(0).cast(MONEY)
    available = F.coalesce("limit", zero) - F.coalesce("debt", zero)
    return (per_client.where(is_short(available, F.col("total"), F.col("bloqueio")))
            .select("codcli", "total", "payment", "branch"))


def rejected_totals(items: DataFrame) -> DataFrame:
    """How many rows carry a total that cannot be read as a number."""
    unread = parse_money_us(F.col("order_total")).isNull()
    return items.agg(F.count_if(unread).alias("rejected"), F.count("*").alias("rows"))


def credit_message(codcli: Column, total: Column, payment: Column) -> Column:
    """Text of one credit request."""
    return F.concat(F.lit("👤 *Cod Cliente:* "), codcli,
                    F.lit("\n💰 *Valor do Pedido:* R$ "), fixed2(total),
                    F.lit("\n💳 *Forma de Pagamento:* "), F.coalesce(payment, F.lit("None")),
                    F.lit("\n"))


def credit_outbox(gaps: DataFrame, contacts: DataFrame, ledger: DataFrame,
                  as_of: Column) -> DataFrame:
    """Messages to send: (branch, target, seq, kind, codcli, text).

    A branch with a contact and at least one short customer gets a greeting, unless
    greeted that day; then one request per customer not notified that day, in the
    order of the codes; then a closing line if there was any request. ``seq`` orders
    the kinds, ``codcli`` the requests. One grouping-sets pass gives both the customer
    rows and the branch rows, so the gap is computed once.
    """
    day = F.to_date(as_of)
    reachable = contacts.where(blank_to_null(F.col("target")).isNotNull())
    today = ledger.where((F.col("sent_day") == day) | (F.col("greeted_day") == day))
    notified = (today.where(F.col("sent_day") == day).select("branch", "codcli").distinct()
                .withColumn("_done", F.lit(True)))
    # As many entries as there are branches; an array, so that no row is shuffled by branch.
    hailed = today.where(F.col("greeted_day") == day).agg(F.collect_set("branch")).scalar()
    flagged = (gaps.join(notified, ["branch", "codcli"], "left")
               .withColumn("_new", F.col("_done").isNull()))
    sets = flagged.groupingSets([["branch", "codcli"], ["branch"]], "branch", "codcli").agg(
        F.max("_new").alias("_new"), F.max("total").alias("total"),
        F.max("payment").alias("payment"), F.grouping("codcli").alias("_of_branch"))
    of_branch = F.col("_of_branch") == 1
    opening = F.concat(day_greeting(as_of, F.col("name")), F.lit("! " + CREDIT_OPENING))

    def line(when: Column, seq: int, kind: str, text: Column) -> Column:
        return F.when(when, F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"),
                                     text.alias("text")))

    lines = F.array_compact(F.array(
        line(of_branch & ~F.array_contains(hailed, F.col("branch")), 0, "greeting", opening),
        line(~of_branch & F.col("_new"), 1, "request",
             credit_message(F.col("codcli"), F.col("total"), F.col("payment"))),
        line(of_branch & F.col("_new"), 2, "closing", F.lit(CREDIT_CLOSING))))
    return (sets.join(reachable.select("branch", "target", "name"), "branch")
            .select("branch", "target", "codcli", F.explode(lines).alias("line"))
            .select("branch", "target", "line.seq", "line.kind", "codcli", "line.text"))
