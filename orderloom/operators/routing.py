"""Routing orders by delivery city and rendering their messages."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.clock import day_greeting
from orderloom.functions.money import (fixed2, parse_money_us, quantity_text, to_number_or_zero,
                                       unit_price)
from orderloom.functions.text import (blank_to_null, clean_phone, key_text, strip,
                                      upper_trim_city)
from orderloom.operators.picking import first_rows
from orderloom.operators.state import mark_dispatched
from orderloom.rules import GENERAL_DOCUMENT, GENERAL_STATE, ROUTE_OPENING


def matches_any(city: Column, patterns: Sequence[str]) -> Column:
    """The city text contains one of the patterns (upper-cased, as the text is)."""
    hits = [F.contains(city, F.lit(p)) for p in dict.fromkeys(p.upper() for p in patterns)]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def order_heads(items: DataFrame, *columns: str, order: str = "ord") -> DataFrame:
    """Fields of each order's first row, nulls included; cut before the shuffle."""
    named = items.where("order_no IS NOT NULL").select("order_no", order, *columns)
    return first_rows(named, ["order_no"], [order]).select("order_no", *columns)


def not_sent(orders: DataFrame, sent: DataFrame) -> DataFrame:
    """Orders whose trimmed number is not in the sent set."""
    done = sent.select(key_text(F.col("order_no")).alias("_sent"))
    return orders.join(done, key_text(orders["order_no"]) == F.col("_sent"), "left_anti")


def route_of(city: Column, document: Column, regional: Sequence[str],
             interior: Sequence[str]) -> Column:
    """``regional``, ``general`` or null for an order's first row."""
    city = F.coalesce(upper_trim_city(city), F.lit(""))
    return _route(city, document, matches_any(city, regional), matches_any(city, interior))


def _route(city: Column, document: Column, regional: Column, interior: Column) -> Column:
    document = F.coalesce(F.upper(strip(document)), F.lit(""))
    general = (~interior & F.contains(document, F.lit(GENERAL_DOCUMENT))
               & F.contains(city, F.lit(GENERAL_STATE)))
    return F.when(regional, F.lit("regional")).when(general, F.lit("general"))


def route_orders(items: DataFrame, sent: DataFrame, regional: Sequence[str],
                 interior: Sequence[str]) -> DataFrame:
    """Route of every unsent order. Patterns are tested once per order, not per item,
    and as plain expressions, so no join with the rule list is needed."""
    heads = order_heads(items, "city_uf", "document")
    route = route_of(F.col("city_uf"), F.col("document"), regional, interior)
    return not_sent(heads.select("order_no", route.alias("route")), sent)


def pattern_hits(texts: DataFrame, patterns: DataFrame, text: str = "city") -> DataFrame:
    """(text, lists): for each distinct text the lists that have a pattern it contains.

    ``patterns`` is a table (list, pattern) of any size. A text is cut into its substrings of the
    lengths that patterns have, and these meet the patterns in an equi-join, so no text is
    compared with every pattern. The empty pattern is in every text, a null one in none.
    """
    known = (patterns.where("pattern is not null")
             .select("list", F.upper("pattern").alias("_piece")).distinct())
    # One number per distinct length: at most as many as the longest pattern has characters.
    lengths = known.agg(F.coalesce(F.collect_set(F.length("_piece")), F.array().cast("array<int>"))).scalar()
    size = F.length(text)
    cut = (texts.select(text).distinct().select(text, F.explode(lengths).alias("_n"))
           .where(F.col("_n") <= size)
           .select(text, "_n", F.explode(F.sequence(F.lit(1), size - F.col("_n") + 1)).alias("_at"))
           .select(text, F.substr(text, "_at", "_n").alias("_piece")).distinct())
    return (cut.join(known, "_piece").groupBy(F.xxhash64(text).alias("_hash"), text)
            .agg(F.collect_set("list").alias("lists")).drop("_hash"))


def route_orders_by_rules(items: DataFrame, sent: DataFrame, patterns: DataFrame) -> DataFrame:
    """``route_orders`` with the city patterns as a table (list = regional or interior,
    pattern). Distinct cities are matched, and each order looks its city up."""
    heads = order_heads(items, "city_uf", "document").withColumn(
        "city", F.coalesce(upper_trim_city(F.col("city_uf")), F.lit("")))
    hits = pattern_hits(heads, patterns)
    found = heads.join(hits, "city", "left")
    on = lambda name: F.coalesce(F.array_contains("lists", F.lit(name)), F.lit(False))
    route = _route(F.col("city"), F.col("document"), on("regional"), on("interior"))
    return not_sent(found.select("order_no", route.alias("route")), sent)


def any_eligible(items: DataFrame, sent: DataFrame,
                 regional: Sequence[str], interior: Sequence[str]) -> DataFrame:
    """One row: is there any unsent order with a route?"""
    routed = route_orders(items, sent, regional, interior)
    return routed.agg(F.coalesce(F.bool_or(F.col("route").isNotNull()), F.lit(False))
                      .alias("eligible"))


def item_line(price_is: str = "line") -> Column:
    """Message line of one item row; a zero quantity shows the captured price."""
    price = parse_money_us(F.col("price"), "zero")
    quantity = to_number_or_zero(F.col("quantity"))
    each = unit_price(price, quantity, price_is)
    shown = F.when(each.isNotNull(), F.concat(F.lit("Preço Unitário: R$"), fixed2(each))).otherwise(
        F.concat(F.lit("Preço Total: R$"), fixed2(price), F.lit(" (Quantidade zero)")))
    return F.concat(F.lit("*Produto*: "), F.coalesce("product_name", F.lit("")),
                    F.lit(" | Quantidade: "), quantity_text(quantity), F.lit(" | "), shown,
                    F.lit("\n"))


def order_message_lines(items: DataFrame, price_is: str = "line") -> DataFrame:
    """Item lines of each order: (order_no, ord, line); sorted by ``ord`` they are its text."""
    return (items.where("order_no IS NOT NULL")
            .select("order_no", "ord", item_line(price_is).alias("line")))


HEADER = ["responsible", "document", "trade_name", "email_1", "phone_1", "phone_2", "payment",
          "order_total", "street", "city_uf", "zip", "delivery_date"]
# Optional further contacts, shown where the items carry them.
CONTACTS = ["contact_3", "contact_4", "contact_5"]


def message_head(columns: Sequence[str]) -> Column:
    """Header of an order message; absent optional fields leave no line."""
    def always(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"*{label}*: "), F.coalesce(value, F.lit("")), F.lit("\n"))

    def given(label: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"*{label}*: "), blank_to_null(value), F.lit("\n")),
                          F.lit(""))

    contacts = [given(f"Contato {c[-1]}", F.col(c)) for c in CONTACTS if c in columns]
    return F.concat(
        F.lit("*Número Pedido*: *"), F.col("order_no"), F.lit("*\n"),
        always("Responsavel", F.col("responsible")),
        always("Documento", F.col("document")),
        always("Estabelecimento", F.col("trade_name")),
        given("Email", F.col("email_1")),
        given("Telefone 1", clean_phone(F.col("phone_1"))),
        given("Telefone 2", clean_phone(F.col("phone_2"))),
        *contacts,
        always("Forma de Pagamento", F.col("payment")),
        always("Total Pedido", F.col("order_total")),
        always("Endereço de Entrega", F.col("street")),
        always("Cidade/UF", upper_trim_city(F.col("city_uf"))),
        always("CEP", F.col("zip")),
        always("Data Entrega", F.col("delivery_date")))


def order_messages(items: DataFrame, price_is: str = "line") -> DataFrame:
    """Messages as rows: (order_no, kind, ord, text). Each order has one row of kind
    ``order``, the head of its message, and one of kind ``line`` for each item; the texts in the
    order of (kind = 'line', ord) are the message. Nothing is gathered per order."""
    head = HEADER + [c for c in CONTACTS if c in items.columns]
    heads = order_heads(items, *head).select(
        "order_no", F.lit("order").alias("kind"), message_head(head).alias("text"))
    lines = order_message_lines(items, price_is).select(
        "order_no", F.lit("line").alias("kind"), "ord", F.col("line").alias("text"))
    return (heads.unionByName(lines, allowMissingColumns=True)
            .select("order_no", "kind", "ord", "text"))


def routed_outbox(items: DataFrame, sent: DataFrame, target: str, as_of: Column,
                  regional: Sequence[str], interior: Sequence[str]) -> DataFrame:
    """Messages of the regional route: (target, seq, kind, order_no, ord, text). A
    greeting (seq 0) goes first if there is any order; heads have seq 1, lines seq 2. The
    general route is computed by ``route_orders`` and sends nothing."""
    regional_orders = (route_orders(items, sent, regional, interior)
                       .where("route = 'regional'").select("order_no"))
    texts = order_messages(items.join(regional_orders, "order_no", "left_semi"))
    messages = texts.select(F.lit(target).alias("target"),
                            F.when(F.col("kind") == "order", 1).otherwise(2).alias("seq"),
                            "kind", "order_no", "ord", "text")
    hello = F.concat(day_greeting(as_of), F.lit("! " + ROUTE_OPENING))
    greeting = (regional_orders.agg(F.count("*").alias("n")).where("n > 0")
                .select(F.lit(target).alias("target"), F.lit(0).alias("seq"),
                        F.lit("greeting").alias("kind"), hello.alias("text")))
    return messages.unionByName(greeting, allowMissingColumns=True)


def queue_routed(queue: DataFrame, outbox: DataFrame, as_of: Column) -> DataFrame:
    """The dispatch queue with the orders of an outbox added."""
    routed = outbox.where("kind = 'order'").select("order_no", as_of.alias("sent_at"))
    return mark_dispatched(queue, routed)


def sent_after(sent: DataFrame, routed: DataFrame) -> DataFrame:
    """Sent set with the routed orders added, sorted as text."""
    both = sent.select("order_no").unionByName(routed.select("order_no"))
    return both.select(key_text(F.col("order_no")).alias("order_no")).distinct().orderBy("order_no")
