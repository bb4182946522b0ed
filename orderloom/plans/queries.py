"""Registered queries: every operator over the whole derived tables.

Results are flat; money is bigint cents, times are text, so that they compare exactly.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom import rules
from orderloom.functions import clock, display, extract, money, text
from orderloom.operators import (bucketed, capture, credit, dashboard, documents, erp, ledger, outbox,
                                 paging, picking, registry, routing, search, shaping, state)
from orderloom.plans import bindings, jobs
from orderloom.plans.bindings import Tables
from orderloom.schemas import HEADER_FIELDS, ORDER_LABELS, REGISTRY_LABELS
from orderloom.session import new_folder, settle
from orderloom.sources import files, tables
from orderloom.streaming import jobs as streams, views

REGISTERED: dict[str, Callable[[Tables], DataFrame]] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REGISTERED[fn.__name__] = fn
    return fn


def named(name: str):
    """Register under a name that a module already takes."""
    def register(fn):
        REGISTERED[name] = fn
        return fn
    return register


def as_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(fn):
        return lambda spark, folder: fn(Tables(spark, folder))
    return {name: bound(fn) for name, fn in REGISTERED.items()}


def cents(name: str, out: str | None = None) -> Column:
    return money.to_cents(F.col(name)).alias(out or f"{name}_cents")


def stamp(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def big(c: Column, name: str) -> Column:
    return c.cast("bigint").alias(name)


def line_no() -> Column:
    """An item's place in its order; the other fields of ``ord`` only break ties."""
    return F.col("ord.l_linenumber").cast("bigint").alias("line_no")


def centers(t: Tables) -> DataFrame:
    return t.rules(bindings.CENTERS, "center string, branch string, erp_code string, source string")


def branch_sources(t: Tables) -> DataFrame:
    return t.rules(bindings.BRANCH_SOURCES, "branch string, source string")


def credit_sources(t: Tables) -> DataFrame:
    return t.rules(bindings.CREDIT_SOURCES, "branch string, source string")


def contacts(t: Tables) -> DataFrame:
    return t.rules(bindings.CONTACTS, "branch string, target string, name string")


# ---------------------------------------------------------------- sources

@query
def scan_order_items(t):
    return tables.all_items(t.items).select(
        "branch", "order_no", "sku", "price", "quantity", "quantity_prepared", "product_name",
        *[c for c in HEADER_FIELDS if c != "branch"], "coordinates", stamp("collected_at"))


@query
def scan_erp_clients(t):
    return tables.erp_clients(t.erp_clients)


@query
def scan_erp_open_orders(t):
    return tables.erp_open_orders(t.erp_orders)


@query
def scan_erp_receivables_sum(t):
    return tables.receivables_sum(t.erp_receivables).select("codcli", cents("valor"))


@query
def multi_source_union(t):
    def of(source):
        return lambda: tables.as_text(t.erp_clients.where(F.col("source") == source),
                                      "codcli", "cgcent")
    return tables.multi_source_union({b: of(s) if s else None
                                      for b, s in bindings.BRANCH_SOURCES})


def registry_labels(t: Tables) -> DataFrame:
    return shaping.to_labels(t.registry.drop("consultado_em"), REGISTRY_LABELS)


@query
def scan_registry_csv(t):
    folder = new_folder(t.spark, "registry-csv")
    landed = registry_labels(t)
    # Two exports with their columns in different orders, one with a further column.
    even = F.pmod(F.xxhash64("CNPJ"), F.lit(2)) == 0
    landed.where(even).write.csv(f"{folder}/a", header=True)
    other = landed.where(~even).select(*landed.columns[::-1]).withColumn("Extra", F.lit("x"))
    other.write.csv(f"{folder}/b", header=True)
    read = files.registry_csv(t.spark, f"{folder}/*").select(*landed.columns)
    return shaping.rename_labels(read, REGISTRY_LABELS)


@query
def scan_order_csvs(t):
    folder = new_folder(t.spark, "order-csv")
    wanted = ["Numero Pedido", "SKU", "Preço", "Quantidade Pedida", "Documento", "Cidade/UF",
              "Nome Comercial"]
    landed = shaping.to_labels(t.items, ORDER_LABELS).select(*wanted, "branch")
    (landed.write.partitionBy("branch").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(folder, header=True))
    read = files.order_csvs(t.spark, folder, name_glob="*.csv")
    return shaping.rename_labels(read, ORDER_LABELS)


@query
def scan_sent_registry(t):
    folder = new_folder(t.spark, "sent-json")
    outbox.write_sent_registry(t.queue, folder)
    return files.sent_registry(t.spark, folder, on_corrupt="fail")


@query
def scan_company_json(t):
    folder = new_folder(t.spark, "company-json")
    t.company_json.select("doc").write.text(folder)
    docs = files.company_json(t.spark, folder)
    return docs.select(F.get_json_object("doc", "$.taxId").alias("cnpj"),
                       F.get_json_object("doc", "$.company.name").alias("nome"))


@query
def explode_ledger_json(t):
    folder = new_folder(t.spark, "ledger-json")
    user, day = F.col("codcli").cast("bigint"), F.date_format("ts", "yyyy-MM-dd")
    entry = F.struct(day.alias("ultima_saudacao"), F.date_format("ts", "HH:mm:ss").alias("horario"),
                     F.create_map(day, F.array(F.col("codcli"), (user + 1).cast("string")))
                     .alias("clientes"))
    t.credit_events.select(F.to_json(F.create_map("branch", entry))).write.text(folder)
    return files.explode_ledger(files.ledger_documents(t.spark, folder))


@query
def scan_listing_snapshot(t):
    return t.listing.select("branch", "pos", "order_no", "order_date", "delivery_date",
                            "responsible", "order_total")


@query
def scan_detail_snapshot(t):
    return t.details.select(
        "branch", "order_no", "status", "center",
        F.get(F.try_element_at("labels", F.lit("Tax ID")), F.lit(1)).alias("tax_text"),
        big(F.size("labels"), "labels"), big(F.size("items"), "items"))


# ------------------------------------------------------- sinks and mutations

def incoming(t: Tables) -> DataFrame:
    return t.items


@query
def insert_ignore_items(t):
    new = state.insert_ignore_items(t.stored_items, incoming(t))
    return new.select("branch", "order_no", "sku", "price", "quantity", "trade_name", "phone_2")


@query
def upsert_company(t):
    key = F.col("c_custkey")
    batch = t.raw("customer").where(key % 4 >= 2).select(
        F.when(key % 37 != 0, bindings.k14(key)).alias("cnpj"),
        F.concat(F.lit("Nova "), bindings.text(key)).alias("nome"),
        F.when(key % 2 == 0, "Suspensa").alias("status"))
    # Every third company is there twice; the greater name is the last.
    twice = batch.unionByName(batch.where("substr(cnpj, 14) % 3 = 0").withColumn("nome", F.lit("A")))
    new = state.upsert_company(t.registry, twice, t.as_of, ["nome"])
    return new.select("cnpj", "nome", "nome_fantasia", "status", "ie_status", stamp("consultado_em"))


@query
def delete_inactive(t):
    captured = t.rules([("north", True), ("south", False)], "branch string, complete boolean")
    return state.delete_inactive(t.items, captured, t.listing).select("branch", "order_no", "sku")


@query
def update_codcli(t):
    codes = erp.codcli_lookup(t.items, t.erp_clients, branch_sources(t))
    # Some orders have a smaller code in another branch, too.
    other = codes.where("order_no % 4 = 0").select("order_no", F.lit("outlet").alias("branch"),
                                                   F.lit("").alias("codcli"))
    return state.update_codcli(t.items, codes.unionByName(other)).select("order_no", "sku", "codcli")


@query
def delete_orders(t):
    rejected = jobs.cpf_reject_candidates(t.items, reject_centers(t))
    return state.delete_orders(t.items, rejected).select("order_no", "sku")


@query
def mark_dispatched(t):
    done = t.headers.where("o_orderstatus = 'P'").select(
        F.explode(F.array(F.concat(F.lit(" "), "order_no"), F.col("order_no"))).alias("order_no"),
        t.as_of.alias("sent_at"))
    return state.mark_dispatched(t.queue, done).select("order_no", stamp("sent_at"))


@query
def drain_queue(t):
    prepared = t.headers.where("o_orderstatus = 'P'")
    return state.drain_queue(t.queue, prepared).select("order_no", stamp("sent_at"))


@query
def ledger_upsert_greeting(t):
    return ledger.upsert_greetings(t.ledger, t.credit_events.where("event_type = 'error'"))


@query
def ledger_insert_client(t):
    return ledger.insert_clients(t.ledger, t.credit_events)


@query
def sent_registry_write(t):
    return outbox.sent_registry_lines(t.queue)


@query
def schema_evolve(t):
    old = t.items.drop("codcli")
    new = shaping.ensure_columns(shaping.ensure_columns(old, ["codcli"]), ["codcli", "contact_3"])
    return new.select("order_no", "sku", "codcli", "contact_3", "center")


@query
def orders_json(t):
    docs = dashboard.orders_json(dashboard.orders_grouped(t.items))
    return docs.select(
        "order_no", "kind", line_no(), *[F.get_json_object("doc", f"$.{c}").alias(c)
                                    for c in ("order_total", "trade_name", "sku", "price")])


@named("outbox")
def outbox_rows(t):
    return outbox.outbox(_routed(t), _credit_messages(t)).select(
        "target", "key", "text", "kind", "seq", line_no())


# ------------------------------------------------------ projections, filters

@query
def rename_labels(t):
    labelled = shaping.to_labels(t.items, ORDER_LABELS)
    return labelled.select("Numero Pedido", "SKU", "Preço", "Centro de Distribuição", "branch")


@query
def rename_columns(t):
    return shaping.rename_labels(registry_labels(t), REGISTRY_LABELS).select(
        "cnpj", "nome", "nome_fantasia", "status", "ie_status")


@query
def drop_columns(t):
    kept = shaping.drop_columns(t.registry, ["status", "ie_status", "arquivo"])
    return shaping.drop_columns(kept, ["consultado_em", "uf"], strict=True)


@query
def add_literal(t):
    return shaping.add_literal(t.raw("orders").select("o_orderkey"), "filial", "north")


@query
def upper_columns(t):
    return shaping.upper_columns(t.items.select("order_no", "sku", "branch"))


@query
def fill_trade_name(t):
    return t.registry.select("cnpj", F.coalesce("nome_fantasia", "nome").alias("nome_fantasia"))


@query
def payment_code(t):
    return t.items.select("order_no", "sku", shaping.payment_code(
        F.col("payment"), rules.PAYMENT_CODES).alias("payment"))


@query
def center_code(t):
    by_branch = t.items.select("order_no", "sku", "center", F.when(
        F.col("center").isin("CD-0", "CD-1"), "A").otherwise("B").alias("branch"))
    return shaping.center_code(by_branch, centers(t))


@query
def doc_from_labels(t):
    return t.details.select("order_no", extract.document_of(capture.texts_of("Tax ID"))
                            .alias("document"))


@query
def state_reg_from_labels(t):
    return t.details.select("order_no", extract.state_registration_of(capture.texts_of("Tax ID"))
                            .alias("state_reg"))


@query
def address_split(t):
    return _headers(t).select("order_no", "street", "city_uf", "zip", "coordinates")


@query
def contacts_split(t):
    return _headers(t).select("order_no", "phone_1", "phone_2", "email_1", "email_2")


def _headers(t: Tables) -> DataFrame:
    listing = capture.dedupe_listing(t.listing).withColumns(
        {"payment": F.lit("listed"), "status": F.lit("listed"), "email_1": F.lit("listed"),
         "trade_name": F.lit("listed")})
    return capture.order_headers(listing, t.details)


@query
def header_fallback(t):
    return _headers(t).select("order_no", "payment", "status", "center", "trade_name",
                              "business_id", "account_id", "order_total")


@query
def explode_items(t):
    return capture.explode_items(_headers(t)).select(
        "order_no", "item_pos", "sku", "product_name", "price", "quantity", "status").withColumn(
        "item_pos", F.col("item_pos").cast("bigint"))


@query
def filter_status_active(t):
    return t.registry.where(F.col("status") == rules.ACTIVE_STATUS).select("cnpj", "status")


def reject_centers(t: Tables) -> DataFrame:
    return t.rules(bindings.REJECT_CENTERS, "center string")


@query
def filter_centers(t):
    return jobs.in_centers(t.items, reject_centers(t)).select("order_no", "sku", "center")


@query
def personal_document(t):
    return t.items.where(text.is_personal_document(F.col("document"))).select(
        "order_no", "sku", "document")


@query
def filter_state(t):
    states = t.rules(bindings.BRANCH_STATES, "branch string, uf string, source string")
    return t.registry.join(states, "uf").select("cnpj", "uf", "branch")


@query
def company_problem(t):
    return registry.company_problems(t.registry)


@query
def credit_predicate(t):
    key = F.col("c_custkey")
    rows = t.raw("customer").select(
        key, bindings.cents("c_acctbal").alias("available_cents"), (key * 500).alias("total_cents"),
        F.when(key % 20 == 0, "S").when(key % 20 == 1, F.lit(None)).otherwise("N").alias("blocked"))
    return rows.where(credit.is_short(F.col("available_cents"), F.col("total_cents"),
                                      F.col("blocked")))


@query
def business_hours(t):
    return t.credit_events.select("event_id", clock.business_hours(F.col("ts")).alias("open"))


@query
def point_lookup(t):
    found = dashboard.orders_grouped(dashboard.point_lookup(t.items, " 77 "))
    return found.select("order_no", "kind", line_no(), "sku", "trade_name")


@query
def search_orders(t):
    return dashboard.search_orders(dashboard.order_list(t.items), " CPF ", "north").select(
        "order_no", "document", "branch")


@query
def valid_tax_number(t):
    cleaned = text.clean_tax_punct(F.col("account_id"))
    return t.headers.select("order_no", text.valid_tax_number(cleaned).alias("valid"))


@query
def pending_status(t):
    heads = routing.order_heads(t.items, "status")
    return jobs.rejectable(heads).select("order_no", "status")


@query
def pending_preparation(t):
    heads = routing.order_heads(t.items, "status")
    translated = heads.withColumn("status", F.when(F.col("status") == "Entregue", "To be prepared")
                                  .otherwise(F.col("status")))
    return jobs.preparable(translated).select("order_no", "status")


@query
def drop_null_match(t):
    problems = registry.company_problems(t.registry)
    accounts = routing.order_heads(t.items, "account_id").withColumnRenamed("account_id", "cnpj")
    return problems.join(accounts, "cnpj", "left").where("order_no IS NOT NULL").select(
        "cnpj", "order_no")


# ------------------------------------------------------------------- joins

@query
def codcli_lookup(t):
    return erp.codcli_lookup(t.items, t.erp_clients, branch_sources(t))


@query
def registry_erp_match(t):
    states = t.rules(bindings.BRANCH_STATES, "branch string, uf string, source string")
    return erp.registry_erp_match(t.registry, t.erp_clients, states)


@query
def fiscal_pending_orders(t):
    return registry.fiscal_pending_orders(t.items, t.registry)


@query
def fiscal_pending_orders_clean(t):
    return registry.fiscal_pending_orders(t.items, t.registry, clean_key=True)


@query
def clients_with_debt(t):
    return erp.clients_with_debt(t.erp_clients, t.erp_receivables).select(
        "source", "codcli", "cliente", cents("valor"))


@query
def erp_presence_join(t):
    heads = routing.order_heads(t.items, "center")
    return erp.erp_presence_join(heads, t.erp_orders)


@query
def exclude_orders_in_erp(t):
    return erp.exclude_orders_in_erp(routing.order_heads(t.items, "center"), t.erp_orders)


@query
def order_client_join(t):
    requests = credit.credit_requests(t.items, centers(t))
    known = erp.clients_per_branch(t.erp_clients, credit_sources(t))
    return credit.order_client_join(requests, known).select(
        "branch", "doc_key", "order_no", "codcli", "bloqueio")


@query
def new_orders(t):
    return capture.new_orders(capture.dedupe_listing(t.listing), t.stored_items).select(
        "branch", "order_no", "pos")


@query
def unknown_companies(t):
    return registry.unknown_companies(t.items, t.registry)


@query
def not_sent(t):
    return routing.not_sent(t.headers.select("order_no", "branch"), t.queue)


@query
def not_notified_today(t):
    requests = t.credit_events.select("branch", "codcli", F.to_date("ts").alias("day")).distinct()
    return ledger.not_notified(requests, t.ledger)


@query
def greeted_today(t):
    days = t.credit_events.select("branch", F.to_date("ts").alias("day")).distinct()
    return ledger.greeted(days, t.ledger)


@query
def route_match(t):
    city = text.upper_trim_city(F.col("city_uf"))
    return routing.order_heads(t.items, "city_uf").select(
        "order_no", routing.matches_any(city, bindings.REGIONAL).alias("regional"),
        routing.matches_any(city, bindings.INTERIOR).alias("interior"))


@query
def source_dedup(t):
    return erp.clients_per_branch(t.erp_clients, branch_sources(t)).select(
        "branch", "source", "codcli")


# ------------------------------------------------------------ aggregations

@query
def orders_grouped(t):
    return dashboard.orders_grouped(t.items).select(
        "order_no", "kind", line_no(), *HEADER_FIELDS, "sku", "price", "quantity")


@query
def orders_grouped_flat(t):
    return dashboard.flat_orders(t.items).select(
        "order_no", line_no(), "sku", "product_name", "price", "quantity", "quantity_prepared",
        "trade_name", "document", "order_total")


@query
def order_documents(t):
    folder = new_folder(t.spark, "documents")
    documents.write_documents(t.items, folder, compression="gzip")
    order, items = F.col("order"), F.col("order")[documents.ITEMS_KEY]
    return documents.read_documents(t.spark, folder).select(
        order["Numero Pedido"].alias("order_no"), order["Nome Comercial"].alias("trade_name"),
        order["Total Pedido"].alias("order_total"), big(F.size(items), "items"),
        items[0]["SKU"].alias("first_sku"), F.element_at(items, -1)["Preco"].alias("last_price"))


def _gap(t: Tables, **options) -> DataFrame:
    return credit.credit_gap(t.items, t.erp_clients, t.erp_receivables, centers(t),
                             credit_sources(t), payments=rules.PAYMENT_CODES, **options)


@query
def credit_gap(t):
    return _gap(t).select("codcli", cents("total"), "payment", "branch")


@query
def credit_gap_all_orders(t):
    return _gap(t, grain="order").select("codcli", cents("total"), "payment", "branch")


@query
def credit_gap_without_erp_orders(t):
    return _gap(t, erp_orders=t.erp_orders).select("codcli", cents("total"), "payment", "branch")


@query
def credit_rejected_totals(t):
    return credit.rejected_totals(t.items)


@query
def receivables_sum(t):
    return tables.receivables_sum(t.erp_receivables, ("source", "codcli")).select(
        "source", "codcli", cents("valor"))


@query
def order_stats(t):
    return dashboard.order_stats(t.items).select("orders", cents("value"))


@query
def order_stats_us(t):
    return dashboard.order_stats(t.items, "us").select("orders", cents("value"))


@query
def orders_per_branch(t):
    return dashboard.orders_per_branch(t.items)


@query
def last_update(t):
    return dashboard.last_update(t.items)


@query
def distinct_orders(t):
    return capture.stored_orders(t.items.where("branch = 'north'")).select("order_no")


@query
def distinct_companies(t):
    return registry.order_companies(t.items)


@query
def known_companies(t):
    return t.registry.select("cnpj")


@query
def queue_orders(t):
    return t.queue.select("order_no")


@query
def any_eligible(t):
    return routing.any_eligible(t.items, t.queue, bindings.REGIONAL, bindings.INTERIOR)


@query
def order_message_lines(t):
    return routing.order_message_lines(t.items).select("order_no", line_no(), F.col("line").alias("text"))


@query
def run_counts(t):
    items = settle(t.items.select("order_no", "account_id"), "run")
    return dashboard.run_counts({
        "items": items, "orders": items.select("order_no").distinct(),
        "companies": registry.order_companies(items),
        "unknown companies": registry.unknown_companies(items, t.registry),
        "company problems": registry.company_problems(t.registry),
        "queue": t.queue})


@query
def branch_cards(t):
    return dashboard.branch_cards(t.items, branch_sources(t))


@query
def order_number_list(t):
    return dashboard.order_number_list(t.items)


@query
def items_per_order(t):
    return dashboard.items_per_order(t.items)


# -------------------------------------------- windows, sort, limit, set ops

@query
def first_row_per_order(t):
    return picking.first_rows(t.items, ["order_no"], ["ord"]).select("order_no", "sku", "price")


@query
def first_row_per_document(t):
    rows = t.items.withColumn("doc", text.doc_number(F.col("document")))
    return picking.first_rows(rows, ["branch", "doc"], ["order_no", "ord"]).select(
        "branch", "doc", "order_no", "sku")


@query
def dedupe_listing(t):
    return capture.dedupe_listing(t.listing).select("branch", "order_no", "pos")


@query
def first_value_header(t):
    return routing.order_heads(t.items, "trade_name", "responsible", "sku", "phone_2")


@query
def sort_orders(t):
    return t.headers.select("order_no", "order_total").orderBy("order_no")


@query
def paginate(t):
    page = dashboard.paginate(dashboard.order_list(t.items), 3)
    return page.select("order_no", "trade_name", "page", "pages", "first", "last", "total")


@query
def paginate_clamped(t):
    page = dashboard.paginate(dashboard.order_list(t.items), 10**9)
    return page.select("order_no", "trade_name", "page", "pages", "first", "last", "total")


@query
def paginate_late(t):
    """A page behind the early ones: every row gets its place."""
    page = dashboard.paginate(dashboard.order_list(t.items), dashboard.EARLY_PAGES + 1)
    return page.select("order_no", "trade_name", "page", "pages", "first", "last", "total")


@query
def paginate_stored(t):
    folder = new_folder(t.spark, "pages")
    heads = dashboard.order_list(t.items).select("order_no", "trade_name")
    paging.write_ranges(heads, folder)
    return paging.page_of(t.spark, folder, heads.schema, 3)


@query
def search_orders_indexed(t):
    folder, heads = new_folder(t.spark, "search"), settle(dashboard.order_list(t.items), "heads")
    search.write_index(heads, folder)
    return search.search_indexed(heads, folder, " CPF ", "north").select(
        "order_no", "document", "branch")


@query
def exists_limit_1(t):
    days = t.credit_events.select("branch", F.to_date("ts").alias("day")).distinct()
    hit = ledger.greeted(days, t.ledger).withColumn("greeted", F.lit(True))
    return days.join(hit, ["branch", "day"], "left").select(
        "branch", "day", F.coalesce("greeted", F.lit(False)).alias("greeted"))


@query
def union_by_name(t):
    north = t.headers.where("branch = 'north'").select("order_no", "codcli")
    south = t.headers.where("branch = 'south'").select("city_uf", "order_no")
    return tables.union_all([north, south])


@query
def difference(t):
    return t.listing.select("branch", "order_no").subtract(
        t.stored_items.select("branch", "order_no"))


@query
def distinct(t):
    return t.items.select("account_id").distinct()


# -------------------------------------------------------- scalar functions

@query
def digits_only(t):
    return t.items.select("order_no", "sku", text.digits_only(F.col("document")).alias("digits"))


@query
def clean_tax_punct(t):
    return t.items.select("order_no", "sku", text.clean_tax_punct(F.col("account_id")).alias("tax"))


@query
def parse_money_br(t):
    return t.items.select("order_no", "sku", cents_of(money.parse_money_br(F.col("price")), "br"))


@query
def parse_money_us(t):
    return t.items.select(
        "order_no", "sku", cents_of(money.parse_money_us(F.col("price")), "us"),
        cents_of(money.parse_money_us(F.col("payment"), "zero"), "zero"))


def cents_of(c: Column, name: str) -> Column:
    return money.to_cents(c).alias(f"{name}_cents")


@query
def to_number_or_zero(t):
    return t.items.select("order_no", "sku", big(money.to_number_or_zero(F.col("quantity")), "quantity"))


@query
def doc_number(t):
    return t.items.select("order_no", "sku", text.doc_number(F.col("document")).alias("doc_number"))


@query
def doc_type(t):
    return t.items.select("order_no", "sku", text.doc_type(F.col("document")).alias("doc_type"))


@query
def format_document(t):
    return t.items.select("order_no", "sku", text.format_document(F.col("document")).alias("document"))


@query
def clean_phone(t):
    return t.items.select("order_no", "sku", text.clean_phone(F.col("phone_1")).alias("phone_1"),
                          text.clean_phone(F.col("phone_2")).alias("phone_2"))


@query
def format_date_br(t):
    return t.items.select("order_no", "sku", text.format_date_br(F.col("order_date")).alias("ordered"),
                          text.format_date_br(F.col("delivery_date")).alias("delivery"))


@query
def format_brl(t):
    amount = (bindings.cents("c_acctbal") / 100).cast(money.MONEY)
    return t.raw("customer").select("c_custkey", money.format_brl(amount).alias("shown"))


@query
def format_total(t):
    return t.items.select("order_no", "sku", money.format_total(F.col("order_total")).alias("total"),
                          money.format_total(F.col("quantity")).alias("quantity"))


@query
def payment_family(t):
    return t.items.select("order_no", "sku", display.payment_family(F.col("payment")).alias("family"))


@query
def payment_badge(t):
    return t.items.select("order_no", "sku", display.payment_badge(F.col("payment")).alias("badge"))


@query
def status_badge(t):
    return t.items.select("order_no", "sku", display.status_badge(F.col("status")).alias("badge"))


@query
def unit_price(t):
    price = money.parse_money_us(F.col("price"), "zero")
    quantity = money.to_number_or_zero(F.col("quantity"))
    return t.items.select("order_no", "sku", F.col("ord.l_linenumber").alias("line"),
                          cents_of(money.unit_price(price, quantity), "unit"),
                          (quantity == 0).alias("zero_quantity"))


@query
def fixed2(t):
    price = (bindings.cents("c_acctbal") / 100).cast(money.MONEY)
    return t.raw("customer").select("c_custkey", money.fixed2(price).alias("shown"))


@query
def day_greeting(t):
    return t.credit_events.select(
        "event_id", F.concat(clock.day_greeting(F.col("ts")), F.lit("!")).alias("plain"),
        clock.day_greeting(F.col("ts"), F.col("codcli")).alias("named"))


@query
def upper_trim_city(t):
    return t.headers.select("order_no", text.upper_trim_city(F.col("city_uf")).alias("city"))


@query
def time_text(t):
    return t.credit_events.select("event_id", clock.time_text(F.col("ts")).alias("at"))


@query
def null_to_dash(t):
    return t.headers.select("order_no", text.null_to_dash(F.col("trade_name")).alias("trade_name"),
                            text.null_to_dash(F.col("document")).alias("document"))


@query
def key_text(t):
    padded = t.raw("orders").select(F.concat(F.lit(" \t"), bindings.text("o_orderkey"), F.lit("\n"))
                                    .alias("raw"), "o_custkey")
    return padded.select(text.key_text(F.col("raw")).alias("order_no"),
                         text.key_text(F.col("o_custkey")).alias("codcli"))


# ---------------------------------------------------- JSON, arrays, patterns

@query
def flatten_company(t):
    return registry.flatten_company(t.company_json)


def _record(t: Tables) -> DataFrame:
    return registry.parse_records(t.company_json)


@query
def join_phones(t):
    return _record(t).select("asked", registry.join_phones().alias("telefone"))


@query
def join_emails(t):
    return _record(t).select("asked", registry.join_emails().alias("email"))


@query
def join_activities(t):
    return _record(t).select("asked", registry.join_activities().alias("atividades"))


@query
def first_registration(t):
    return registry.flatten_company(t.company_json).select(
        "cnpj", "ie_estado", "ie_numero", "ie_status", "ie_tipo", "ie_data_status")


@query
def ocr_fix(t):
    return t.invoice_text.select("order_no", extract.ocr_fix(F.col("body")).alias("body"))


@query
def extract_tax_ids(t):
    return t.invoice_text.select("order_no", extract.first_tax_id(F.col("body")).alias("cnpj"),
                                 big(F.size(extract.tax_ids(F.col("body"))), "found"))


@query
def extract_total(t):
    return t.invoice_text.select("order_no", extract.last_total(F.col("body")).alias("total"))


@query
def extract_access_key(t):
    return t.invoice_text.select("order_no",
                                 extract.first_access_key(F.col("body")).alias("access_key"))


@query
def extract_from_documents(t):
    """The extraction over whole free texts, which mostly hold no invoice at all."""
    body = F.col("text")
    return t.raw("documents").select(
        "doc_id", extract.first_tax_id(body).alias("cnpj"),
        extract.first_access_key(body).alias("access_key"),
        F.length(extract.ocr_fix(body)).cast("bigint").alias("chars"))


@query
def labels_slice(t):
    values = capture.texts_of(capture.PHONE_LABEL)
    return t.details.select("order_no", big(F.size(values), "texts"),
                            F.array_join(values, "|").alias("phones"))


# --------------------------------------------------------- composite jobs

@query
def reconcile_snapshot(t):
    """The whole cycle, from listing and detail pages on which all prices could be read."""
    new = jobs.reconcile(t.stored_items.drop("ord"), t.listing, t.whole_details, t.captured)
    return new.select("branch", "order_no", "sku", "price", "quantity")


def _bucketed(t: Tables) -> DataFrame:
    return bucketed.store(t.stored_items, f"items_{uuid.uuid4().hex}")


@query
def reconcile_bucketed(t):
    batch = t.order_items.where("o_orderstatus = 'P'").drop("o_orderkey", "o_orderstatus")
    new = bucketed.reconcile_rows(_bucketed(t), t.listing, batch, t.captured, f"items_{uuid.uuid4().hex}")
    return new.select("branch", "order_no", "sku", "price", "quantity")


@query
def insert_ignore_bucketed(t):
    """The stored items, and the batch's rows that they do not hold."""
    stored = _bucketed(t)
    new = stored.drop("_slot").unionByName(bucketed.fresh_items(stored, incoming(t)), allowMissingColumns=True)
    return new.select("branch", "order_no", "sku", "price", "quantity", "trade_name", "phone_2")


@query
def reconcile_pages(t):
    new = jobs.reconcile(t.stored_items.drop("ord"), t.listing, t.details, t.captured)
    return new.select("branch", "order_no", "sku", "quantity", "state_reg", "responsible")


@query
def cpf_reject_candidates(t):
    return jobs.cpf_reject_candidates(t.items, reject_centers(t)).select(
        "order_no", "center", "document", "payment", "order_total", "trade_name", "responsible")


@query
def fiscal_reject_candidates(t):
    return jobs.fiscal_reject_candidates(t.items, t.registry).select("order_no", "cnpj")


@query
def company_backfill(t):
    new = jobs.company_backfill(t.items, t.registry, t.company_json, t.as_of)
    return new.select("cnpj", "nome", "nome_fantasia", "status", "cidade", "uf", "ie_status",
                      stamp("consultado_em"))


@query
def route_orders(t):
    return routing.route_orders(t.items, t.queue, bindings.REGIONAL, bindings.INTERIOR)


@query
def route_orders_default_cities(t):
    return routing.route_orders(t.items, t.queue, rules.REGIONAL_CITIES, rules.INTERIOR_CITIES)


@query
def route_orders_rules(t):
    patterns = [("regional", p) for p in bindings.REGIONAL] + [("interior", p) for p in bindings.INTERIOR]
    return routing.route_orders_by_rules(t.items, t.queue, t.rules(patterns, "list string, pattern string"))


def _credit_messages(t: Tables) -> DataFrame:
    return credit.credit_outbox(_gap(t), contacts(t), t.credit_ledger, t.as_of)


@query
def credit_outbox(t):
    return _credit_messages(t)


@query
def credit_ledger_after(t):
    """The ledger once the outbox was delivered: greetings and notices recorded from
    the table of delivered messages."""
    sent = settle(_credit_messages(t), "delivered").withColumn("ts", t.as_of)
    greeted = ledger.upsert_greetings(t.credit_ledger, sent.where("kind = 'greeting'"))
    return ledger.insert_clients(greeted, sent.where("kind = 'request'"))


@query
def credit_message(t):
    total = (bindings.cents("o_totalprice") / 100).cast(money.MONEY)
    return t.raw("orders").select("o_orderkey", credit.credit_message(
        bindings.text("o_custkey"), total, F.lit("QR")).alias("text"))


@query
def order_message(t):
    return routing.order_messages(t.items).select("order_no", "kind", line_no(), "text")


def _routed(t: Tables) -> DataFrame:
    return routing.routed_outbox(t.items, t.queue, "chat-regional", t.as_of, bindings.REGIONAL,
                                 bindings.INTERIOR)


@query
def routed_outbox(t):
    return _routed(t).select("target", "seq", "kind", "order_no", line_no(), "text")


@query
def queue_routed(t):
    return routing.queue_routed(t.queue, _routed(t), t.as_of).select("order_no", stamp("sent_at"))


@query
def queue_progress(t):
    prepared = jobs.preparable(routing.order_heads(t.items, "status"))
    return state.drain_queue(t.queue, prepared).select("order_no")


@query
def dashboard_view(t):
    return dashboard.dashboard_view(t.items, "cpf", "", 2)


@query
def dashboard_columns(t):
    return dashboard.display_columns(dashboard.order_list(t.items))


# ----------------------------------------------------------------- streams

def _in_turn(t: Tables, purpose: str, each, *batches: DataFrame, places: bool = False) -> None:
    """Run ``each`` over the batches in this order, as a stream of landed files."""
    streams.run_in_turn(batches, new_folder(t.spark, purpose), new_folder(t.spark, "checkpoint"), each, places)


def _halves(df: DataFrame, key: str) -> list[DataFrame]:
    half = F.pmod(F.xxhash64(key), F.lit(2))
    return [df.where(half == i) for i in (0, 1)]


@query
def stream_insert_ignore(t):
    out = new_folder(t.spark, "insert-ignore")
    # The second batch brings the orders of the first again, with other values.
    early = F.pmod(F.xxhash64("order_no"), F.lit(2)) == 0
    again = t.items.withColumns({c: F.when(early, F.lit("late")).otherwise(F.col(c))
                                 for c in ("price", "quantity", "phone_2")})
    _in_turn(t, "items-in", streams.insert_ignore_batches(out), t.items.where(early), again, places=True)
    return streams.stored_items(t.spark, out, again.schema).rows().select(
        "order_no", "sku", "price", "quantity", "phone_2")


@query
def stream_daily_once_watermark(t):
    """With a watermark: state of past days is dropped, and so are very late notices."""
    out = new_folder(t.spark, "daily-once")
    source = t.spark.readStream.schema(t.raw("events").schema).option(
        "pathGlobFilter", "events.parquet").parquet(t.folder)
    events = source.select(
        F.concat(F.lit("B"), (F.col("user_id") % 5).cast("string")).alias("branch"),
        F.col("user_id").cast("string").alias("codcli"), F.col("ts").cast("timestamp").alias("ts"))
    (streams.daily_once(events).writeStream.option("checkpointLocation",
                                                   new_folder(t.spark, "checkpoint"))
     .trigger(availableNow=True).format("parquet").start(out).awaitTermination())
    return t.spark.read.parquet(out).select("branch", "codcli", F.to_date("day").alias("day"))


def _daily_once(t: Tables, *batches: DataFrame) -> DataFrame:
    out = new_folder(t.spark, "daily-once-exact")
    _in_turn(t, "events-in", streams.daily_once_batches(out), *batches)
    return streams.stored_notices(t.spark, out).rows().select("branch", "codcli", "day")


@query
def stream_daily_once(t):
    # Keys of the first batch come again in the second.
    odd = F.pmod(F.xxhash64("codcli"), F.lit(3)) < 2
    return _daily_once(t, t.credit_events.where(odd), t.credit_events)


@query
def stream_daily_once_timed(t):
    """With timers: the later half of the notices comes first, and all days are in the ledger."""
    out, landed = new_folder(t.spark, "daily-once-timed"), new_folder(t.spark, "events-in")
    events, checkpoint = t.credit_events, new_folder(t.spark, "checkpoint")
    middle = events.agg(F.timestamp_micros(
        ((F.unix_micros(F.min("ts")) + F.unix_micros(F.max("ts"))) / 2).cast("long")).alias("ts")).first().ts
    for half in (events.where(F.col("ts") >= middle), events):
        half.write.mode("append").parquet(landed)
        once = streams.daily_once_timed(t.spark.readStream.schema(events.schema).parquet(landed), "20 years")
        (once.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .format("parquet").start(out).awaitTermination())
    return t.spark.read.schema(once.schema).parquet(out)


@query
def stream_daily_once_exact(t):
    return _daily_once(t, *_halves(t.credit_events, "ts"))


@query
def stream_snapshot_reconcile(t):
    out = new_folder(t.spark, "snapshots")
    items = t.order_items.where("o_orderstatus = 'P'").drop("o_orderkey", "o_orderstatus")
    listed = t.listing.groupBy("branch").agg(F.count("*").alias("listed"))
    rows = tables.union_all([
        items.withColumn("kind", F.lit("item")),
        t.listing.select("branch", "order_no", "pos").withColumn("kind", F.lit("listing")),
        t.captured.join(listed, "branch", "left").withColumn("kind", F.lit("captured"))])
    # One branch first, then both: its orders are met again.
    _in_turn(t, "snapshots-in", streams.snapshot_batches(out, t.stored_items),
             rows.where("branch = 'north'"), rows, places=True)
    latest = streams.current_table(t.spark, out, t.stored_items.schema)
    return latest.select("branch", "order_no", "sku", "price", "quantity")


@query
def stream_order_stats_changes(t):
    """Totals kept by deltas: orders come with other values, go, and come as they are."""
    out = new_folder(t.spark, "order-totals")
    after = t.headers.select("order_no", "branch", "collected_at",
                             money.parse_money_us(F.col("order_total")).alias("value"))
    third = F.pmod(F.xxhash64("order_no"), F.lit(3)) == 0
    before = after.where(~third).unionByName(after.where(third).withColumns({
        "value": F.col("value") + 1, "collected_at": F.col("collected_at") + F.expr("interval 1 year")}))
    first = before.withColumn("change", F.lit(1).cast("bigint"))
    _in_turn(t, "changes-in", views.totals_batches(out), first.where("branch = 'north'"),
             first.where("branch <> 'north'"), views.signed_changes(before, after).select(*first.columns))
    return views.totals(t.spark, out).select("branch", "orders", cents("value"), stamp("last_update"))


@query
def stream_order_stats(t):
    out = new_folder(t.spark, "order-stats")
    heads = t.headers.select("branch", "collected_at", money.parse_money_us(F.col("order_total"))
                             .alias("value"))
    landed, checkpoint = new_folder(t.spark, "headers-in"), new_folder(t.spark, "checkpoint")
    for half in _halves(heads, "collected_at"):
        half.write.mode("append").parquet(landed)
        stats = streams.order_stats_stream(t.spark.readStream.schema(heads.schema).parquet(landed))
        (stats.writeStream.outputMode("complete").trigger(availableNow=True)
         .option("checkpointLocation", checkpoint)
         .foreachBatch(streams.latest_batches(out)).start().awaitTermination())
    versions = t.spark.read.parquet(out)
    last = versions.withColumn("_last", F.max("version").over(Window.partitionBy("branch")))
    return last.where("version = _last").select(
        "branch", "orders", cents("value"), stamp("last_update"))
