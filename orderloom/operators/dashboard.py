"""Dashboard answers: grouped orders, totals per branch, search, paging."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from orderloom.functions.clock import time_text
from orderloom.functions.display import payment_badge, payment_family, status_badge
from orderloom.functions.money import format_total, parse_money_br, parse_money_us
from orderloom.functions.text import format_date_br, format_document, null_to_dash, strip
from orderloom.operators.picking import first_rows, positions
from orderloom.operators.routing import order_heads
from orderloom.rules import NEVER, PAGE_SIZE, UNKNOWN_BRANCH
from orderloom.schemas import HEADER_FIELDS, ITEM_FIELDS


def orders_grouped(items: DataFrame) -> DataFrame:
    """Orders as rows: (order_no, kind, ord, header fields, item fields).

    Each order has one row of kind ``order`` with the header of its first row, and one of
    kind ``item`` for each item. Sorted by order number, the order row (whose ``ord`` is null)
    first, they are the documents; no key is gathered, so an order may have any size.
    """
    heads = (first_rows(items.select("order_no", "ord", *HEADER_FIELDS), ["order_no"], ["ord"])
             .select("order_no", F.lit("order").alias("kind"), *HEADER_FIELDS))
    rows = items.select("order_no", F.lit("item").alias("kind"), "ord", *ITEM_FIELDS)
    return (heads.unionByName(rows, allowMissingColumns=True)
            .select("order_no", "kind", "ord", *HEADER_FIELDS, *ITEM_FIELDS))


def flat_orders(items: DataFrame) -> DataFrame:
    """One row per item with the header of its order. The heads are shuffled once more for
    the join, so Spark can split an order that holds very many items."""
    heads = first_rows(items.select("order_no", "ord", *HEADER_FIELDS), ["order_no"], ["ord"],
                       by_hash=True).select("order_no", *HEADER_FIELDS)
    return items.select("order_no", "ord", *ITEM_FIELDS).join(heads, "order_no")


def orders_json(grouped: DataFrame) -> DataFrame:
    """The rows of the documents as JSON texts: (order_no, kind, ord, doc)."""
    fields = {"order": HEADER_FIELDS, "item": ITEM_FIELDS}
    texts = [F.when(F.col("kind") == k, F.to_json(F.struct(*f))) for k, f in fields.items()]
    return grouped.select("order_no", "kind", "ord", F.coalesce(*texts).alias("doc"))


def point_lookup(items: DataFrame, order_no: str) -> DataFrame:
    """The items of one order number; cut before anything is grouped."""
    return items.where(strip(F.col("order_no")) == order_no.strip())


def total_of(c: Column, style: str) -> Column:
    return {"br": parse_money_br, "us": parse_money_us}[style](c)


def order_stats(items: DataFrame, style: str = "br") -> DataFrame:
    """Number of orders and the sum of their totals; unreadable totals count zero."""
    heads = order_heads(items, "order_total")
    value = F.coalesce(F.sum(total_of(F.col("order_total"), style)), F.lit(0))
    return heads.agg(F.count("*").alias("orders"), value.cast("decimal(28,2)").alias("value"))


def orders_per_branch(items: DataFrame) -> DataFrame:
    heads = order_heads(items, "branch")
    return (heads.groupBy(F.coalesce("branch", F.lit(UNKNOWN_BRANCH)).alias("branch"))
            .agg(F.count("*").alias("orders")))


def branch_cards(items: DataFrame, branches: DataFrame) -> DataFrame:
    """Order counts of the listed branches, zero where there is none."""
    counts = orders_per_branch(items)
    return (branches.select("branch").join(counts, "branch", "left")
            .select("branch", F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders")))


def last_update(items: DataFrame, column: str = "collected_at") -> DataFrame:
    """Time of the latest capture, or a word for none."""
    return items.agg(F.coalesce(time_text(F.max(column)), F.lit(NEVER)).alias("last_update"))


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_no").agg(F.count("*").alias("items"))


def order_number_list(items: DataFrame) -> DataFrame:
    """All order numbers as rows, and one row with their number (``order_no`` null)."""
    numbers = items.select("order_no").distinct()
    total = numbers.agg(F.count("*").alias("orders"))
    return (total.select(F.lit(None).cast("string").alias("order_no"), "orders")
            .unionByName(numbers.withColumn("orders", F.lit(None).cast("bigint"))))


SEARCHED = ["order_no", "trade_name", "document", "center", "responsible", "codcli"]


def search_orders(orders: DataFrame, query: str = "", branch: str = "") -> DataFrame:
    """Orders with the query in one of the searched fields, of one branch or of all."""
    found = orders.where(F.col("branch") == branch) if branch else orders
    needle = query.strip().lower()
    if not needle:
        return found
    hits = [F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(needle)) for c in SEARCHED]
    return found.where(reduce(lambda a, b: a | b, hits))


#: Pages that are taken as the first rows of the order, without sorting the others.
EARLY_PAGES = 50


def paginate(orders: DataFrame, page: int, size: int = PAGE_SIZE,
             order: Sequence[str] = ("order_no",)) -> DataFrame:
    """Page ``page`` of the orders, clamped to the pages there are, with the numbers
    shown below the table.

    Every row has its place in one total order, ties broken by the other columns, and a
    page is a range of places, wherever it lies. Rows that are equal in all columns are
    interchangeable. An early page lies in the first ``EARLY_PAGES`` pages, of which only so
    many rows leave a task; for later ones all rows are put in order. A table whose pages are
    read often is better kept in order (``paging``).
    """
    keys = [*order, *(c for c in orders.columns if c not in order)]
    if page <= EARLY_PAGES:
        place = F.row_number().over(Window.orderBy(*keys)).cast("bigint") - 1
        placed = orders.orderBy(*keys).limit(max(page, 1) * size).withColumn("position", place)
        total = orders.agg(F.count("*").alias("total"))
    else:
        placed = positions(orders, keys)
        total = placed.agg(F.coalesce(F.max("position") + 1, F.lit(0)).alias("total"))
    numbers = total.select("total", F.ceil(F.col("total") / size).cast("bigint").alias("pages"))
    numbers = numbers.withColumn("page", F.greatest(F.lit(1), F.least(F.lit(page), F.col("pages"))))
    known = numbers.select(F.struct("total", "pages", "page")).scalar()
    first = (known["page"] - 1) * size
    return (placed.where((F.col("position") >= first) & (F.col("position") < first + size))
            .withColumns({k: v.cast("bigint") for k, v in {
                "page": known["page"], "pages": known["pages"],
                "first": F.least(first + 1, known["total"]),
                "last": F.least(known["page"] * size, known["total"]),
                "total": known["total"]}.items()}).drop("position"))


def order_list(items: DataFrame) -> DataFrame:
    """One header row per order, for search and paging."""
    return order_heads(items, *HEADER_FIELDS)


def display_columns(orders: DataFrame) -> DataFrame:
    """Orders as the dashboard table shows them."""
    return orders.select(
        "order_no", format_date_br(F.col("order_date")).alias("ordered"),
        null_to_dash(F.col("trade_name")).alias("customer"), "branch",
        F.coalesce("codcli", F.lit("")).alias("codcli"),
        format_document(F.col("document")).alias("document"),
        null_to_dash(F.col("center")).alias("center"),
        format_date_br(F.col("delivery_date")).alias("delivery"),
        payment_family(F.col("payment")).alias("payment"),
        payment_badge(F.col("payment")).alias("payment_class"),
        status_badge(F.col("status")).alias("status_class"),
        format_total(F.col("order_total")).alias("total"))


def dashboard_view(items: DataFrame, query: str = "", branch: str = "", page: int = 1) -> DataFrame:
    """Search, page and format in one go."""
    found = search_orders(order_list(items), query, branch)
    return display_columns(paginate(found, page))


def run_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows per stage, observed while one job runs through all of them.

    Stages that share their input should read it from one settled table; then nothing is computed
    again to be counted. A stage is observed where its last task runs, whose metrics count
    once however often the task is repeated.
    """
    spark = next(iter(stages.values())).sparkSession
    seen = {name: Observation() for name in stages}
    rows = [df.select(F.lit(1).alias("row")).observe(seen[name], F.count(F.lit(1)).alias("rows"))
            for name, df in stages.items()]
    reduce(lambda a, b: a.unionByName(b), rows).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(name, o.get["rows"]) for name, o in seen.items()],
                                 "stage string, rows long")
