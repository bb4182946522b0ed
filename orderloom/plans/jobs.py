"""Composite jobs over the order tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import is_personal_document
from orderloom.operators import capture, registry, state
from orderloom.operators.picking import first_rows, lookup_groups
from orderloom.rules import PENDING_FOR_PREPARATION, PENDING_FOR_REJECTION


def captured_items(listing: DataFrame, details: DataFrame, items: DataFrame) -> DataFrame:
    """Item rows of the listed orders that are not stored yet."""
    fresh = capture.new_orders(capture.dedupe_listing(listing), items)
    return capture.explode_items(capture.order_headers(fresh, details))


def reconcile(items: DataFrame, listing: DataFrame, details: DataFrame, captured: DataFrame,
              order: str = "ord") -> DataFrame:
    """One capture cycle: store the items of new orders, first write wins, then drop
    the orders of completely captured branches that are not listed any more."""
    batch = captured_items(listing, details, items)
    if order not in batch.columns:
        place = [c for c in ("pos", "item_pos") if c in batch.columns]
        batch = batch.withColumn(order, F.struct(*place))
    return _reconciled(items, batch, listing, captured, order)


def reconcile_rows(items: DataFrame, listing: DataFrame, batch: DataFrame, captured: DataFrame,
                   order: str = "ord", stored: DataFrame | None = None) -> DataFrame:
    """The same cycle for item rows that were captured and exploded already. ``items`` may be
    some branches of the table; ``stored`` is then the whole, for its keys."""
    keys = ["branch", "order_no"]
    seen = (listing.select(*keys, F.lit(True).alias("listed"))
            .unionByName(items.select(*keys, F.lit(False).alias("listed"))))
    # Listed and never stored; both sides are reduced to their keys before the shuffle.
    fresh = lookup_groups(seen, keys).agg(F.bool_and("listed").alias("fresh")).where("fresh")
    wanted = batch.join(fresh, keys, "left_semi")
    return _reconciled(items, wanted, listing, captured, order, stored)


def _reconciled(items: DataFrame, batch: DataFrame, listing: DataFrame, captured: DataFrame,
                order: str, stored: DataFrame | None = None) -> DataFrame:
    """Stored items without the inactive ones, and the new items. New items belong to
    listed orders, which are never inactive, so only the stored ones are tested."""
    added = state.fresh_items(items if stored is None else stored, batch, order).select(
        *[c for c in batch.columns if c in items.columns])
    kept = state.delete_inactive(items, captured, listing)
    return kept.unionByName(added, allowMissingColumns=True)


def cpf_reject_candidates(items: DataFrame, centers: DataFrame) -> DataFrame:
    """First row of each order with a personal document in one of the centres."""
    return first_rows(in_centers(items, centers).where(is_personal_document(F.col("document"))),
                      ["order_no"], ["ord"])


def in_centers(items: DataFrame, centers: DataFrame) -> DataFrame:
    """Items of the listed distribution centres; the list is configuration."""
    return items.join(centers.select("center"), "center", "left_semi")


def pending(orders: DataFrame, statuses: list[str]) -> DataFrame:
    """Orders that are still to be prepared by their latest captured status."""
    return orders.where(F.col("status").isin(statuses))


def rejectable(orders: DataFrame) -> DataFrame:
    return pending(orders, PENDING_FOR_REJECTION)


def preparable(orders: DataFrame) -> DataFrame:
    return pending(orders, PENDING_FOR_PREPARATION)


def fiscal_reject_candidates(items: DataFrame, companies: DataFrame,
                             clean_key: bool = False) -> DataFrame:
    """Orders of companies with a registry problem."""
    return registry.fiscal_pending_orders(items, companies, clean_key)


def company_backfill(items: DataFrame, companies: DataFrame, answers: DataFrame,
                     as_of: Column) -> DataFrame:
    """Registry table after the unknown companies of the orders were looked up.
    ``answers`` holds the requested number as ``asked`` and the JSON text as ``doc``;
    the requested number is the key, so an answer is never asked for twice. Answers
    that are no record count for nothing; of several records of a number the first by its
    text is stored."""
    todo = registry.unknown_companies(items, companies)
    wanted = answers.join(todo.select(F.col("cnpj").alias("asked")), "asked", "left_semi")
    flat = registry.flatten_company(wanted, keep=("asked", "doc"))
    records = flat.withColumn("cnpj", F.col("asked")).drop("asked")
    return state.upsert_company(companies, records, as_of, [F.col("doc")])
