"""Table mutations as pure functions: old state and input give the new state."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.text import blank_to_null, key_text, stored_text
from orderloom.operators.picking import first_rows, lookup_groups
from orderloom.schemas import STORED_FIELDS
from orderloom.session import KEPT_CODEC

ITEM_KEYS = ["order_no", "sku"]


def insert_ignore(existing: DataFrame, batch: DataFrame, keys: Sequence[str],
                  order: Sequence[str | Column]) -> DataFrame:
    """Rows of ``batch`` that insert-ignore would add: the first per key, where the
    key is not stored. Of the stored rows only the keys are shuffled."""
    return (first_rows(batch, keys, order)
            .join(existing.select(*keys), list(keys), "left_anti"))


def as_stored(batch: DataFrame) -> DataFrame:
    """Item values as stored: text, and null (or a float NaN) becomes blank."""
    floats = {f.name for f in batch.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}

    def stored(c: str) -> Column:
        value = F.nanvl(F.col(c), F.lit(None)) if c in floats else F.col(c)
        return stored_text(value)

    return batch.withColumns({c: stored(c) for c in STORED_FIELDS if c in batch.columns})


def fresh_items(existing: DataFrame, batch: DataFrame, order: str = "ord") -> DataFrame:
    return insert_ignore(existing, as_stored(batch), ITEM_KEYS, [order])


def insert_ignore_items(existing: DataFrame, batch: DataFrame, order: str = "ord") -> DataFrame:
    """First write wins per (order, sku), whatever the branch."""
    return existing.unionByName(fresh_items(existing, batch, order), allowMissingColumns=True)


def upsert_company(existing: DataFrame, batch: DataFrame, as_of: Column,
                   order: Sequence[str | Column], key: str = "cnpj",
                   stamp: str = "consultado_em") -> DataFrame:
    """Insert or overwrite the columns the batch supplies, nulls included.

    Other columns and the time stamp of a stored company stay; a row without a key
    does nothing. Of several rows of a key the last one by ``order`` wins (a Column is
    given descending), so the table never holds a key twice.
    """
    supplied = [c for c in batch.columns if c in existing.columns and c not in (key, stamp)]
    named = batch.where(blank_to_null(F.col(key)).isNotNull())
    last = first_rows(named, [key], [F.col(c).desc() if isinstance(c, str) else c for c in order])
    new = last.select(F.col(key), F.struct(*supplied).alias("_new"))
    both = existing.join(new, key, "full_outer")
    is_new = F.col("_new").isNotNull()

    def merged(c: str) -> Column:
        if c == key:
            return F.col(key)
        if c in supplied:
            return F.when(is_new, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
        if c == stamp:
            return F.coalesce(F.col(c), as_of).alias(c)
        return F.col(c)

    return both.select(*[merged(c) for c in existing.columns])


def delete_inactive(items: DataFrame, captured: DataFrame, active: DataFrame) -> DataFrame:
    """Drop the items of captured branches whose order is not active.

    ``captured`` holds one row per captured branch with ``complete``; an incomplete
    capture deletes nothing, a complete empty one clears its branch, and branches
    without a capture stay as they are. The items are read and shuffled once, by branch and
    order; a hot order among them can be split, because the active set is grouped for lookup.
    The captured branches are one array, as long as a capture has branches, and never a
    key that items are shuffled by.
    """
    keys = ["branch", "order_no"]
    cleared = captured.where("complete").agg(F.collect_set("branch")).scalar()
    is_cleared = F.coalesce(F.array_contains(cleared, F.col("branch")), F.lit(False))
    alive = lookup_groups(active, keys).agg(F.lit(True).alias("_active")).drop("_hash")
    return (items.join(alive, keys, "left").where(~is_cleared | F.col("_active"))
            .select(*items.columns))


def update_codcli(items: DataFrame, codes: DataFrame) -> DataFrame:
    """Set the customer code on all items of the orders in ``codes``; of several codes of
    an order (it is in several branches) the largest, as text. No item is multiplied."""
    new = lookup_groups(codes, ["order_no"]).agg(
        F.max(F.col("codcli").cast("string")).alias("_codcli")).drop("_hash")
    return (items.join(new, "order_no", "left")
            .withColumn("codcli", F.coalesce("_codcli", "codcli")).select(*items.columns))


def delete_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    return items.join(orders.select("order_no"), "order_no", "left_anti")


def mark_dispatched(queue: DataFrame, orders: DataFrame) -> DataFrame:
    """Insert-ignore into the dispatch queue; the earliest time of an order stays."""
    new = (orders.select(key_text(F.col("order_no")).alias("order_no"), "sent_at")
           .groupBy("order_no").agg(F.min("sent_at").alias("sent_at")))
    return queue.select("order_no", "sent_at").unionByName(
        new.join(queue.select("order_no"), "order_no", "left_anti"))


def drain_queue(queue: DataFrame, prepared: DataFrame) -> DataFrame:
    """The queue without the orders that were prepared."""
    return queue.join(prepared.select("order_no"), "order_no", "left_anti")


def write_version(df: DataFrame, folder: str, version: int, *parts: str) -> None:
    """Write one version of a table to its own folder, partitioned by ``parts``; repeating
    it is harmless."""
    df.write.mode("overwrite").option("compression", KEPT_CODEC).partitionBy(*parts).parquet(f"{folder}/version={version}")
