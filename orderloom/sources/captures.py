"""Landed captures of order pages: listing rows and detail pages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import strip

LISTING_CELLS = ["order_no", "order_date", "delivery_date", "responsible", "order_total"]


def listing_rows(captured: DataFrame) -> DataFrame:
    """Five trimmed texts per listing row; rows with fewer cells are skipped."""
    cells = [strip(F.get("cells", F.lit(i))).alias(name) for i, name in enumerate(LISTING_CELLS)]
    kept = [c for c in captured.columns if c != "cells"]
    return captured.where(F.size("cells") >= len(LISTING_CELLS)).select(*kept, *cells)


def detail_pages(captured: DataFrame) -> DataFrame:
    """Detail pages with every text trimmed: labels -> texts, and item rows."""
    labels = F.transform_values("labels", lambda _, texts: F.transform(texts, strip))
    items = F.transform("items", lambda i: F.struct(
        strip(i["product_name"]).alias("product_name"), strip(i["sku"]).alias("sku"),
        strip(i["price"]).alias("price"), strip(i["quantity"]).alias("quantity"),
        strip(i["quantity_prepared"]).alias("quantity_prepared")))
    return captured.withColumns({
        "labels": labels, "items": items,
        "status": strip(F.col("status")), "center": strip(F.col("center"))})
