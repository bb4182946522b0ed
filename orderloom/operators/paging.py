"""Pages of a table that is kept in order.

The table is stored in ranges of one total order with the number of rows of each range. A page is
looked up in these numbers (one row per range) and reads the one or two ranges it lies in; nothing
is sorted but their rows.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from orderloom.rules import PAGE_SIZE


def total_order(columns: Sequence[str], order: Sequence[str]) -> list[str]:
    return [*order, *(c for c in columns if c not in order)]


def _stored(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("_range", IntegerType())])


def write_ranges(rows: DataFrame, folder: str, order: Sequence[str] = ("order_no",)) -> None:
    """Store rows in ranges of the order, ties broken by the other columns, and count them."""
    keys = total_order(rows.columns, order)
    (rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
     .withColumn("_range", F.spark_partition_id())
     .write.mode("overwrite").partitionBy("_range").parquet(f"{folder}/rows"))
    stored = rows.sparkSession.read.schema(_stored(rows.schema)).parquet(f"{folder}/rows")
    (stored.groupBy("_range").agg(F.count("*").alias("rows")).coalesce(1)
     .write.mode("overwrite").parquet(f"{folder}/ranges"))


def page_of(spark: SparkSession, folder: str, schema: StructType, page: int, size: int = PAGE_SIZE,
            order: Sequence[str] = ("order_no",)) -> DataFrame:
    """Page ``page`` of the stored rows, clamped to the pages there are, with its numbers.
    ``schema`` and ``order`` are those the rows were stored with."""
    ranges = spark.read.parquet(f"{folder}/ranges").orderBy("_range").collect()
    total = sum(r.rows for r in ranges)
    pages = -(-total // size)
    page = max(1, min(page, pages))
    first, last = (page - 1) * size, min(page * size, total)
    before, hit, skipped = 0, [], 0
    for r in ranges:
        if before < last and before + r.rows > first:
            hit.append(r["_range"])
            skipped = skipped if len(hit) > 1 else before
        before += r.rows
    stored = spark.read.schema(_stored(schema)).parquet(f"{folder}/rows")
    rows = stored.where(F.col("_range").isin(hit)).select(*schema.names)
    keys = total_order(rows.columns, order)
    place = F.row_number().over(Window.orderBy(*keys))
    # At most ``size`` rows behind the first of the ranges; the limit goes before the window.
    some = rows.orderBy(*keys).limit(last - skipped).withColumn("_place", place)
    return (some.where(F.col("_place") > first - skipped)
            .select(*rows.columns, *[F.lit(v).cast("bigint").alias(k) for k, v in {
                "page": page, "pages": pages, "first": min(first + 1, total), "last": last,
                "total": total}.items()]))
