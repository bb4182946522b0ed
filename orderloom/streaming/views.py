"""Order totals per branch kept by deltas.

Changes are signed rows: an order that appears counts +1, one that goes (or had other values
before) -1. The state has a row per (branch, capture time) with the number and the value of its
orders, and each batch adds its own rows to it; sums of sums are sums, so runs of batches are
put together by adding them up. Counts and values per branch are sums over the state, and
the latest capture is the greatest time that still has orders, so it goes back when orders go.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType, TimestampType

from orderloom.streaming.runs import Runs

KEYS = ["branch", "collected_at"]
TOTALS = StructType([
    StructField("branch", StringType()), StructField("collected_at", TimestampType()),
    StructField("orders", LongType()), StructField("value", DecimalType(38, 2)),
    StructField("bucket", StringType())])
BUCKETS = 16


def signed_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows that turn one table into the other, with ``change`` = times they come or go."""
    both = (after.withColumn("change", F.lit(1))
            .unionByName(before.select(*after.columns).withColumn("change", F.lit(-1))))
    return (both.groupBy(*after.columns).agg(F.sum("change").alias("change")).where("change <> 0"))


def _added_up(rows: DataFrame) -> DataFrame:
    """One row per key; keys that nothing is left of go."""
    return (rows.groupBy(*KEYS, "bucket")
            .agg(F.sum("orders").alias("orders"), F.sum("value").cast("decimal(38,2)").alias("value"))
            .where("orders <> 0 or value <> 0"))


def totals_state(spark: SparkSession, folder: str) -> Runs:
    return Runs(spark, folder, TOTALS, combine=_added_up)


def totals_batches(folder: str) -> Callable[[DataFrame, int], None]:
    """Add a batch of signed header rows (branch, collected_at, value, change). Only the batch is
    read; the rows are added up before the shuffle."""
    def each(batch: DataFrame, batch_id: int) -> None:
        state = totals_state(batch.sparkSession, folder)
        state.prepare(batch_id)
        bucket = F.pmod(F.xxhash64(*KEYS), F.lit(BUCKETS)).cast("string")
        state.write(_added_up(batch.select(
            *KEYS, F.col("change").cast("bigint").alias("orders"),
            (F.coalesce("value", F.lit(0)) * F.col("change")).cast("decimal(38,2)").alias("value"),
            bucket.alias("bucket"))), batch_id)
    return each


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, value and last capture per branch as of the last batch."""
    now = _added_up(totals_state(spark, folder).rows()).where("orders > 0")
    return now.groupBy("branch").agg(
        F.sum("orders").alias("orders"), F.sum("value").cast("decimal(38,2)").alias("value"),
        F.max("collected_at").alias("last_update"))
