"""Picking first rows and cutting groups, safe for keys that hold most rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from orderloom.session import settle

def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
               by_hash: bool = False) -> DataFrame:
    """The first whole row of each key, nulls forming one group like any value.

    ``row_number() = 1`` lets Spark keep one row per key *before* the shuffle
    (WindowGroupLimit), so a key with a third of all rows ships one row per task.
    ``by_hash`` sorts on a 64-bit hash of the keys first, which is much faster for text
    keys with common beginnings; the result is then not partitioned by the keys, so a
    later join on them shuffles the (few) first rows again.
    """
    lead = [F.xxhash64(*keys)] if by_hash else []
    first = F.row_number().over(Window.partitionBy(*lead, *keys).orderBy(*order))
    return df.withColumn("_rank", first).where("_rank = 1").drop("_rank")


def lookup_groups(df: DataFrame, keys: Sequence[str]) -> GroupedData:
    """Group the unique side of a join whose other side may have hot keys.

    Grouped by the keys alone, this side would lend the join its partitioning, and Spark
    splits a skewed join partition only where both sides come straight from a shuffle.
    With the hash as a further key the (small) result is shuffled once more for the join.
    """
    return df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys)


def first_filled_value(value: str | Column, order: str | Column) -> Column:
    """Aggregate: the first value that is not null, by order."""
    value = F.col(value) if isinstance(value, str) else value
    order = F.col(order) if isinstance(order, str) else order
    return F.min_by(value, F.when(value.isNotNull(), order))


def positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Number all rows from 0 in a global order without a single-task sort.

    Rows are range-sorted and settled, so a row keeps its partition for good. Only
    the row counts per partition (one row each) are summed in one place.
    """
    row = F.monotonically_increasing_id()
    placed = settle(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_row", row), "positions")
    placed = placed.withColumn("_part", F.shiftright("_row", 33))
    before = F.coalesce(F.sum("_rows").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = (placed.groupBy("_part").agg(F.count("*").alias("_rows"))
              .select("_part", before.alias("_before")))
    # One row per shuffle partition, so its size is bounded by the session settings.
    local = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_before") + local)
            .drop("_row", "_part", "_before"))
