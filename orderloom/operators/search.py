"""Search by an index of character grams.

The index has a row (gram, order_no) for each distinct run of 3 characters in the searched fields of an
order's row, and for the 2 and the 1 at a field's end, so that a gram begins at every place. It is stored
in partitions by a hash of the gram, with a row per gram and its number of rows. A search looks up the
few rarest grams of the needle, or all that begin with a shorter one, opens only their partitions,
intersects the orders and checks the needle itself on what is left, so it finds what a scan finds,
for needles of any length.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.dashboard import SEARCHED, search_orders

LONGEST = 3
PARTS = 64
#: Grams of a long needle that are looked up, the rarest ones.
LOOKED_UP = 4


def _part(gram: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(parts)).cast("int")


def grams(orders: DataFrame) -> DataFrame:
    """(gram, order_no): the distinct grams of each row. An order of several rows may have a gram
    more than once; the look-up counts different grams, so no row is shuffled to drop these."""
    def of(text: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
        return F.when(F.length(text) > 0, F.transform(places, lambda i: F.substr(text, i, F.lit(LONGEST)))).otherwise(
            F.array())

    every = F.concat(*[of(F.lower(F.coalesce(c, F.lit("")))) for c in SEARCHED])
    return orders.select(F.explode(F.array_distinct(every)).alias("gram"), "order_no")


def write_index(orders: DataFrame, folder: str, parts: int = PARTS) -> None:
    """Build the index of the orders below a folder."""
    found = grams(orders).withColumn("part", _part(F.col("gram"), parts))
    (found.hint("rebalance", "part").sortWithinPartitions("part", "gram")
     .write.mode("overwrite").partitionBy("part").parquet(f"{folder}/grams"))
    stored = orders.sparkSession.read.schema("gram string, part int").parquet(f"{folder}/grams")
    (stored.groupBy("part", "gram").agg(F.count("*").alias("orders")).hint("rebalance", "part")
     .write.mode("overwrite").partitionBy("part").parquet(f"{folder}/counts"))


def _in_parts(df: DataFrame, wanted: list[str], parts: int) -> DataFrame:
    """The rows of some grams; other partitions are not opened."""
    hit = [(_part(F.lit(g), parts) == F.col("part")) & (F.col("gram") == g) for g in wanted]
    return df.where(reduce(lambda a, b: a | b, hit))


def candidates(spark: SparkSession, folder: str, needle: str, parts: int = PARTS) -> DataFrame:
    """Numbers of the orders that have the rarest grams of a needle, which is not empty."""
    counts = spark.read.schema("gram string, orders long, part int").parquet(f"{folder}/counts")
    index = spark.read.schema("gram string, order_no string, part int").parquet(f"{folder}/grams")
    if len(needle) < LONGEST:
        begins = F.startswith("gram", F.lit(needle))
        # At most as many rows as there are partitions.
        held = [r.part for r in counts.where(begins).select("part").distinct().collect()]
        return index.where(F.col("part").isin(held) & begins).select("order_no").distinct()
    own = sorted({needle[i:i + LONGEST] for i in range(len(needle) - LONGEST + 1)})
    # One row per gram of the needle.
    known = {r.gram: r.orders for r in _in_parts(counts, own, parts).collect()}
    rarest = sorted(own, key=lambda g: (known.get(g, 0), g))[:LOOKED_UP]
    return (_in_parts(index, rarest, parts).groupBy("order_no").agg(F.count_distinct("gram").alias("_n"))
            .where(F.col("_n") == len(rarest)).select("order_no"))


def search_indexed(orders: DataFrame, folder: str, query: str = "", branch: str = "",
                   parts: int = PARTS) -> DataFrame:
    """``search_orders`` by the index that was built of these orders."""
    needle = query.strip().lower()
    if not needle:
        return search_orders(orders, query, branch)
    hit = candidates(orders.sparkSession, folder, needle, parts)
    return search_orders(orders.join(hit, "order_no", "left_semi"), query, branch)
