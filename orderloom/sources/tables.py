"""Order and ERP tables: projected, filtered and summed at the scan."""

from collections.abc import Callable, Mapping
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.money import MONEY
from orderloom.session import settle


def all_items(items: DataFrame, order: str = "ord") -> DataFrame:
    """All order items by order number; equal numbers by source order, which also
    lets the range sort cut a very large order into several tasks."""
    return items.orderBy("order_no", order)


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Project the named columns (matched in any case) as lower-case text columns."""
    return df.select(*[F.col(c).cast("string").alias(c.lower()) for c in columns])


def erp_clients(df: DataFrame) -> DataFrame:
    return as_text(df, "codcli", "cliente", "cgcent", "bloqueio", "limcred")


def erp_open_orders(df: DataFrame) -> DataFrame:
    """ERP orders that carry no order number of ours."""
    return as_text(df.where(F.col("numpedcli").isNull()), "numpedcli")


def is_open(paid: Column) -> Column:
    """A receivable is open while nothing was paid on it."""
    return paid.isNull() | (paid == "0")


def receivables_sum(df: DataFrame, keys: tuple[str, ...] = ("codcli",)) -> DataFrame:
    """Open receivables per customer; partial sums run before the shuffle."""
    return (df.where(is_open(F.col("vpago").cast("string")))
            .groupBy(*keys)
            .agg(F.sum(F.col("valor").cast(MONEY)).alias("valor")))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by column name; a column absent from one frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def multi_source_union(sources: Mapping[str, DataFrame | Callable[[], DataFrame] | None],
                       tag: str = "branch", skip_failed: bool = False) -> DataFrame:
    """The same scan over several sources, each row tagged with its source.

    ``None`` marks a source that is not configured and is left out. A source that
    cannot be opened (no such table, no connection) or whose query fails while it runs fails
    all, unless ``skip_failed`` leaves it out as well; each source is then read once, into
    the shared folder, before the rest goes on.
    """
    frames = []
    for name, source in sources.items():
        if source is None:
            continue
        try:
            df = source() if callable(source) else source
            if skip_failed:
                df = settle(df, "source")
        except (PySparkException, Py4JError, OSError):
            if not skip_failed:
                raise
            continue
        frames.append(df.withColumn(tag, F.lit(name)))
    if not frames:
        raise ValueError("no source is configured")
    return union_all(frames)


def jdbc_table(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
               lower: int = 0, upper: int = 0, partitions: int = 1, **options: str) -> DataFrame:
    """A table in a database. Projection and filters written on the result are pushed to
    the database; give a numeric ``partition_column`` to read in parallel. Drivers and
    credentials come from the caller through ``options``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", partitions))
    return reader.options(**options).load()


def receivables_query(table: str, keys: tuple[str, ...] = ("codcli",)) -> str:
    """The statement of ``receivables_sum`` for a database."""
    names = ", ".join(keys)
    return (f"SELECT {names}, SUM(valor) AS valor FROM {table} "
            f"WHERE vpago IS NULL OR vpago = 0 GROUP BY {names}")


def jdbc_receivables(spark: SparkSession, url: str, table: str, keys: tuple[str, ...] = ("codcli",),
                     **options: str) -> DataFrame:
    """Open receivables per customer, summed by the database: only the sums travel."""
    return (spark.read.format("jdbc").option("url", url)
            .option("query", receivables_query(table, keys)).options(**options).load())
