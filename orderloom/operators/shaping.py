"""Renames, column sets and literal tags."""

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from orderloom.functions.text import digits_only
from orderloom.rules import ACTIVE_STATUS

def rename_labels(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Display labels -> canonical columns; unknown labels pass through."""
    return df.withColumnsRenamed(dict(labels))


def to_labels(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({column: label for label, column in labels.items()})


def drop_columns(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """Drop columns; absent ones are ignored, or an error when ``strict``."""
    absent = [c for c in columns if c not in df.columns]
    if strict and absent:
        raise ValueError(f"columns not found: {absent}")
    return df.drop(*columns)


def ensure_columns(df: DataFrame, columns: Sequence[str], kind: str = "string") -> DataFrame:
    """Add the missing columns as nulls; running it again changes nothing."""
    absent = {c: F.lit(None).cast(kind) for c in columns if c not in df.columns}
    return df.withColumns(absent) if absent else df


def add_literal(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def recode(c: Column, codes: Mapping[str, str]) -> Column:
    """Exact value mapping; other values stay. The mapping is a short literal."""
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c) if pairs else c


def payment_code(c: Column, codes: Mapping[str, str]) -> Column:
    return recode(c, codes)


def center_code(df: DataFrame, centers: DataFrame) -> DataFrame:
    """Centre names -> ERP codes of the branch, by a small rule table."""
    rules = centers.select("branch", "center", "erp_code")
    return (df.join(rules, ["branch", "center"], "left")
            .withColumn("center", F.coalesce("erp_code", "center")).drop("erp_code"))


def rule_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A configuration table (branches, centres, contacts) from literal rows.

    Spark knows the exact size of such a relation and broadcasts it while it is below
    ``spark.sql.autoBroadcastJoinThreshold``; operators add no hint of their own, so a
    rule table of any other origin is also joined by its real size.
    """
    fields = StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [[] for _ in fields]
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in fields])
    return spark.createDataFrame(pa.table([list(c) for c in columns], schema=arrow), fields)


def prepare_registry(registry: DataFrame) -> DataFrame:
    """Active companies, trade name filled from the legal name, digit-only key."""
    return (registry.where(F.col("status") == ACTIVE_STATUS)
            .withColumn("nome_fantasia", F.coalesce("nome_fantasia", "nome"))
            .withColumn("cnpj", digits_only(F.col("cnpj"))))
