"""Outbox and sent-set sinks."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outbox(*message_sets: DataFrame) -> DataFrame:
    """Message rows of all producers in one table: target, key, text, kind, seq, and
    ``ord`` where a producer's messages have several rows."""
    shaped = [m.select("target", F.col("codcli" if "codcli" in m.columns else "order_no").alias("key"),
                       "text", "kind", "seq", *[c for c in ["ord"] if c in m.columns])
              for m in message_sets]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shaped)


def append_outbox(messages: DataFrame, folder: str) -> None:
    """Append to the outbox table; sending reads from it and is not done here."""
    messages.write.mode("append").parquet(folder)


def sent_registry_lines(sent: DataFrame) -> DataFrame:
    """The sent set, one order number per row, with the JSON array of it: (order_no, doc)."""
    return sent.select("order_no").distinct().withColumn("doc", F.to_json(F.array("order_no")))


def write_sent_registry(sent: DataFrame, folder: str) -> None:
    """Write the sent set sorted, a JSON array of one order number per line;
    ``sources.files.sent_registry`` reads it."""
    sent_registry_lines(sent).orderBy("order_no").select("doc").write.mode("overwrite").text(folder)
