"""The dispatch ledger: who was greeted or notified on which day."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.clock import time_text
from orderloom.rules import GREETING_CODE
from orderloom.schemas import LEDGER_SCHEMA

KEYS = ["branch", "codcli", "sent_day"]


def _rows(events: DataFrame, code: Column, greeted: bool) -> DataFrame:
    """Events (branch, codcli, ts) as ledger rows, one per key and partial
    aggregation first: the latest greeting, or the earliest notice."""
    pick = F.max if greeted else F.min
    return (events.select("branch", code.cast("string").alias("codcli"),
                          F.to_date("ts").alias("sent_day"), "ts")
            .groupBy(*KEYS).agg(pick("ts").alias("_ts"))
            .select(*KEYS, time_text(F.col("_ts")).alias("sent_time"),
                    (F.col("sent_day") if greeted else F.lit(None).cast("date"))
                    .alias("greeted_day")))


def upsert_greetings(ledger: DataFrame, greetings: DataFrame) -> DataFrame:
    """Greeting per (branch, day): inserted, or its time refreshed."""
    new = _rows(greetings, F.lit(GREETING_CODE), True)
    kept = ledger.select(*LEDGER_SCHEMA.names).join(new.select(*KEYS), KEYS, "left_anti")
    return kept.unionByName(new)


def insert_clients(ledger: DataFrame, notices: DataFrame) -> DataFrame:
    """Notice per (branch, customer, day): the first one stays."""
    new = _rows(notices, F.col("codcli"), False)
    return ledger.select(*LEDGER_SCHEMA.names).unionByName(
        new.join(ledger.select(*KEYS), KEYS, "left_anti"))


def not_notified(requests: DataFrame, ledger: DataFrame, day: str = "day") -> DataFrame:
    """Requests (branch, codcli, day) without a ledger row of that day."""
    done = ledger.select("branch", "codcli", F.col("sent_day").alias(day))
    return requests.join(done, ["branch", "codcli", day], "left_anti")


def greeted(branches: DataFrame, ledger: DataFrame, day: str = "day") -> DataFrame:
    """(branch, day) rows that already had their greeting."""
    done = ledger.where("greeted_day IS NOT NULL").select(
        "branch", F.col("greeted_day").alias(day)).distinct()
    return branches.join(done, ["branch", day], "left_semi")
