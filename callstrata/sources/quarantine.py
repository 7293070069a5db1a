"""Messages that could not be processed, kept for replay."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callstrata import contract
from callstrata.operators.dedup import hot_final
from callstrata.operators.ingest import (
    DEFAULT_ENVIRONMENT, hot_rejection, hot_rows, map_hot_row,
)
from callstrata.sources.committed import CommittedTable

PARTITIONS = ("parked_day", "reason")
#: Why good messages wait whose rows could not be written.
HOT_FAILED = "hot_write_failed"
CLEARED_SCHEMA = """
    reason STRING, attempts INT, parked_at TIMESTAMP, cleared_at TIMESTAMP, cleared_day STRING
"""


class Quarantine:
    """Parked messages, and when each was cleared."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.table = CommittedTable(
            spark, f"{self.path}/parked", contract.QUARANTINE_SCHEMA, PARTITIONS,
            sort_by=("parked_at",), ranges=("attempts",), options={"compression": "zstd"})
        self.cleared_table = CommittedTable(
            spark, f"{self.path}/cleared", CLEARED_SCHEMA, ("cleared_day",),
            sort_by=("cleared_at",), options={"compression": "zstd"})

    def write(self, rows: DataFrame, write_id: str, batch_id: int = 0) -> None:
        """Park messages with body, reason, cold_written and parked_at."""
        attempts = F.col("attempts") if "attempts" in rows.columns else F.lit(0)
        self.table.write(rows.select(
            "body", "cold_written", "parked_at",
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            attempts.cast("int").alias("attempts"),
            F.date_format("parked_at", "yyyy-MM-dd").alias("parked_day"), "reason",
        ), write_id)

    def rows(self) -> DataFrame:
        """Messages that wait now."""
        return self.table.read()

    def cleared(self) -> DataFrame:
        """Messages that no longer wait, without their bodies."""
        return self.cleared_table.read()

    def withdraw(self, write_id: str) -> None:
        """Take back what a write parked: it went through at another try."""
        self.table.remove(self.table.files(lambda file: file.write_id == write_id))

    def clear(self, files, cleared_at, write_id: str) -> None:
        """Take files out, noting when their messages ceased to wait. Runs again safely."""
        rows = self.table.read(files).withColumn("cleared_at", cleared_at)
        self.cleared_table.write(rows.select(
            "reason", "attempts", "parked_at", "cleared_at",
            F.date_format("cleared_at", "yyyy-MM-dd").alias("cleared_day")), write_id)
        self.table.remove(files)

    def compact(self, *, most: int = 8, settled: float = 3600) -> int:
        """Merge small files. Returns the number of files replaced."""
        return self.table.merge_small(most=most, settled=settled)

    def drop_expired(self, now: datetime, days: int = contract.QUARANTINE_RETENTION_DAYS) -> int:
        """Drop messages parked too long ago, by whole days. Returns the number of days."""
        edge = (now - timedelta(days=days)).strftime("%Y-%m-%d")
        old = self.table.files(lambda file: file.partition("parked_day") < edge)
        if old:
            at = F.lit(now).cast("timestamp")
            self.clear(old, at, f"expired-{uuid.uuid4().hex}")
        return len({file.partition("parked_day") for file in old})


def replay_quarantine(parked: DataFrame, hot: DataFrame,
                      environment: str = DEFAULT_ENVIRONMENT) -> DataFrame:
    """The hot table as it is after parked messages went through ingest again.

    What still fails stays out. A replayed message may already have a row from
    another delivery; the last copy wins as always.
    """
    messages = parked.select(
        "body", F.col("parked_at").alias("received_at"),
        *[name for name in ("batch_id", "delivery") if name in parked.columns])
    replayed = hot_rows(messages, environment)
    return hot_final(hot.unionByName(replayed, allowMissingColumns=True))


def was_cut(payload: Column) -> Column:
    """True where a raw payload bears the mark of truncation."""
    return (payload == contract.OVERSIZED_MARK) | payload.endswith(contract.TRUNCATED_SUFFIX)


def replay_cold(cold_events: DataFrame, hot: DataFrame, received_at,
                environment: str = DEFAULT_ENVIRONMENT) -> DataFrame:
    """Hot rows for archived events that have none, built from the archive.

    The archive does not hold every field; those it lacks take their defaults.
    """
    fit = cold_events.where(hot_rejection().isNull() & F.col("hot_reason").isNull())
    # Distinct first: an id with very many copies then sends few rows to the join.
    missing = fit.join(hot.select("request_id").distinct(), "request_id", "left_anti")
    return archived_rows(missing, received_at, environment)


def archived_rows(events: DataFrame, received_at,
                  environment: str = DEFAULT_ENVIRONMENT) -> DataFrame:
    """Hot rows of archived events. Fields that the archive lacks take their defaults."""
    filled = events.withColumns({
        name: F.lit(None).cast("string")
        for name in contract.WIRE_COLUMNS if name not in events.columns
    }).withColumns({
        "user_id": F.nullif(F.col("user_id"), F.lit("unknown")),
        "payload_truncated": was_cut(F.col("request_payload"))
        | was_cut(F.col("response_payload")),
        "received_at": received_at,
    })
    return map_hot_row(filled, environment)
