"""The hot table: redacted rows in Parquet, by month and day of Indian time."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callstrata import contract
from callstrata.functions.filters import time_filter
from callstrata.functions.scalars import hot_day, hot_month
from callstrata.operators.dedup import hot_final
from callstrata.operators.lookups import LOOKUP_COLUMNS
from callstrata.operators.retention import cutoff, expire_payloads, expire_rows
from callstrata.sources.committed import CommittedTable, DataFile

PARTITIONS = ("ist_month", "ist_day")
COMPACTED = "compacted-"
BLOOM_COLUMNS = tuple(name for name in LOOKUP_COLUMNS if name != "status")


def parquet_options(distinct_per_group: int = 1_000_000) -> dict[str, str]:
    """Compression, and bloom filters on the lookup columns for so many values."""
    options = {"compression": "zstd"}
    for name in BLOOM_COLUMNS:
        options[f"parquet.bloom.filter.enabled#{name}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{name}"] = str(distinct_per_group)
    return options


class HotTable:
    """Parquet files below one path. Every write has an id and replaces only itself."""

    def __init__(self, spark: SparkSession, path: str, distinct_per_group: int = 1_000_000):
        self.spark = spark
        self.path = path.rstrip("/")
        self.distinct_per_group = distinct_per_group
        self.options = parquet_options(distinct_per_group)
        self.table = CommittedTable(
            spark, path, contract.HOT_TABLE_SCHEMA, PARTITIONS, sort_by=("created_at",),
            ranges=("created_at", "ingested_at"), options=self.options)

    # -- writing --

    def write(self, rows: DataFrame, write_id: str, batch_id: int = 0,
              size: int | None = None, rebalance: bool = True) -> None:
        """Append a batch; writing the same batch again replaces it. Its `size` in rows,
        if known, bounds the bloom filters: those of a small batch are small. Without
        `rebalance` each task writes its own files, for tasks with many rows of few days;
        `size` is then that of a task."""
        if "batch_id" not in rows.columns:
            rows = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        rows = rows.select(*contract.HOT_COLUMNS, F.col("batch_id").cast("bigint")).withColumns({
            "write_id": F.lit(write_id),
            "ist_month": hot_month(F.col("created_at")),
            "ist_day": hot_day(F.col("created_at")),
        })
        options = None
        if size is not None:
            options = parquet_options(min(self.distinct_per_group, max(size, 1)))
        self.table.write(rows, write_id, options, rebalance)

    # -- reading --

    def raw(self) -> DataFrame:
        """Every stored delivery, as of now."""
        return self.table.read()

    def between(self, column: str, start: datetime | None, end: datetime | None,
                final: bool = False) -> DataFrame:
        """Rows with created_at or ingested_at in a range of times (UTC), both ends
        included. Only files that may hold such rows are read; for ingested_at no folder
        says so. `final` keeps one row per request, as `final` does; copies outside of the
        range count, so it reads the months of the range whole."""
        if column not in self.table.ranges:
            raise ValueError(f"files know the ranges of {', '.join(self.table.ranges)}")
        low, high = (None if at is None else _micros(at) for at in (start, end))
        files = self.table.files(lambda file: file.meets(column, low, high))
        if final:
            months = {file.partition("ist_month") for file in files}
            files = self.table.files(lambda file: file.partition("ist_month") in months)
        rows = self.table.read(files)
        rows = self._deduplicated(rows, files) if final else rows
        return time_filter(rows, column, *(
            None if at is None else F.timestamp_micros(F.lit(at)) for at in (low, high)))

    def final(self) -> DataFrame:
        """One row per request and month: the last copy ingested.

        Months that compaction left without newer writes hold no copies and are
        read as they are; only the others are shuffled.
        """
        files = self.table.files()
        return self._deduplicated(self.table.read(files), files)

    @staticmethod
    def _deduplicated(rows: DataFrame, files: list[DataFile]) -> DataFrame:
        """`rows` of `files` without copies."""
        writes: dict[str, dict[str, set[str]]] = {}
        for file in files:
            writes.setdefault(file.partition("ist_month"), {}).setdefault(
                file.partition("ist_day"), set()).add(file.write_id)
        # Months whose every day holds exactly one write, made by compaction.
        settled = sorted(
            month for month, days in writes.items()
            if all(len(ids) == 1 and min(ids).startswith(COMPACTED) for ids in days.values()))
        if not settled:
            return hot_final(rows)
        if len(settled) == len(writes):
            return rows
        is_settled = F.col("ist_month").isin(settled)
        return hot_final(rows.where(~is_settled)).unionByName(rows.where(is_settled))

    def current(self, now: Column, final: bool = True) -> DataFrame:
        """Rows and payloads as retention leaves them at `now`, to the exact edge."""
        files = self.table.files()
        edge = cutoff(now, contract.ROW_RETENTION_DAYS)
        rows = self.table.read(files).where(
            (F.col("ist_month") >= hot_month(edge)) & (F.col("ist_day") >= hot_day(edge)))
        rows = self._deduplicated(rows, files) if final else rows
        return expire_payloads(expire_rows(rows, now), now)

    # -- maintenance --

    def compact(self, month: str) -> int:
        """Deduplicate a month, rewriting only days that new writes touch.

        A day is rewritten when it has a write since the last compaction, or a
        row whose request came again on another day. All other days have no
        copies. The new files take the old ones' place in one commit: readers
        see each row once, before and after. Writes committed meanwhile stay.
        Returns the number of files replaced.
        """
        files = self.table.files(lambda file: file.partition("ist_month") == month)
        per_day: dict[str, set[str]] = {}
        for file in files:
            per_day.setdefault(file.partition("ist_day"), set()).add(file.write_id)
        touched = {day for day, ids in per_day.items()
                   if len(ids) > 1 or not min(ids).startswith(COMPACTED)}
        if not touched:
            return 0
        untouched = per_day.keys() - touched
        if untouched:
            new, settled = (
                self.table.read([f for f in files if f.partition("ist_day") in days])
                for days in (touched, untouched))
            # At most the days of one month.
            touched |= {row.ist_day for row in settled.join(
                new.select("request_id").distinct(), "request_id", "left_semi")
                .select("ist_day").distinct().collect()}
        old = [file for file in files if file.partition("ist_day") in touched]
        self.table.replace(old, hot_final(self.table.read(old)),
                           f"{COMPACTED}{uuid.uuid4().hex}")
        return len(old)

    def drop_expired(self, now: datetime, days: int = contract.ROW_RETENTION_DAYS) -> int:
        """Drop days that lie wholly past retention, in the hot zone. Returns how many."""
        # A day is wholly past when the cut-off (in UTC) falls on a later local day.
        cut = (now - timedelta(days=days)).replace(tzinfo=timezone.utc)
        edge = cut.astimezone(ZoneInfo(contract.HOT_TIME_ZONE)).strftime("%Y-%m-%d")
        old = self.table.files(lambda file: file.partition("ist_day") < edge)
        self.table.remove(old)
        return len({file.partition("ist_day") for file in old})

    def blank_payloads(self, now: Column, days: int = contract.PAYLOAD_RETENTION_DAYS) -> int:
        """Empty the payloads of old rows by rewriting the files they are in.

        Files already empty stay. The old files still hold the payloads until `vacuum`.
        Returns the number of rewritten rows.
        """
        edge = cutoff(now, days)
        still_full = (
            self.raw().where(
                (F.col("ist_day") <= hot_day(edge)) & (F.col("created_at") <= edge)
                & ((F.col("request_payload") != "") | (F.col("response_payload") != "")))
            .select(F.col("_metadata.file_path").alias("path")).distinct()
        )
        # One row per file, as many as the driver lists anyway.
        marker = "/" + self.path.rsplit("/", 1)[1] + "/"
        full = {unquote(row["path"].rsplit(marker, 1)[1]) for row in still_full.collect()}
        rewritten = 0
        # Files made by compaction stay known as such.
        for compacted in (True, False):
            old = self.table.files(lambda file: file.path in full and compacted
                                   == file.write_id.startswith(COMPACTED))
            if old:
                prefix = COMPACTED if compacted else "blanked-"
                self.table.replace(old, expire_payloads(self.table.read(old), now, days),
                                   f"{prefix}{uuid.uuid4().hex}")
                rewritten += sum(file.rows for file in old)
        return rewritten

    def vacuum(self, grace: float) -> int:
        """Delete files that compaction or retention took out `grace` seconds ago."""
        return self.table.vacuum(grace)


def _micros(at: datetime) -> int:
    """Microseconds since 1970 of a time in UTC."""
    return (at.replace(tzinfo=at.tzinfo or timezone.utc)
            - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
