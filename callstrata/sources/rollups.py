"""The minute rollup as a table of partial sums, one write per batch."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from callstrata import contract
from callstrata.operators.rollup import ROLLUP_KEYS, rollup_1m, rollup_merge
from callstrata.sources.committed import CommittedTable

PARTITIONS = ("rollup_day",)
#: Partials of a batch are merged with others only when it will not be tried again.
SETTLED = 3600


class RollupTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.table = CommittedTable(
            spark, path, contract.ROLLUP_SCHEMA, PARTITIONS, sort_by=ROLLUP_KEYS,
            options={"compression": "zstd"})

    def add(self, hot_rows: DataFrame, write_id: str) -> None:
        """Add the partial sums of newly inserted hot rows."""
        self.table.write(rollup_1m(hot_rows).withColumn(
            "rollup_day", F.date_format("window_start", "yyyy-MM-dd")), write_id)

    def partials(self) -> DataFrame:
        return self.table.read()

    def merged(self) -> DataFrame:
        return rollup_merge(self.partials())

    def compact(self, *, most: int = 8, settled: float = SETTLED) -> int:
        """Merge partial sums of days with many of them. Returns the files replaced."""
        return self.table.merge_small(
            most=most, settled=settled,
            combine=lambda rows: rollup_merge(rows).withColumn(
                "rollup_day", F.date_format("window_start", "yyyy-MM-dd")))

    def drop_expired(self, now: datetime, days: int = contract.ROLLUP_RETENTION_DAYS) -> int:
        edge = (now - timedelta(days=days)).strftime("%Y-%m-%d")
        old = self.table.files(lambda file: file.partition("rollup_day") < edge)
        self.table.remove(old)
        return len({file.partition("rollup_day") for file in old})
