"""Streaming ingest: one micro-batch goes to cold, then hot, then the rollup."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from callstrata import contract
from callstrata.operators.dedup import new_objects
from callstrata.operators.ingest import (
    DEFAULT_ENVIRONMENT, NOT_ARCHIVED, map_hot_row, parse_messages, quarantine_rows,
    skipped_versions, version_gate, with_cold_keys,
)
from callstrata.session import bounded_tasks
from callstrata.sources.cold import ColdArchive
from callstrata.sources.files import staged, together, write_partitions
from callstrata.sources.hot import HotTable
from callstrata.sources.ledger import Ledger
from callstrata.sources.quarantine import HOT_FAILED, Quarantine
from callstrata.sources.rollups import RollupTable


#: Rows of a day that make a file of their own.
ROWS_PER_FILE = 10_000
#: What ingest takes of a message, where it is there.
MESSAGE_COLUMNS = ("body", "received_at", "attempts", "delivery", "batch_id")


@dataclass
class Archive:
    """All tables of one archive below one folder."""

    hot: HotTable
    cold: ColdArchive
    quarantine: Quarantine
    rollup: RollupTable
    ledger: Ledger
    skipped_path: str
    environment: str
    #: Park good messages when their rows cannot be written, instead of failing the batch.
    park_hot_failures: bool = False

    @classmethod
    def at(cls, spark: SparkSession, path: str,
           environment: str = DEFAULT_ENVIRONMENT, *,
           park_hot_failures: bool = False) -> Archive:
        path = path.rstrip("/")
        return cls(
            hot=HotTable(spark, f"{path}/hot"),
            cold=ColdArchive(spark, f"{path}/cold", environment),
            quarantine=Quarantine(spark, f"{path}/quarantine"),
            rollup=RollupTable(spark, f"{path}/rollup"),
            ledger=Ledger(spark, f"{path}/replays"),
            skipped_path=f"{path}/skipped",
            environment=environment,
            park_hot_failures=park_hot_failures,
        )

    def ingest(self, messages: DataFrame, batch_id: int, *, source: str) -> None:
        """Archive one batch of messages: `body` and `received_at`.

        Each write is named after its source and batch and replaces its own earlier
        try, so a batch that failed half-way can simply run again, and batches of
        equal number from two sources do not meet. Bad messages are set aside one by
        one and do not hold up the others. Cold comes before hot.
        """
        if not re.fullmatch(r"[A-Za-z0-9._-]+", source):
            raise ValueError("a source is named by letters, digits, dots and dashes")
        with bounded_tasks(messages.sparkSession):
            self._ingest(messages, batch_id, f"{source}-{batch_id:012d}")

    def _ingest(self, messages: DataFrame, batch_id: int, write_id: str) -> None:
        carried = [name for name in MESSAGE_COLUMNS if name in messages.columns]
        parsed = with_cold_keys(parse_messages(messages.select(*carried)))
        if not self.park_hot_failures:  # the fields of a good message are all that is needed
            parsed = parsed.withColumn("body", F.when(F.col("reason").isNotNull(), F.col("body")))
        with staged(parsed, "batch") as parsed:
            # One row per calendar day and reason: which days to look up, and
            # which tables get rows at all.
            counts = parsed.groupBy("cold_day", "reason").count().collect()
            reasons = {row.reason for row in counts}
            archived = [row for row in counts if row.reason not in NOT_ARCHIVED]
            events = version_gate(parsed)
            good = events.where("reason IS NULL")

            def write_cold() -> None:
                days = [row.cold_day for row in archived]
                size = sum(row["count"] for row in archived)
                known = self.cold.index.known(
                    events.select("s3_request_key"), days, except_write=write_id, size=size)
                with new_objects(events, known, size) as new:
                    self.cold.write(new, write_id)

            def write_skipped() -> None:
                rows = skipped_versions(parsed).withColumn("write_id", F.lit(write_id))
                write_partitions(rows, self.skipped_path, ("write_id",))

            first = [write_cold] if archived else []
            if reasons - {None, "unsupported_version"}:
                first.append(
                    lambda: self.quarantine.write(quarantine_rows(parsed), write_id, batch_id))
            if "unsupported_version" in reasons:
                first.append(write_skipped)
            if first:
                with bounded_tasks(messages.sparkSession, sum(row["count"] for row in counts)):
                    together(messages.sparkSession, *first)
            if None in reasons:
                size = sum(row["count"] for row in counts if row.reason is None)
                days = len({row.cold_day for row in counts if row.reason is None}) + 1
                # tasks with rows for whole files need not exchange them
                tasks = min(parsed.rdd.getNumPartitions(), len(parsed.inputFiles()))
                spread = size < ROWS_PER_FILE * days * tasks
                if not spread:  # about the rows of one task's files
                    size = 2 * -(-size // tasks)
                if self.park_hot_failures:
                    if self._write_hot(good, write_id, batch_id, size, spread):
                        self.rollup.add(counted(good), write_id)
                else:
                    together(
                        messages.sparkSession,
                        lambda: self._write_hot(good, write_id, batch_id, size, spread),
                        lambda: self.rollup.add(counted(good), write_id))

    def _write_hot(self, good: DataFrame, write_id: str, batch_id: int, size: int,
                   spread: bool) -> bool:
        """True once the rows are in. If they cannot be written, and failures are to be
        parked, the messages wait in quarantine: cold has them, and the batch goes on."""
        try:
            self.hot.write(map_hot_row(good, self.environment), write_id, batch_id, size,
                           rebalance=spread)
        except Exception:
            if not self.park_hot_failures:
                raise
            # A commit is all or nothing, so none of the rows is in.
            self.quarantine.write(good.withColumns({
                "reason": F.lit(HOT_FAILED), "cold_written": F.lit(True),
                "parked_at": F.col("received_at")}), f"{write_id}-hot", batch_id)
            return False
        # An earlier try of this batch may have parked them.
        self.quarantine.withdraw(f"{write_id}-hot")
        return True


def counted(good: DataFrame) -> DataFrame:
    """What the rollup needs of good events, with the values that their rows get."""
    return good.withColumns({
        "created_at": F.try_to_timestamp("created_at"),
        **{name: F.coalesce(F.col(name), F.lit(value))
           for name, value in contract.REQUIRED_DEFAULTS.items()},
    })


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint: the same after a restart, another
    one for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"]


def start_ingest(messages: DataFrame, archive: Archive, checkpoint: str, *,
                 every: str | None = "5 seconds") -> StreamingQuery:
    """Run ingest on a stream of bodies; every=None handles what is there and ends.

    A stream of files splits them by the settings of the session that it was read in: keep
    `bounded_tasks` around it while it works on large, compressed files."""

    if "received_at" not in messages.columns:
        # In a stream this is the time of the micro-batch, kept in its log, so a
        # repeated batch gets the same time again.
        messages = messages.withColumn("received_at", F.current_timestamp())

    identity: list[str] = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if not identity:
            identity.append(stream_identity(batch.sparkSession, checkpoint))
        archive.ingest(batch, batch_id, source=identity[0])

    writer = messages.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()
