"""Jobs that bring back what ingest could not store, and can stop at any point."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, functions as F

from callstrata import contract
from callstrata.operators.dedup import latest_copy
from callstrata.operators.ingest import hot_rejection
from callstrata.session import bounded_tasks, fresh_path
from callstrata.sources.cold import BROADCAST_BYTES
from callstrata.sources.files import drop_folder
from callstrata.sources.quarantine import archived_rows
from callstrata.streaming.ingest import Archive

#: A message found unfit this often stays parked until someone looks at it.
MOST_ATTEMPTS = 5


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def replay_parked(archive: Archive, reasons: tuple[str, ...] | None = None,
                  at: datetime | None = None) -> int:
    """Ingest parked messages again and clear them. Returns how many were taken up.

    The run claims the files that wait now; messages parked meanwhile are for the next
    run. They go through ingest as a batch named after the run, into cold, hot and
    rollup; what is still unfit is parked anew, with one attempt more. Then the claimed
    files are taken out in one commit. A run that died is taken up where it stopped: each
    step replaces what it did before. A second run finds nothing to do.
    """
    table = archive.quarantine.table
    run = archive.ledger.under_way("parked")
    if run is None:
        claimed = table.files(lambda file: file.meets("attempts", high=MOST_ATTEMPTS - 1)
                              and (reasons is None or file.partition("reason") in reasons))
        if not claimed:
            return 0
        run = archive.ledger.claim("parked", files=[file.path for file in claimed],
                                   messages=sum(file.rows for file in claimed),
                                   at=str(at or _now()))
    paths = set(run["files"])
    files = table.files(lambda file: file.path in paths)
    if run["state"] == "claimed":
        messages = table.read(files).select(
            "body", F.col("parked_at").alias("received_at"),
            (F.col("attempts") + 1).alias("attempts"))
        archive.ingest(messages, 0, source=f"replay-{run['run']}")
        archive.ledger.advance(run, "written")
    if files:
        archive.quarantine.clear(files, F.lit(run["at"]).cast("timestamp"),
                                 f"replay-{run['run']}")
    archive.ledger.finish(run)
    return run["messages"]


def _days(first: str, last: str) -> list[str]:
    """Days `yyyy/MM/dd` from first to last."""
    start, end = (datetime.strptime(day, "%Y/%m/%d") for day in (first, last))
    return [(start + timedelta(days=n)).strftime("%Y/%m/%d")
            for n in range((end - start).days + 1)]


def missing_events(archive: Archive, days: list[str], vendor_id: str | None = None) -> DataFrame:
    """Metadata of archived events of some days that the hot table lacks, one per object.

    Only metadata of these days and that vendor is read, and of the hot table only the
    ids in files that may hold these days."""
    rows = archive.cold.metadata(vendor_id, days)
    fit = latest_copy(
        rows.where(hot_rejection().isNull() & F.col("hot_reason").isNull()),
        ["s3_request_key"], [F.asc("request_id")])
    first = datetime.strptime(min(days), "%Y/%m/%d")
    last = datetime.strptime(max(days), "%Y/%m/%d") + timedelta(days=1)
    hot = archive.hot.between("created_at", first, last).select("request_id").distinct()
    return fit.join(hot, "request_id", "left_anti")


def rebuild_hot(archive: Archive, first_day: str, last_day: str, vendor_id: str | None = None,
                received_at: datetime | None = None) -> int:
    """Append hot and rollup rows for archived events that have none, from the archive.

    `first_day` and `last_day` are UTC days `yyyy/MM/dd`. First the narrow metadata tells
    which events are missing; they are stored, as the run's claim. Where they are few by
    their bytes, as after an outage, they are sent to all tasks and the payload documents
    are read past them without a shuffle; else both sides are dealt out by event. A run
    that died is taken up with the events it claimed. Returns the number of events.
    """
    spark = archive.hot.spark
    run = archive.ledger.under_way("cold")
    if run is None:
        path = fresh_path(spark, "missing-events")
        days = _days(first_day, last_day)
        with bounded_tasks(spark, archive.cold.index.rows(days)):
            missing_events(archive, days, vendor_id).write.parquet(path)
        size = spark.read.parquet(path).agg(
            F.count("*").alias("n"),
            F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")).first()
        if not size["n"]:
            drop_folder(spark, path)
            return 0
        run = archive.ledger.claim(
            "cold", missing=path, days=days, vendor_id=vendor_id, events=size["n"],
            bytes=size["bytes"], at=str(received_at or _now()))
    if run["state"] == "claimed":
        missing, few = spark.read.parquet(run["missing"]), run["bytes"] <= BROADCAST_BYTES
        whole = archive.cold.with_payloads(missing, run["vendor_id"], run["days"], few=few)
        rows = archived_rows(whole, F.lit(run["at"]).cast("timestamp"), archive.environment)
        write_id = f"cold-replay-{run['run']}"
        # where they are many, all documents of these days are dealt out with them
        dealt = run["events"] if few else archive.cold.index.rows(run["days"])
        with bounded_tasks(spark, dealt):
            archive.hot.write(rows, write_id, 0, run["events"])
        archive.rollup.add(archive.hot.table.read(archive.hot.table.files(
            lambda file: file.write_id == write_id)), write_id)
        archive.ledger.advance(run, "written")
    drop_folder(spark, run["missing"])
    archive.ledger.finish(run)
    return run["events"]
