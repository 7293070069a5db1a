"""Ingest from two sources, and replays over stored tables, with SQL twins."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from callstrata import contract
from callstrata.operators.dedup import hot_final
from callstrata.plans.alerts import alert_quarantine_level as quarantine_level
from callstrata.session import fresh_path
from callstrata.sources.hot import HotTable
from callstrata.sources.quarantine import HOT_FAILED
from callstrata.streaming.ingest import Archive
from callstrata.streaming.replay import rebuild_hot, replay_parked
from callstrata.verification.archive import OUTAGE, REBUILT_SQL, during_outage
from callstrata.verification.messages import hot_row_select, messages, over_wire
from callstrata.verification.registry import Registry
from callstrata.verification.rollups import ROLLUP_SQL

registry = Registry()
QUERIES, SQL = registry.queries, registry.sql
query = registry.query

_HOT_SQL = f"SELECT {', '.join(contract.HOT_COLUMNS)} FROM ({hot_row_select()})"
_DURING = f"BETWEEN TIMESTAMP '{OUTAGE[0]}' AND TIMESTAMP '{OUTAGE[1]}'"


class _Down(HotTable):
    """A hot table that cannot be written."""

    def write(self, *_, **__):
        raise OSError("the hot table is down")


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "landing")
    messages(spark, sf_dir).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


_TWO: dict[tuple[str, str], Archive] = {}


def two_sources(spark: SparkSession, sf_dir: str) -> Archive:
    """Two sources deliver batches of the same numbers; one has every second message."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TWO:
        archive = Archive.at(spark, fresh_path(spark, "archive"))
        landed = _landed(spark, sf_dir)
        odd = F.xxhash64("body", "delivery") % 2 != 0
        for batch, half in ((0, F.hour("received_at") % 2 == 0), (1, F.hour("received_at") % 2 == 1)):
            for source, part in (("first", odd), ("second", ~odd)):
                archive.ingest(landed.where(half & part).drop("delivery"), batch, source=source)
        _TWO[key] = archive
    return _TWO[key]


@query(over_wire(_HOT_SQL))
def ingest_two_sources(spark, sf_dir):
    """Hot rows of every delivery, from both sources."""
    return two_sources(spark, sf_dir).hot.raw().select(*contract.HOT_COLUMNS)


@query(over_wire("""SELECT request_id, count(*) AS objects FROM (
    SELECT DISTINCT request_id, coalesce(vendor_id, '') AS vendor_id, endpoint, user_id,
      CASE WHEN created_at = 'not-a-date' THEN CAST(CAST(ingested_at AS DATE) AS VARCHAR)
           ELSE CAST(CAST(event_time AS DATE) AS VARCHAR) END AS day
    FROM w WHERE reason IS NULL OR reason NOT IN ('unparseable', 'unsupported_version'))
    GROUP BY request_id"""))
def ingest_two_sources_cold(spark, sf_dir):
    """What one source archived, the other does not archive again."""
    return two_sources(spark, sf_dir).cold.metadata().groupBy("request_id").agg(
        F.count("*").alias("objects"))


_OUTAGES: dict[tuple[str, str], Archive] = {}


def after_outage(spark: SparkSession, sf_dir: str) -> Archive:
    """For an hour the hot table cannot be written; parked messages are then replayed,
    twice."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OUTAGES:
        archive = Archive.at(spark, fresh_path(spark, "archive"), park_hot_failures=True)
        down = replace(archive, hot=_Down(spark, archive.hot.path))
        landed, failed = _landed(spark, sf_dir).drop("delivery"), during_outage("received_at")
        archive.ingest(landed.where(~failed), 0, source="queue")
        down.ingest(landed.where(failed), 1, source="queue")
        for _ in range(2):
            replay_parked(archive, (HOT_FAILED,), datetime(2024, 1, 2))
        _OUTAGES[key] = archive
    return _OUTAGES[key]


@query(over_wire(_HOT_SQL))
def replay_quarantine_job(spark, sf_dir):
    """No delivery is missing from the stored hot table, and none is there twice."""
    return after_outage(spark, sf_dir).hot.raw().select(*contract.HOT_COLUMNS)


@query(over_wire(f"SELECT * FROM (WITH v AS ({hot_row_select()}) {ROLLUP_SQL})"))
def replay_quarantine_rollup(spark, sf_dir):
    """The rollup counts every delivery once."""
    return after_outage(spark, sf_dir).rollup.merged()


@query(over_wire(f"""SELECT reason, CAST(0 AS INT) AS attempts, 'waits' AS state, count(*) AS messages
    FROM w WHERE reason IS NOT NULL AND reason <> 'unsupported_version' GROUP BY reason
    UNION ALL SELECT 'hot_write_failed', CAST(0 AS INT), 'cleared', count(*) FROM w
    WHERE reason IS NULL AND ingested_at {_DURING}"""))
def replay_quarantine_state(spark, sf_dir):
    """What still waits, and what was cleared."""
    quarantine = after_outage(spark, sf_dir).quarantine

    def counted(rows, state):
        return rows.groupBy("reason", "attempts").agg(F.count("*").alias("messages")).select(
            "reason", "attempts", F.lit(state).alias("state"), "messages")

    return counted(quarantine.rows(), "waits").unionByName(
        counted(quarantine.cleared(), "cleared"))


@query(over_wire(REBUILT_SQL))
def rebuild_hot_from_cold(spark, sf_dir):
    """Hot rows of an hour are lost from the stored table and appended from the archive."""
    archive = Archive.at(spark, fresh_path(spark, "archive"))
    archive.ingest(_landed(spark, sf_dir).drop("delivery"), 0, source="queue")
    hot = archive.hot.table
    hot.replace(hot.files(), hot_final(hot.read()).where(~during_outage("created_at")), "kept")
    for _ in range(2):
        rebuild_hot(archive, "2023/12/31", "2024/01/31", received_at=datetime(2024, 1, 2))
    return archive.hot.raw().select(
        "request_id", "vendor_id", "endpoint", "user_id", "created_at", "status",
        "latency_ms", "request_payload", "response_payload", "payload_truncated",
        "s3_request_key", "mobile_hash")


# The level at every minute of the time, then runs of minutes above zero.
@query(over_wire(f""", c AS (
      SELECT ingested_at AS seen, 1 AS delta FROM w WHERE (reason IS NOT NULL
        AND reason <> 'unsupported_version') OR (reason IS NULL AND ingested_at {_DURING})
      UNION ALL SELECT TIMESTAMP '2024-01-02 00:00:00', -1 FROM w
        WHERE reason IS NULL AND ingested_at {_DURING}),
    m AS (SELECT unnest(generate_series((SELECT date_trunc('minute', min(seen)) FROM c),
      TIMESTAMP '2024-01-03 00:00:00', INTERVAL 1 MINUTE)) AS minute),
    n AS (SELECT minute, (SELECT min(minute) FROM m) AS beginning, sum(coalesce(d, 0)) OVER (
        ORDER BY minute) AS level FROM m LEFT JOIN (SELECT CASE
          WHEN seen = date_trunc('minute', seen) THEN seen
          ELSE date_trunc('minute', seen) + INTERVAL 1 MINUTE END AS minute, sum(delta) AS d
        FROM c GROUP BY 1) USING (minute)),
    s AS (SELECT *, coalesce(max(CASE WHEN level <= 0 THEN minute END) OVER (ORDER BY minute)
        + INTERVAL 1 MINUTE, beginning) AS since FROM n)
    SELECT minute AS window_end, CAST(level AS BIGINT) AS waiting, since AS active_since,
      minute - since >= INTERVAL 5 MINUTE AS firing FROM s WHERE level > 0
      """).replace(") , c AS", "), c AS"))
def alert_quarantine_level(spark, sf_dir):
    """Messages that wait in the stored quarantine, minute by minute, until the third day."""
    quarantine = after_outage(spark, sf_dir).quarantine
    return quarantine_level(quarantine.rows(), quarantine.cleared(),
                            F.lit("2024-01-03 00:00:00").cast("timestamp"))
