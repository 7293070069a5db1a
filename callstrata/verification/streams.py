"""Streaming queries run to the end of their input, with SQL twins.

Input is written below the shared folder as several files, which the streams
take in several micro-batches.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from callstrata import contract
from callstrata.operators.dedup import latest_copy
from callstrata.session import LARGE_STATE_CONF, bounded_tasks, fresh_path, keep_large_state
from callstrata.sources.audit import stream_audit
from callstrata.sources.rollups import RollupTable
from callstrata.sources.wire import stream_messages
from callstrata.streaming.alert_state import held_alert_stream
from callstrata.streaming.ingest import Archive, start_ingest
from callstrata.streaming.windows import alert_stream, dedup_stream, rollup_stream
from callstrata.verification.alerts import FAILURES_SQL, SQL as BATCH_SQL, windows_sql
from callstrata.verification.archive import ARCHIVED_SQL, AUDIT_SQL, audit_log
from callstrata.verification.messages import hot_row_select, messages, over_wire
from callstrata.verification.panels import over_hot
from callstrata.verification.registry import Registry
from callstrata.verification.rollups import ROLLUP_SQL
from callstrata.verification.sample import hot_events, landed, tasks

registry = Registry()
QUERIES, SQL = registry.queries, registry.sql
query = registry.query

FILES = 4


def finish(stream: StreamingQuery) -> None:
    stream.awaitTermination()


_ARCHIVES: dict[tuple[str, str], Archive] = {}


def streamed_archive(spark: SparkSession, sf_dir: str) -> Archive:
    """The archive that streaming ingest leaves. One run serves all its tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ARCHIVES:
        _ARCHIVES[key] = _stream_into_archive(spark, sf_dir)
    return _ARCHIVES[key]


def _stream_into_archive(spark: SparkSession, sf_dir: str) -> Archive:
    """Bodies land in files and go through streaming ingest."""
    landing, half = landed(spark, messages(spark, sf_dir).select("body"), "text", FILES,
                           compression="gzip")
    archive = Archive.at(spark, fresh_path(spark, "archive"))
    with bounded_tasks(spark):
        finish(start_ingest(stream_messages(spark, landing, max_files=half), archive,
                            fresh_path(spark, "checkpoint"), every=None))
    return archive


@contextmanager
def large_state(spark: SparkSession):
    """Streams that start within keep their state in RocksDB."""
    before = {key: spark.conf.get(key, None) for key in LARGE_STATE_CONF}
    keep_large_state(spark)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hot rows as a stream of files."""
    rows = hot_events(spark, sf_dir).select(*contract.HOT_COLUMNS)
    path, half = landed(spark, rows, "parquet", FILES)
    return (
        spark.readStream.schema(contract.HOT_SCHEMA)
        .option("maxFilesPerTrigger", half)
        .parquet(path)
    )


def run_updates(spark: SparkSession, stream: DataFrame, keys: list[str]) -> DataFrame:
    """Run in update mode into files; the last update of each key is the result."""
    path = fresh_path(spark, "updates")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(path)

    finish(
        stream.writeStream.outputMode("update").foreachBatch(keep)
        .option("checkpointLocation", fresh_path(spark, "checkpoint"))
        .trigger(availableNow=True).start()
    )
    return latest_copy(spark.read.parquet(path), keys, [F.desc("batch")]).drop("batch")


# The time of ingest is that of the run, so it is not compared.
_TIMELESS = [name for name in contract.HOT_COLUMNS if name not in
             ("ingested_at", "s3_request_key", "s3_response_key")]
_STREAM_HOT_SQL = f"SELECT {', '.join(_TIMELESS)} FROM ({hot_row_select()})"


@query(over_wire(_STREAM_HOT_SQL))
def ingest_stream(spark, sf_dir):
    """Hot rows of every delivery after streaming ingest."""
    return streamed_archive(spark, sf_dir).hot.raw().select(*_TIMELESS)


# Events whose time cannot be read are archived under the day of the run.
@query(over_wire(f"""SELECT request_id, coalesce(vendor_id, '') AS vendor_id, endpoint, status
    FROM ({ARCHIVED_SQL}) WHERE created_at <> 'not-a-date'"""))
def ingest_stream_cold(spark, sf_dir):
    """Cold metadata after streaming ingest: one per object."""
    return streamed_archive(spark, sf_dir).cold.metadata().where(
        "created_at <> 'not-a-date'").select("request_id", "vendor_id", "endpoint", "status")


@query(over_wire("""SELECT reason, count(*) AS messages FROM w WHERE reason IS NOT NULL
    GROUP BY reason"""))
def ingest_stream_rejects(spark, sf_dir):
    """What streaming ingest parked and skipped."""
    archive = streamed_archive(spark, sf_dir)
    skipped = spark.read.parquet(archive.skipped_path).agg(
        F.lit("unsupported_version").alias("reason"), F.sum("skipped").alias("messages"))
    return archive.quarantine.rows().groupBy("reason").agg(
        F.count("*").alias("messages")).unionByName(skipped)


@query(over_wire(f"SELECT * FROM (WITH v AS ({hot_row_select()}) {ROLLUP_SQL})"))
def rollup_of_stream(spark, sf_dir):
    """The rollup that streaming ingest kept, merged."""
    return streamed_archive(spark, sf_dir).rollup.merged()


@query(over_wire(f"SELECT count(*) AS hot_rows FROM ({hot_row_select()})"))
def batch_idempotent(spark, sf_dir):
    """The same batch ingested twice leaves one set of rows."""
    archive = Archive.at(spark, fresh_path(spark, "archive"))
    landing, _ = landed(spark, messages(spark, sf_dir).drop("delivery"), "parquet", FILES,
                        compression="zstd")
    batch = spark.read.parquet(landing)
    for _ in range(2):
        archive.ingest(batch, 7, source="messages")
    return archive.hot.raw().agg(F.count("*").alias("hot_rows"))


@query(over_hot(ROLLUP_SQL))
def rollup_stream_partials(spark, sf_dir):
    """Default rollup of a stream: partial sums per micro-batch, never late."""
    table = RollupTable(spark, fresh_path(spark, "rollup"))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        table.add(batch, f"batch-{batch_id:012d}")

    finish(
        hot_stream(spark, sf_dir).writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", fresh_path(spark, "checkpoint"))
        .trigger(availableNow=True).start()
    )
    return table.merged()


@query(name="rollup_stream", sql=over_hot(ROLLUP_SQL))
def rollup_windows(spark, sf_dir):
    """Event-time windows, with room for all rows of the sample to be late."""
    windows = rollup_stream(hot_stream(spark, sf_dir), lateness="1 day")
    return run_updates(spark, windows, [
        "window_start", "vendor_id", "endpoint", "service", "status"])


def _alert_windows_sql(tier: str, minutes: int, conditions: str) -> str:
    windows = windows_sql(tier, minutes, f"""count(*) AS calls,
        count(*) FILTER (WHERE status = 'SUCCESS') AS successes, {FAILURES_SQL} AS failures,
        count(*) FILTER (WHERE status = 'TIMEOUT') AS timeouts,
        {FAILURES_SQL} * 100.0::DOUBLE / count(*) AS failure_rate,
        round(quantile_cont(latency_ms, 0.95), 6) AS p95_ms""")
    return over_hot(f"SELECT *, {conditions} FROM ({windows})")


@query(name="alert_stream", sql=_alert_windows_sql("P1", 5, """failure_rate > 5 AS rate_high,
    failure_rate > 25 AS rate_critical, successes = 0 AS all_failing, p95_ms > 5000 AS latency,
    timeouts > 300 AS timeout_spike"""))
def alert_windows_p1(spark, sf_dir):
    """The five rules of the first tier in one stream."""
    windows = alert_stream(hot_stream(spark, sf_dir), "P1", lateness="1 day")
    return run_updates(spark, windows, ["vendor_id", "window_end"])


@query(name="alert_stream_p2", sql=_alert_windows_sql("P2", 10, "failure_rate > 10 AS rate_high"))
def alert_windows_p2(spark, sf_dir):
    windows = alert_stream(hot_stream(spark, sf_dir), "P2", lateness="1 day")
    return run_updates(spark, windows, ["vendor_id", "window_end"])


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With state in RocksDB: it holds every id."""
    path = fresh_path(spark, "deduplicated")
    with large_state(spark):
        finish(
            dedup_stream(hot_stream(spark, sf_dir)).writeStream.format("parquet")
            .option("checkpointLocation", fresh_path(spark, "checkpoint"))
            .trigger(availableNow=True).start(path)
        )
    return spark.read.schema(contract.HOT_SCHEMA).parquet(path)


@query(name="dedup_stream", sql=over_hot("SELECT DISTINCT request_id, vendor_id, endpoint FROM v"))
def deduplicated_ids(spark, sf_dir):
    """Stateful deduplication: one copy of each request, whichever came first."""
    return deduplicated(spark, sf_dir).select("request_id", "vendor_id", "endpoint")


@query(over_hot("""SELECT vendor_id, count(*) AS deliveries, count(DISTINCT request_id) AS requests
    FROM v GROUP BY vendor_id"""))
def stream_dedup(spark, sf_dir):
    """How many deliveries each vendor's requests had before and after."""
    before = hot_events(spark, sf_dir).groupBy("vendor_id").agg(F.count("*").alias("deliveries"))
    after = deduplicated(spark, sf_dir).groupBy("vendor_id").agg(F.count("*").alias("requests"))
    return before.join(after, "vendor_id")


@query(f"""SELECT event_name, bucket, count(*) AS records FROM ({AUDIT_SQL}) GROUP BY 1, 2""")
def audit_stream(spark, sf_dir):
    """Audit records as a stream of files."""
    landing = fresh_path(spark, "audit")
    audit_log(spark, sf_dir).repartition(max(FILES, tasks(spark, sf_dir))).write.text(landing)
    path = fresh_path(spark, "parsed-audit")
    finish(
        stream_audit(spark, landing).writeStream.format("parquet")
        .option("checkpointLocation", fresh_path(spark, "checkpoint"))
        .trigger(availableNow=True).start(path)
    )
    return spark.read.parquet(path).groupBy("event_name", "bucket").agg(
        F.count("*").alias("records"))


_HELD = {"p1_rate_high": "alert_p1_rate_high", "p1_rate_critical": "alert_p1_rate_critical",
         "p1_all_failing": "alert_p1_all_failing", "p1_latency": "alert_p1_latency",
         "p1_timeouts": "alert_p1_timeouts", "p2_rate_high": "alert_p2_rate_high"}


@query(" UNION ALL ".join(f"SELECT *, '{rule}' AS rule FROM ({BATCH_SQL[name]})"
                          for rule, name in _HELD.items()))
def alert_stream_held(spark, sf_dir):
    """All rules with their hold times, over files in no order. A last event, long after
    all others, moves the watermark past them."""
    path = fresh_path(spark, "rows")
    rows = hot_events(spark, sf_dir).select("created_at", "vendor_id", "status", "latency_ms")
    files = max(FILES, tasks(spark, sf_dir))
    rows.repartition(files, F.xxhash64("created_at")).write.parquet(path)
    spark.createDataFrame(
        [("2030-01-01 00:00:00", "synoriq", "SUCCESS", 1)],
        "created_at string, vendor_id string, status string, latency_ms bigint").withColumn(
        "created_at", F.col("created_at").cast("timestamp")).coalesce(1).write.mode(
        "append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option(
        "maxFilesPerTrigger", files // 2).parquet(path)
    return run_held(spark, stream)


def run_held(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run to the end of the input with state in RocksDB, as the operator needs it."""
    path = fresh_path(spark, "held")
    with large_state(spark):
        finish(held_alert_stream(stream, "20 days").writeStream.format("parquet")
               .option("checkpointLocation", fresh_path(spark, "checkpoint"))
               .trigger(availableNow=True).start(path))
    return spark.read.parquet(path)
