"""Queries on tables as they are stored: ranges, lookups, merged files, and every column
that streaming ingest leaves."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession, functions as F

from callstrata import contract
from callstrata.operators import lookups
from callstrata.plans.panels import run_panel
from callstrata.session import bounded_tasks, fresh_path
from callstrata.sources.cold import ColdArchive, document_text
from callstrata.sources.hot import HotTable
from callstrata.sources.rollups import RollupTable
from callstrata.streaming.ingest import Archive, start_ingest
from callstrata.verification import archive as archive_queries
from callstrata.verification import rollups as rollup_queries
from callstrata.verification.archive import ARCHIVED_SQL, archived_events
from callstrata.verification.messages import hot_row_select, messages, over_wire
from callstrata.verification.panels import PANEL_SQL, over_hot
from callstrata.verification.registry import Registry
from callstrata.verification.rollups import ROLLUP_SQL
from callstrata.verification.sample import hot_events, landed, rows

registry = Registry()
QUERIES, SQL = registry.queries, registry.sql
query = registry.query

WRITES = 6
START, END = datetime(2024, 1, 1, 2), datetime(2024, 1, 1, 7, 30)
_IN_RANGE = f"BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"

_HOT: dict[tuple[str, str], HotTable] = {}


def stored_hot(spark: SparkSession, sf_dir: str) -> HotTable:
    """Rows in several writes by hour of ingest, as batches would come."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _HOT:
        hot = HotTable(spark, fresh_path(spark, "hot"), distinct_per_group=10_000)
        events = hot_events(spark, sf_dir).persist()
        for n in range(WRITES):
            hot.write(events.where(F.hour("ingested_at") % WRITES == n), f"batch-{n}", n)
        events.unpersist()
        _HOT[key] = hot
    return _HOT[key]


@query(over_hot(f"SELECT * FROM (SELECT date_trunc('minute', ingested_at) AS time, environment, "
                f"count(*) AS rows FROM v WHERE ingested_at {_IN_RANGE} GROUP BY 1, 2)"))
def ops_insert_rate_stored(spark, sf_dir):
    """A range of ingest times, which no folder tells: files out of range are not read."""
    found = stored_hot(spark, sf_dir).between("ingested_at", START, END)
    return run_panel("ops_insert_rate", found, start=str(START), end=str(END))


def _in_range_final(name: str):
    def build(spark, sf_dir):
        found = stored_hot(spark, sf_dir).between("created_at", START, END, final=True)
        return run_panel(name, found)
    return build


for _name in ("fun_vendor_ranking", "fail_rate_by_vendor", "ops_error_mix", "fun_stage_health"):
    QUERIES[f"{_name}_stored_final"] = _in_range_final(_name)
    SQL[f"{_name}_stored_final"] = over_hot(
        f"SELECT * FROM (WITH v AS (SELECT * FROM ({archive_queries.FINAL_SQL}) "
        f"WHERE created_at {_IN_RANGE}) {PANEL_SQL[_name]})")


def _stored_lookup(column: str, value: str):
    return lambda spark, sf_dir: lookups.find_by(
        stored_hot(spark, sf_dir).raw(), column, value).select(*contract.HOT_COLUMNS)


for _column, _value in rollup_queries._LOOKUPS.items():
    QUERIES[f"find_by_{_column}_stored"] = _stored_lookup(_column, _value)
    SQL[f"find_by_{_column}_stored"] = rollup_queries.SQL[f"find_by_{_column}"]


# -- merged files ---------------------------------------------------------------------


@query(over_hot(ROLLUP_SQL))
def compact_rollup(spark, sf_dir):
    """Partial sums of many batches, merged in place: one row per key is left."""
    table = RollupTable(spark, fresh_path(spark, "rollup"))
    events = hot_events(spark, sf_dir)
    part = F.pmod(F.xxhash64("request_id", "delivery"), F.lit(WRITES))
    for n in range(WRITES):
        table.add(events.where(part == n), f"batch-{n}")
    table.compact(most=1, settled=0)
    return table.partials().drop("rollup_day")


_MERGED: dict[tuple[str, str], ColdArchive] = {}


def merged_cold(spark: SparkSession, sf_dir: str) -> ColdArchive:
    """An archive written in several batches, its files merged, old ones deleted."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MERGED:
        archive = ColdArchive(spark, fresh_path(spark, "cold"))
        with bounded_tasks(spark, rows(spark, sf_dir)):
            events = archived_events(spark, sf_dir).drop("body").persist()
            for n in range(WRITES):
                archive.write(events.where(
                    F.pmod(F.xxhash64("s3_request_key"), F.lit(WRITES)) == n), f"batch-{n}")
        events.unpersist()
        archive.compact(most=2, settled=0)
        archive.vacuum(0)
        _MERGED[key] = archive
    return _MERGED[key]


@query(archive_queries.SQL["sink_cold_payload"])
def compact_cold(spark, sf_dir):
    return merged_cold(spark, sf_dir).documents().select(
        "s3_key", "kind", document_text().alias("document"))


@query(archive_queries.SQL["sink_cold_meta"])
def compact_cold_meta(spark, sf_dir):
    return merged_cold(spark, sf_dir).metadata().select(
        *[F.col(name).cast("bigint") if name == "latency_ms" else F.col(name)
          for name in contract.COLD_META_COLUMNS])


@query(over_wire(f"SELECT prefix || '/request.json.gz' AS s3_request_key FROM ({ARCHIVED_SQL})"))
def compact_cold_index(spark, sf_dir):
    """Keys of all days in the index, from merged runs."""
    index = merged_cold(spark, sf_dir).index
    index.merge(fan=2)
    days = sorted({f.partition("cold_day") for f in index.table.files()})
    return index.keys(days)


# -- all that streaming ingest leaves ----------------------------------------------------

_STREAMED: dict[tuple[str, str], Archive] = {}


def streamed(spark: SparkSession, sf_dir: str) -> Archive:
    """Messages with the time of their receipt, through streaming ingest in batches."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STREAMED:
        landing, half = landed(spark, messages(spark, sf_dir).drop("delivery"), "parquet", 4)
        archive = Archive.at(spark, fresh_path(spark, "archive"))
        stream = (spark.readStream.schema("body string, received_at timestamp")
                  .option("maxFilesPerTrigger", half).parquet(landing))
        with bounded_tasks(spark):
            start_ingest(stream, archive, fresh_path(spark, "checkpoint"), every=None
                         ).awaitTermination()
        _STREAMED[key] = archive
    return _STREAMED[key]


@query(over_wire(f"SELECT {', '.join(contract.HOT_COLUMNS)} FROM ({hot_row_select()})"))
def ingest_stream_hot(spark, sf_dir):
    """Every column of every delivery."""
    return streamed(spark, sf_dir).hot.raw().select(*contract.HOT_COLUMNS)


@query(over_wire(f"""SELECT prefix || '/request.json.gz' AS s3_request_key,
    prefix || '/response.json.gz' AS s3_response_key, cold_day, request_id,
    reason AS hot_reason FROM ({ARCHIVED_SQL})"""))
def ingest_stream_objects(spark, sf_dir):
    """Every archived event, those with an unreadable time included."""
    return streamed(spark, sf_dir).cold.metadata().select(
        "s3_request_key", "s3_response_key",
        F.concat_ws("/", "year", "month", "day").alias("cold_day"), "request_id", "hot_reason")


@query(over_wire("""SELECT reason, ingested_at AS parked_at, reason <> 'unparseable' AS cold_written,
    count(*) AS messages FROM w WHERE reason IS NOT NULL AND reason <> 'unsupported_version'
    GROUP BY ALL"""))
def ingest_stream_parked(spark, sf_dir):
    return streamed(spark, sf_dir).quarantine.rows().groupBy(
        "reason", "parked_at", "cold_written").agg(F.count("*").alias("messages"))
