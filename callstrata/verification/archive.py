"""Sources, sinks, deduplication and retention on real files, with SQL twins.

Sinks are written below the session's shared folder and read back, so that what
is compared went through the files. Outages are given as time ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callstrata import contract
from callstrata.operators import dedup, retention
from callstrata.operators.ingest import (
    hot_rows, parse_messages, quarantine_rows, version_gate, with_cold_keys,
)
from callstrata.session import bounded_tasks, fresh_path
from callstrata.sources.audit import parse_audit
from callstrata.sources.cold import ColdArchive, document_text
from callstrata.sources.hot import HotTable
from callstrata.sources.quarantine import Quarantine, replay_cold, replay_quarantine
from callstrata.sources.wire import read_messages
from callstrata.verification.messages import (
    DAY_SQL, PREFIX_SQL, hot_row_select, messages, over_wire,
)
from callstrata.verification.panels import over_hot
from callstrata.verification import sample
from callstrata.verification.registry import Registry
from callstrata.verification.sample import hot_events, table

registry = Registry()
QUERIES, SQL = registry.queries, registry.sql
query = registry.query

OUTAGE = ("2024-01-01 03:00:00", "2024-01-01 04:00:00")
_DURING = f"BETWEEN TIMESTAMP '{OUTAGE[0]}' AND TIMESTAMP '{OUTAGE[1]}'"


def during_outage(column: str):
    return F.col(column).between(*[F.lit(edge).cast("timestamp") for edge in OUTAGE])


def archived_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that reach the cold archive, one per archive object."""
    events = with_cold_keys(version_gate(parse_messages(messages(spark, sf_dir))))
    return dedup.one_per_batch(events)


# One row per archive object: the first delivery.
ARCHIVED_SQL = f"""SELECT * FROM (SELECT *, {DAY_SQL} AS cold_day, {PREFIX_SQL} AS prefix,
    row_number() OVER (PARTITION BY {PREFIX_SQL} ORDER BY ingested_at, delivery) AS rn FROM w
    WHERE reason IS NULL OR reason NOT IN ('unparseable', 'unsupported_version')) WHERE rn = 1"""


# -- sources and sinks ------------------------------------------------------------


@query(over_wire(f"""SELECT {', '.join(contract.WIRE_COLUMNS)} FROM w
    WHERE reason IS NULL OR reason <> 'unparseable'"""))
def src_wire_json(spark, sf_dir):
    """Bodies written as lines, read back, parsed to the wire schema."""
    path = fresh_path(spark, "landing")
    messages(spark, sf_dir).select("body").write.text(path)
    parsed = parse_messages(read_messages(spark, path))
    return parsed.where("reason IS NULL OR reason <> 'unparseable'").select(
        *contract.WIRE_COLUMNS)


_COLD: dict[tuple[str, str], ColdArchive] = {}


def cold_archive(spark: SparkSession, sf_dir: str) -> ColdArchive:
    """The archive on disk. Written once per session, read by several queries."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _COLD:
        archive = ColdArchive(spark, fresh_path(spark, "cold"))
        with bounded_tasks(spark, sample.rows(spark, sf_dir)):
            events = archived_events(spark, sf_dir).drop("body").persist()
            archive.write(events, "batch-0")
        events.unpersist()
        _COLD[key] = archive
    return _COLD[key]


@query(over_wire(f"""SELECT prefix || '/' || kind || '.json.gz' AS s3_key, kind,
    '{{"meta":{{"request_id":' || to_json(request_id) || ',"service":' || to_json(service)
    || ',"vendor_id":' || coalesce(to_json(vendor_id), 'null') || ',"endpoint":' || to_json(endpoint)
    || ',"created_at":' || to_json(created_at) || ',"environment":"staging"}},"payload":'
    || to_json(CASE kind WHEN 'request' THEN request_payload ELSE response_payload END) || '}}'
    AS document
    FROM ({ARCHIVED_SQL}), (VALUES ('request'), ('response')) AS k(kind)"""))
def sink_cold_payload(spark, sf_dir):
    return cold_archive(spark, sf_dir).documents().select(
        "s3_key", "kind", document_text().alias("document"))


_META_DEFAULTS = {"user_id": "unknown", "pan_masked": "", "mobile_last4": "",
                  "aadhaar_last4_hash": "", "consent_id": "", "request_hash": "",
                  "vendor_id": ""}
_META_SQL = ", ".join(
    f"coalesce({name}, '{_META_DEFAULTS[name]}') AS {name}" if name in _META_DEFAULTS else name
    for name in contract.COLD_META_COLUMNS)


@query(over_wire(f"SELECT {_META_SQL} FROM ({ARCHIVED_SQL})"))
def sink_cold_meta(spark, sf_dir):
    return cold_archive(spark, sf_dir).metadata().select(
        *[F.col(name).cast("bigint") if name == "latency_ms" else F.col(name)
          for name in contract.COLD_META_COLUMNS])


@query(over_wire(f"""SELECT request_id, CAST(NULL AS VARCHAR) AS correlation_id, vendor_id,
    split_part(cold_day, '/', 1) AS year, split_part(cold_day, '/', 2) AS month,
    split_part(cold_day, '/', 3) AS day, endpoint, status, latency_ms FROM ({ARCHIVED_SQL})
    WHERE vendor_id = 'easebuzz' AND cold_day LIKE '2024/01/%'"""))
def src_cold_scan(spark, sf_dir):
    """Cold metadata of one vendor and month, by partition."""
    return cold_archive(spark, sf_dir).scan("easebuzz", year="2024", month="01").select(
        "request_id", "correlation_id", "vendor_id", "year", "month", "day", "endpoint",
        "status", F.col("latency_ms").cast("bigint").alias("latency_ms"))


@query(over_wire(hot_row_select(", strftime(event_time + INTERVAL 330 MINUTE, '%Y%m') AS ist_month")))
def sink_hot(spark, sf_dir):
    """Bodies to the hot table on disk, and back."""
    hot = HotTable(spark, fresh_path(spark, "hot"), distinct_per_group=10_000)
    hot.write(hot_rows(messages(spark, sf_dir)), "batch-0")
    return hot.raw().select(*contract.HOT_COLUMNS, "ist_month")


@query(over_wire("""SELECT reason, count(*) AS parked, min(ingested_at) AS first_parked,
    reason <> 'unparseable' AS cold_written FROM w
    WHERE reason IS NOT NULL AND reason <> 'unsupported_version' GROUP BY reason"""))
def sink_quarantine(spark, sf_dir):
    quarantine = Quarantine(spark, fresh_path(spark, "quarantine"))
    quarantine.write(quarantine_rows(parse_messages(messages(spark, sf_dir))), "batch-0")
    return quarantine.rows().groupBy("reason", "cold_written").agg(
        F.count("*").alias("parked"), F.min("parked_at").alias("first_parked"))


# One row per month and request: the last delivery.
_FINAL_WIRE_SQL = f"""SELECT * EXCLUDE (rn, delivery) FROM (SELECT *, row_number() OVER (
    PARTITION BY strftime(created_at + INTERVAL 330 MINUTE, '%Y%m'), request_id
    ORDER BY ingested_at DESC, delivery DESC) AS rn
    FROM ({hot_row_select(', delivery')})) WHERE rn = 1"""


@query(name="replay_quarantine", sql=over_wire(_FINAL_WIRE_SQL))
def replay_parked(spark, sf_dir):
    """Hot inserts failed for an hour and were parked; after replay none is missing."""
    landed = messages(spark, sf_dir)
    failed = during_outage("received_at")
    hot = hot_rows(landed.where(~failed))
    parked = landed.where(failed).withColumnRenamed("received_at", "parked_at")
    return replay_quarantine(parked, hot).drop("delivery")


REBUILT_SQL = f"""SELECT request_id, vendor_id, endpoint, user_id, created_at, status,
    latency_ms, request_payload, response_payload, payload_truncated, s3_request_key,
    CASE WHEN lost THEN '' ELSE mobile_hash END AS mobile_hash
    FROM (SELECT *, row_number() OVER (PARTITION BY request_id
        ORDER BY CASE WHEN lost THEN delivery ELSE -delivery END) AS rn
      FROM (SELECT *, bool_and(created_at {_DURING}) OVER (PARTITION BY request_id) AS lost
        FROM ({hot_row_select(', delivery')})))
    WHERE rn = 1"""


@query(over_wire(REBUILT_SQL))
def replay_cold_to_hot(spark, sf_dir):
    """Hot rows of an hour are lost and rebuilt from the archive."""
    hot = dedup.hot_final(hot_rows(messages(spark, sf_dir)))
    kept = hot.where(~during_outage("created_at"))
    cold = cold_archive(spark, sf_dir).events()
    rebuilt = replay_cold(cold, kept, F.lit("2024-01-02 00:00:00").cast("timestamp"))
    columns = ("request_id", "vendor_id", "endpoint", "user_id", "created_at", "status",
               "latency_ms", "request_payload", "response_payload", "payload_truncated",
               "s3_request_key", "mobile_hash")
    return kept.select(*columns).unionByName(rebuilt.select(*columns))


AUDIT_BUCKET = "archive"
_AUDIT_NAMES = (("view", "GetObject"), ("click", "HeadObject"), ("purchase", "PutObject"),
                ("signup", "PutObjectLegalHold"))


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit records in place of events: a view is an object read, and so on."""
    name = F.lit("DeleteObject")
    for event_type, event_name in _AUDIT_NAMES:
        name = F.when(F.col("event_type") == event_type, event_name).otherwise(name)
    at = F.expr("timestamp_micros(1704067200000000 + "
                "(unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) div 60)")
    record = F.struct(
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventTime"),
        name.alias("eventName"),
        F.lit("objects").alias("eventSource"),
        F.struct(F.concat(F.lit("reader-"), F.col("user_id")).alias("userName")).alias("userIdentity"),
        F.struct(
            F.when(F.col("event_id") % 10 == 0, "other").otherwise(AUDIT_BUCKET).alias("bucketName"),
            F.concat(F.lit("k/"), F.col("event_id")).alias("key"),
            F.struct(F.when(F.col("user_id") % 2 == 0, "OFF").otherwise("ON").alias("Status"))
            .alias("LegalHold"),
        ).alias("requestParameters"),
        F.lit("ignored").alias("awsRegion"),
    )
    return table(spark, sf_dir, "events").select(F.to_json(record).alias("value"))


AUDIT_SQL = """SELECT date_trunc('second', make_timestamp(1704067200000000
      + (epoch_us(ts) - 1704067200000000) // 60)) AS event_time,
    CASE event_type WHEN 'view' THEN 'GetObject' WHEN 'click' THEN 'HeadObject'
      WHEN 'purchase' THEN 'PutObject' WHEN 'signup' THEN 'PutObjectLegalHold'
      ELSE 'DeleteObject' END AS event_name,
    CASE WHEN event_id % 10 = 0 THEN 'other' ELSE 'archive' END AS bucket,
    'k/' || event_id AS object_key, 'reader-' || user_id AS user_name,
    CASE WHEN user_id % 2 = 0 THEN 'OFF' ELSE 'ON' END AS hold_status FROM events"""


@query(f"""SELECT event_time, event_name, object_key, user_name, hold_status
    FROM ({AUDIT_SQL}) WHERE bucket = 'archive' AND event_name IN ('GetObject', 'PutObject')""")
def src_audit_log(spark, sf_dir):
    audit = parse_audit(audit_log(spark, sf_dir))
    return audit.where(
        (F.col("bucket") == AUDIT_BUCKET) & F.col("event_name").isin("GetObject", "PutObject")
    ).select("event_time", "event_name", "object_key", "user_name", "hold_status")


# -- deduplication ----------------------------------------------------------------

_HOT_LIST = ", ".join(contract.HOT_COLUMNS)
FINAL_SQL = f"""SELECT {_HOT_LIST}, delivery FROM (SELECT *, row_number() OVER (
    PARTITION BY strftime(created_at + INTERVAL 330 MINUTE, '%Y%m'), request_id
    ORDER BY ingested_at DESC, delivery DESC) AS rn FROM v) WHERE rn = 1"""


@query(over_hot(FINAL_SQL))
def hot_final(spark, sf_dir):
    return dedup.hot_final(hot_events(spark, sf_dir))


@query(over_wire(f"""SELECT prefix || '/request.json.gz' AS s3_request_key, delivery
    FROM ({ARCHIVED_SQL}) WHERE prefix NOT IN (SELECT {PREFIX_SQL} FROM w
      WHERE (reason IS NULL OR reason NOT IN ('unparseable', 'unsupported_version'))
        AND ingested_at {_DURING})"""))
def cold_idempotent(spark, sf_dir):
    """An hour is in the archive already; what is still to be written."""
    known_events = with_cold_keys(version_gate(parse_messages(
        messages(spark, sf_dir).where(during_outage("received_at")))))
    archive = ColdArchive(spark, fresh_path(spark, "cold"))
    archive.write(dedup.one_per_batch(known_events), "batch-0")
    events = with_cold_keys(version_gate(parse_messages(messages(spark, sf_dir))))
    days = [row.cold_day for row in events.select("cold_day").distinct().collect()]
    return dedup.not_yet_cold(events, archive.request_keys(days)).select(
        "s3_request_key", "delivery")


def _hot_in_two_writes(spark: SparkSession, sf_dir: str) -> HotTable:
    hot = HotTable(spark, fresh_path(spark, "hot"), distinct_per_group=10_000)
    rows = hot_events(spark, sf_dir)
    hot.write(rows.where("delivery = 1"), "batch-0", 0)
    hot.write(rows.where("delivery = 2"), "batch-1", 1)
    return hot


@query(over_hot(f"SELECT {_HOT_LIST} FROM ({FINAL_SQL})"))
def compact_final(spark, sf_dir):
    """The table on disk after compaction, read without deduplication."""
    hot = _hot_in_two_writes(spark, sf_dir)
    for month in [row.ist_month for row in hot.raw().select("ist_month").distinct().collect()]:
        hot.compact(month)
    return hot.raw().select(*contract.HOT_COLUMNS)


# -- retention and tiers ----------------------------------------------------------


def clock_after(days: int):
    """A clock far enough ahead for the retention edge to cut through the data."""
    return F.lit("2024-01-01 06:00:00").cast("timestamp") + F.make_dt_interval(days=F.lit(days))


CUT_SQL = "TIMESTAMP '2024-01-01 06:00:00'"


@query(over_hot(f"SELECT request_id, created_at, delivery FROM v WHERE created_at > {CUT_SQL}"))
def expire_rows(spark, sf_dir):
    rows = retention.expire_rows(hot_events(spark, sf_dir), clock_after(contract.ROW_RETENTION_DAYS))
    return rows.select("request_id", "created_at", "delivery")


@query(over_hot(f"""SELECT request_id, delivery, latency_ms,
    CASE WHEN created_at <= {CUT_SQL} THEN '' ELSE request_payload END AS request_payload,
    CASE WHEN created_at <= {CUT_SQL} THEN '' ELSE response_payload END AS response_payload
    FROM v"""))
def expire_payloads(spark, sf_dir):
    rows = retention.expire_payloads(
        hot_events(spark, sf_dir), clock_after(contract.PAYLOAD_RETENTION_DAYS))
    return rows.select("request_id", "delivery", "latency_ms", "request_payload",
                       "response_payload")


@query(over_hot(f"""SELECT {', '.join(c for c in contract.HOT_COLUMNS if 'payload' not in c)},
    payload_truncated,
    CASE WHEN created_at <= {CUT_SQL} THEN '' ELSE request_payload END AS request_payload,
    CASE WHEN created_at <= {CUT_SQL} THEN '' ELSE response_payload END AS response_payload
    FROM v"""))
def expire_payload_partitions(spark, sf_dir):
    """The same on disk: old day partitions rewritten in place."""
    hot = _hot_in_two_writes(spark, sf_dir)
    hot.blank_payloads(clock_after(contract.PAYLOAD_RETENTION_DAYS))
    return hot.raw().select(*contract.HOT_COLUMNS)


@query("""SELECT CASE WHEN age >= 365 THEN 'DEEP_ARCHIVE' WHEN age >= 90 THEN 'STANDARD_IA'
      ELSE 'STANDARD' END AS tier, count(*) AS objects, CAST(sum(bytes) AS BIGINT) AS bytes
    FROM (SELECT date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-12-31') AS age,
      strlen(o_orderpriority) AS bytes FROM orders) GROUP BY 1""")
def tier_label(spark, sf_dir):
    """Orders in place of archive objects: their dates span years."""
    objects = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("created_at"),
        F.octet_length("o_orderpriority").cast("bigint").alias("object_bytes"))
    return retention.tier_inventory(objects, F.lit("1998-12-31").cast("date"))


@query(over_wire(f"""SELECT request_id, coalesce(parked, 0) AS parked,
    coalesce(cold_copies, 0) AS cold_copies, coalesce(hot_copies, 0) AS hot_copies,
    CASE WHEN cold_copies > 0 AND hot_copies > 0 THEN 'archived' WHEN cold_copies > 0 THEN 'cold_only'
      WHEN hot_copies > 0 THEN 'hot_only' ELSE 'parked_only' END AS verdict
    FROM (SELECT request_id, count(*) AS parked FROM w WHERE reason IN
        ('bad_field', 'bad_request_id', 'bad_stage', 'bad_created_at') GROUP BY 1)
    FULL JOIN (SELECT request_id, count(*) AS cold_copies FROM ({ARCHIVED_SQL}) GROUP BY 1)
      USING (request_id)
    FULL JOIN (SELECT request_id, count(*) AS hot_copies FROM w WHERE reason IS NULL
        AND NOT ingested_at {_DURING} GROUP BY 1) USING (request_id)"""))
def cold_hot_recon(spark, sf_dir):
    """Where each request is, after an hour of failed hot inserts."""
    parsed = parse_messages(messages(spark, sf_dir))
    parked = quarantine_rows(parsed).where("reason <> 'unparseable'")
    cold = archived_events(spark, sf_dir)
    hot = parsed.where("reason IS NULL").where(~during_outage("received_at"))
    return retention.reconcile(parked, cold, hot)
