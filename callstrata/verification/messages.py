"""Message bodies made from the sample events, with faults planted by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callstrata import contract
from callstrata.operators.ingest import to_messages
from callstrata.verification.sample import DUCKDB_CALL_EVENTS, call_events

# Rule: every event whose id divides by the number has the fault.
CUT_BODY = 113
WRONG_STAGE = 127
WRONG_ID = 131
WRONG_TIME = 137
NO_ENVIRONMENT = 59
NO_VENDOR = 61
EMPTY_VENDOR = 83
NO_STATUS = 71
NO_LATENCY = 73
WRONG_TYPE = 139

# What rejection_reason must find, in its order of tests.
REASON_SQL = f"""CASE
    WHEN event_id % {CUT_BODY} = 0 THEN 'unparseable'
    WHEN schema_version <> 1 THEN 'unsupported_version'
    WHEN event_id % {WRONG_TYPE} = 0 THEN 'bad_field'
    WHEN event_id % {WRONG_ID} = 0 THEN 'bad_request_id'
    WHEN event_id % {WRONG_STAGE} = 0 THEN 'bad_stage'
    WHEN event_id % {WRONG_TIME} = 0 THEN 'bad_created_at' END"""


def planted(number: int):
    return F.col("event_id") % number == 0


def wire_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample events in wire form: text times, absent optional fields, faults."""
    events = call_events(spark, sf_dir)
    absent = {
        name: F.nullif(F.col(name), F.lit(""))
        for name in contract.OPTIONAL_WIRE_COLUMNS if name != "loan_application_number"
    }
    return events.withColumns({
        **absent,
        "created_at": F.when(planted(WRONG_TIME), "not-a-date").otherwise(
            F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")),
        "request_id": F.when(planted(WRONG_ID), F.concat(F.lit("req-"), "event_id")).otherwise(
            F.col("request_id")),
        "loan_lifecycle_stage": F.when(planted(WRONG_STAGE), "NOT_A_STAGE").otherwise(
            F.col("loan_lifecycle_stage")),
        "environment": F.when(planted(NO_ENVIRONMENT), F.lit(None)).otherwise(
            F.col("environment")),
        "payload_truncated": F.col("payload_truncated") == 1,
        "vendor_id": F.when(planted(NO_VENDOR), F.lit(None)).when(
            planted(EMPTY_VENDOR), "").otherwise(F.col("vendor_id")),
        "status": F.when(planted(NO_STATUS), F.lit(None)).otherwise(F.col("status")),
        "latency_ms": F.when(planted(NO_LATENCY) | planted(WRONG_TYPE), F.lit(None)).otherwise(
            F.col("latency_ms")),
    })


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies as landed, with receipt time and delivery number."""
    events = wire_events(spark, sf_dir)
    mistyped = F.concat(F.lit('{"latency_ms":"many",'), F.expr("substr(body, 2)"))
    body = F.when(planted(CUT_BODY), F.expr("left(body, length(body) - 10)")).when(
        planted(WRONG_TYPE), mistyped).otherwise(F.col("body"))
    return to_messages(events).select(
        body.alias("body"), F.col("ingested_at").alias("received_at"), "delivery")


# Expected wire values, written independently of the library.
WIRE_SQL = f"""
SELECT * REPLACE (
   CASE WHEN event_id % {WRONG_TIME} = 0 THEN 'not-a-date'
        ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%S.%gZ') END AS created_at,
   CASE WHEN event_id % {WRONG_ID} = 0 THEN 'req-' || event_id ELSE request_id END AS request_id,
   CASE WHEN event_id % {WRONG_STAGE} = 0 THEN 'NOT_A_STAGE' ELSE loan_lifecycle_stage END
     AS loan_lifecycle_stage,
   CASE WHEN event_id % {NO_ENVIRONMENT} = 0 THEN NULL ELSE environment END AS environment,
   payload_truncated = 1 AS payload_truncated,
   CASE WHEN event_id % {NO_VENDOR} = 0 THEN NULL WHEN event_id % {EMPTY_VENDOR} = 0 THEN ''
        ELSE vendor_id END AS vendor_id,
   CASE WHEN event_id % {NO_STATUS} = 0 THEN NULL ELSE status END AS status,
   CASE WHEN event_id % {NO_LATENCY} = 0 OR event_id % {WRONG_TYPE} = 0 THEN NULL
        ELSE latency_ms END AS latency_ms,
   {', '.join(f"nullif({name}, '') AS {name}" for name in contract.OPTIONAL_WIRE_COLUMNS)}
 ),
 created_at AS event_time,
 {REASON_SQL} AS reason
FROM ({DUCKDB_CALL_EVENTS})"""

# The archive day: of the event, or of its receipt when its own time is unreadable.
DAY_SQL = f"""strftime(CASE WHEN event_id % {WRONG_TIME} = 0 THEN ingested_at
    ELSE event_time END, '%Y/%m/%d')"""
PREFIX_SQL = f"""{DAY_SQL} || '/' || coalesce(vendor_id, '') || '/' ||
    replace(substr(endpoint, 2), '/', '_') || '/' || coalesce(user_id, 'unknown') || '/' ||
    request_id"""


def over_wire(sql: str) -> str:
    """SQL over the expected wire events (w)."""
    return f"WITH w AS ({WIRE_SQL}) {sql}"


def over_calls(sql: str) -> str:
    """SQL over the raw sample events (c)."""
    return f"WITH c AS ({DUCKDB_CALL_EVENTS}) {sql}"


def hot_row_select(extra: str = "") -> str:
    """Expected hot rows from w, for events that pass all checks."""
    columns = []
    for name in contract.HOT_COLUMNS:
        if name == "created_at":
            columns.append("date_trunc('millisecond', event_time) AS created_at")
        elif name == "environment":
            columns.append("coalesce(environment, 'staging') AS environment")
        elif name in ("loan_application_number", "http_status"):
            columns.append(name)
        elif name in contract.OPTIONAL_WIRE_COLUMNS:
            columns.append(f"coalesce({name}, '') AS {name}")
        elif name in ("vendor_id", "status"):
            columns.append(f"coalesce({name}, '') AS {name}")
        elif name == "latency_ms":
            columns.append("coalesce(latency_ms, 0) AS latency_ms")
        elif name in ("s3_request_key", "s3_response_key"):
            kind = name.split("_")[1]
            columns.append(f"{PREFIX_SQL} || '/{kind}.json.gz' AS {name}")
        elif name == "request_payload":
            columns.append("redacted_request_payload AS request_payload")
        elif name == "response_payload":
            columns.append("hot_response_payload AS response_payload")
        elif name == "payload_truncated":
            columns.append("CAST(payload_truncated AS INT) AS payload_truncated")
        else:
            columns.append(name)
    return f"SELECT {', '.join(columns)}{extra} FROM w WHERE reason IS NULL"
