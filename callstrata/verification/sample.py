"""Call events derived from the `events` test table, for Spark and for DuckDB.

The test tables hold no call events, so one deterministic view is derived from
every row of `events`. Time runs 60 times faster (30 days become 12 hours) so
that minutes and windows are populated. Known faults are planted by rule: second
deliveries, clock skew, missing fields, truncated payloads, unredacted values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callstrata import contract
from callstrata.session import fresh_path, prepare
from callstrata.sources.files import list_files

# Words that differ between the two SQL dialects.
_SPARK = {
    "text": "STRING",
    "sha": "sha2({0}, 256)",
    "created": "timestamp_micros(1704067200000000 + (unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) div 60)",
    "seconds": "make_dt_interval(0, 0, 0, {0})",
    "millis": "make_dt_interval(0, 0, 0, ({0}) / 1000.0)",
    "deliveries": (
        "SELECT b.*, delivery FROM b LATERAL VIEW "
        "explode(CASE WHEN event_id % 97 = 0 THEN array(1, 2) ELSE array(1) END) t AS delivery"
    ),
}
_DUCKDB = {
    "text": "VARCHAR",
    "sha": "sha256({0})",
    "created": "make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60)",
    "seconds": "to_seconds({0})",
    "millis": "to_milliseconds({0})",
    "deliveries": (
        "SELECT b.*, 1 AS delivery FROM b UNION ALL "
        "SELECT b.*, 2 AS delivery FROM b WHERE event_id % 97 = 0"
    ),
}


def _call_events_sql(words: dict[str, str]) -> str:
    text = words["text"]

    def sha(expression: str) -> str:
        return words["sha"].format(expression)

    lag = words["seconds"].format(
        "CASE WHEN event_id % 53 = 0 THEN -2 ELSE event_id * 37 % 400 END + (delivery - 1) * 60"
    )
    millis = words["millis"].format("event_id % 997")
    return f"""
WITH b AS (
 SELECT event_id, user_id AS uid, event_type, value,
  {words['created']} AS created_at,
  'ABCDE' || lpad(CAST(event_id % 10000 AS {text}), 4, '0') || 'F' AS pan,
  '9' || lpad(CAST(event_id AS {text}), 9, '0') AS mobile,
  'user' || CAST(event_id + 10 AS {text}) AS mail_local
 FROM events),
d AS ({words['deliveries']}),
e AS (SELECT d.*,
  '{{"pan":"' || pan || '","mobile":"' || mobile || '","email":"' || mail_local || '@example.com","note":"ok"}}' AS raw_req,
  '{{"pan":"ABC****' || substr(pan, 8, 3) || '","mobile":"******' || substr(mobile, 7, 4) || '","email":"u' || repeat('*', CAST(length(mail_local) - 2 AS INT)) || substr(mail_local, length(mail_local), 1) || '@example.com","note":"ok"}}' AS red_req
 FROM d)
SELECT event_id, pan, mobile, mail_local || '@example.com' AS email,
 CASE WHEN event_id % 211 = 0 THEN 2 ELSE 1 END AS schema_version,
 '00000000-0000-4000-8000-' || lpad(CAST(event_id AS {text}), 12, '0') AS request_id,
 created_at,
 created_at + {lag} + {millis} AS ingested_at,
 CASE event_id % 3 WHEN 0 THEN 'identity-api' WHEN 1 THEN 'los-api' ELSE 'payment-api' END AS service,
 CASE WHEN event_id % 5 = 0 THEN 'prod' ELSE 'staging' END AS environment,
 CASE uid % 10 WHEN 0 THEN 'karza' WHEN 1 THEN 'digitap' WHEN 2 THEN 'signzy' WHEN 3 THEN 'easebuzz' WHEN 4 THEN 'crif' WHEN 5 THEN 'nsdl' WHEN 6 THEN 'synoriq' WHEN 7 THEN 'icici-bank' WHEN 8 THEN 'internal-bre' ELSE 'bank-statement-analyser' END AS vendor_id,
 CASE event_id % 4 WHEN 0 THEN '/kyc/verify' WHEN 1 THEN '/pan/validate' WHEN 2 THEN '/bureau/pull' ELSE '/payout' END AS endpoint,
 CASE WHEN event_type = 'error' THEN '' ELSE 'ref-' || CAST(event_id AS {text}) END AS vendor_ref_id,
 CASE event_id % 6 WHEN 0 THEN 'KYC' WHEN 1 THEN 'PAN_AADHAAR_SEED' WHEN 2 THEN 'BUREAU_BRE' WHEN 3 THEN 'BANK_BRE' WHEN 4 THEN 'DISBURSEMENT' ELSE 'REPAID' END AS loan_lifecycle_stage,
 CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'LAN-' || CAST(uid AS {text}) END AS loan_application_number,
 CASE WHEN event_id % 29 = 0 THEN '' ELSE 'user-' || CAST(uid AS {text}) END AS user_id,
 CASE WHEN event_id % 31 = 0 THEN '' ELSE 'ABC****' || substr(pan, 8, 3) END AS pan_masked,
 CASE WHEN event_id % 37 = 0 THEN '' ELSE {sha("'+91' || mobile")} END AS mobile_hash,
 substr(mobile, 7, 4) AS mobile_last4,
 CASE WHEN event_id % 43 = 0 THEN '' ELSE {sha(f"lpad(CAST(event_id % 10000 AS {text}), 4, '0')")} END AS aadhaar_last4_hash,
 '' AS aadhaar_last4_encrypted,
 CASE WHEN event_id % 7 = 0 THEN '' ELSE 'consent-' || CAST(uid AS {text}) END AS consent_id,
 CASE WHEN event_type <> 'error' THEN 'SUCCESS' WHEN event_id % 3 = 0 THEN 'FAILURE' WHEN event_id % 3 = 1 THEN 'TIMEOUT' ELSE 'NETWORK_ERROR' END AS status,
 CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 3 = 0 THEN 422 ELSE 0 END AS http_status,
 CAST(CASE WHEN event_type = 'error' AND event_id % 3 = 1 THEN 10000 ELSE floor(value * 10) END AS BIGINT) + (delivery - 1) AS latency_ms,
 CASE WHEN event_type <> 'error' THEN '' WHEN event_id % 3 = 0 THEN 'VENDOR_REJECTED' WHEN event_id % 3 = 1 THEN 'ETIMEDOUT' ELSE 'ECONNRESET' END AS error_code,
 CASE WHEN event_type <> 'error' THEN '' WHEN event_id % 3 = 0 THEN 'Unprocessable entity' WHEN event_id % 3 = 1 THEN 'Request Timed Out' ELSE 'socket hang up' END AS error_message,
 CASE WHEN event_id % 101 = 0 THEN '' ELSE 'k/' || CAST(event_id AS {text}) || '/request.json.gz' END AS s3_request_key,
 CASE WHEN event_id % 101 = 0 THEN '' ELSE 'k/' || CAST(event_id AS {text}) || '/response.json.gz' END AS s3_response_key,
 raw_req AS full_request_payload,
 CASE WHEN event_id % 83 = 0 THEN '[OVERSIZED]' WHEN event_id % 41 = 0 THEN raw_req || '...[TRUNCATED]' ELSE raw_req END AS request_payload,
 CASE WHEN event_type = 'error' THEN 'null' ELSE '{{"ok":true,"aadhaar":"1234 5678 9012","refs":[{{"phone":"9000000001"}}]}}' END AS response_payload,
 CASE WHEN event_id % 67 = 0 THEN raw_req WHEN event_id % 83 = 0 OR event_id % 41 = 0 THEN '[REDACTED:UNPARSEABLE]' ELSE red_req END AS hot_request_payload,
 CASE WHEN event_id % 83 = 0 OR event_id % 41 = 0 THEN '[REDACTED:UNPARSEABLE]' ELSE red_req END AS redacted_request_payload,
 CASE WHEN event_type = 'error' THEN 'null' ELSE '{{"ok":true,"aadhaar":"[AADHAAR_REDACTED]","refs":[{{"phone":"******0001"}}]}}' END AS hot_response_payload,
 CASE WHEN event_id % 83 = 0 OR event_id % 41 = 0 THEN 1 ELSE 0 END AS payload_truncated,
 CASE WHEN event_id % 47 = 0 THEN '' ELSE {sha("raw_req")} END AS request_hash,
 delivery
FROM e"""


SPARK_CALL_EVENTS = _call_events_sql(_SPARK)
DUCKDB_CALL_EVENTS = _call_events_sql(_DUCKDB)

# The hot table as stored: redacted payloads under their stored names.
DUCKDB_HOT_EVENTS = f"""
SELECT * EXCLUDE (request_payload, response_payload, hot_request_payload,
                  hot_response_payload, redacted_request_payload, full_request_payload,
                  pan, mobile, email, event_id),
       hot_request_payload AS request_payload,
       hot_response_payload AS response_payload
FROM ({DUCKDB_CALL_EVENTS})"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Events of one task. Their file is small, what is made of them is not: a call event is
#: some twenty times larger.
ROWS_PER_TASK = 50_000

_ROWS: dict[tuple[str, str], int] = {}


#: Files of a micro-batch at most: some two million events.
BATCH_FILES = 40


def rows(spark: SparkSession, sf_dir: str) -> int:
    """How many events a table has."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ROWS:
        _ROWS[key] = table(spark, sf_dir, "events").count()
    return _ROWS[key]


def tasks(spark: SparkSession, sf_dir: str) -> int:
    """How many tasks make the call events of a table."""
    return max(1, -(-rows(spark, sf_dir) // ROWS_PER_TASK))


def landed(spark: SparkSession, made: DataFrame, file_format: str, least: int,
           **options: str) -> tuple[str, int]:
    """Rows written as files, as many as tasks made them but `least`, and how many of them
    make one micro-batch: half of them, or of a large table BATCH_FILES. So what a batch
    keeps, and what a task of its shuffles takes, does not grow with the table."""
    path = fresh_path(spark, "landing")
    if made.rdd.getNumPartitions() < least:
        made = made.repartition(least)
    made.write.options(**options).format(file_format).save(path)
    return path, min(BATCH_FILES, max(1, -(-len(list_files(spark, path)) // 2)))


def call_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every call event with its raw payloads, as producers sent it."""
    prepare(spark)
    events, n = f"parquet.`{sf_dir.rstrip('/')}/events.parquet`", tasks(spark, sf_dir)
    if n > 1:  # the narrow events are dealt out before they grow
        events = f"(SELECT /*+ REPARTITION({n}, event_id) */ * FROM {events})"
    return spark.sql(SPARK_CALL_EVENTS.replace("FROM events)", f"FROM {events})"))


def hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hot table's rows: all deliveries, redacted payloads."""
    return call_events(spark, sf_dir).select(
        *[name for name in contract.HOT_COLUMNS
          if name not in ("request_payload", "response_payload")],
        F.col("hot_request_payload").alias("request_payload"),
        F.col("hot_response_payload").alias("response_payload"),
        "delivery",
    )
