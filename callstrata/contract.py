"""The event contract: schemas, allowed values and limits, in one place."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values. These must equal what producers of the events send.
# ---------------------------------------------------------------------------

SUPPORTED_SCHEMA_VERSION = 1

LIFECYCLE_STAGES = (
    "LEAD", "SELFIE", "KYC", "PAN_AADHAAR_SEED", "LOCATION_BRE", "BUREAU_BRE",
    "BANK_BRE", "REPEAT_BRE", "UNDERWRITING", "DISBURSED", "REPAID", "OVERDUE",
    "CLOSED", "WRITTEN_OFF", "LMS_QUERY", "PENNY_DROP", "LOAN_AGREEMENT",
    "DISBURSEMENT",
)

STORED_STATUSES = ("SUCCESS", "FAILURE", "TIMEOUT", "NETWORK_ERROR")
FAILED_STATUSES = ("FAILURE", "TIMEOUT", "NETWORK_ERROR")
TRANSPORT_ERROR_STATUSES = ("TIMEOUT", "NETWORK_ERROR")

TIMEOUT_CODES = ("ECONNABORTED", "ETIMEDOUT")
NETWORK_ERROR_CODES = (
    "ECONNREFUSED", "ENOTFOUND", "ECONNRESET", "EHOSTUNREACH", "ENETUNREACH",
)
TIMEOUT_WORDS = ("timeout", "timed out")

VENDOR_TIERS = (
    ("easebuzz", "P1"), ("icici-bank", "P1"), ("synoriq", "P1"),
    ("internal-bre", "P1"), ("digitap", "P2"), ("signzy", "P2"),
    ("appsflyer", "P3"), ("internal-dedupe", "P3"),
)

VENDOR_VIEWS = ("karza", "easebuzz", "nsdl", "crif", "bank-statement-analyser")

LATENCY_BUCKETS_MS = (50, 100, 200, 500, 1000, 2000, 5000)

MAX_PAYLOAD_BYTES = 512 * 1024
MAX_MESSAGE_BYTES = 256 * 1024
TRUNCATED_SUFFIX = "...[TRUNCATED]"
OVERSIZED_MARK = "[OVERSIZED]"
UNPARSEABLE_MARK = "[REDACTED:UNPARSEABLE]"
AADHAAR_MARK = "[AADHAAR_REDACTED]"

ROW_RETENTION_DAYS = 90
PAYLOAD_RETENTION_DAYS = 30
ROLLUP_RETENTION_DAYS = 30
INFREQUENT_ACCESS_DAYS = 90
DEEP_ARCHIVE_DAYS = 365
QUARANTINE_RETENTION_DAYS = 14

# Days a message can wait in the main queue plus the retry queue, so the
# longest gap between two deliveries of one request.
REDELIVERY_HORIZON_DAYS = 18

HOT_TIME_ZONE = "Asia/Kolkata"

# ---------------------------------------------------------------------------
# Fixed values, too: names and order of fields, as Spark DDL, and which are optional.
# ---------------------------------------------------------------------------


def _names(ddl: str) -> tuple[str, ...]:
    return tuple(field.split()[0] for field in ddl.split(","))


WIRE_SCHEMA = """
    schema_version INT, request_id STRING, created_at STRING, service STRING,
    environment STRING, vendor_id STRING, endpoint STRING, vendor_ref_id STRING,
    loan_lifecycle_stage STRING, loan_application_number STRING, user_id STRING,
    pan_masked STRING, mobile_hash STRING, mobile_last4 STRING,
    aadhaar_last4_hash STRING, consent_id STRING, status STRING, http_status INT,
    latency_ms BIGINT, error_code STRING, error_message STRING,
    request_payload STRING, response_payload STRING,
    payload_truncated BOOLEAN, request_hash STRING
"""
WIRE_COLUMNS = _names(WIRE_SCHEMA)

# Keys a message may leave out.
OPTIONAL_WIRE_COLUMNS = (
    "vendor_ref_id", "loan_application_number", "user_id", "pan_masked",
    "mobile_hash", "mobile_last4", "aadhaar_last4_hash", "consent_id",
    "error_code", "error_message",
)

# What a row has in place of a required value that the message left out.
REQUIRED_DEFAULTS = {
    "service": "", "vendor_id": "", "endpoint": "", "status": "", "latency_ms": 0,
}

HOT_SCHEMA = """
    schema_version INT, request_id STRING, created_at TIMESTAMP,
    ingested_at TIMESTAMP, service STRING, environment STRING, vendor_id STRING,
    endpoint STRING, vendor_ref_id STRING, loan_lifecycle_stage STRING,
    loan_application_number STRING, user_id STRING, pan_masked STRING,
    mobile_hash STRING, mobile_last4 STRING, aadhaar_last4_hash STRING,
    aadhaar_last4_encrypted STRING, consent_id STRING, status STRING,
    http_status INT, latency_ms BIGINT, error_code STRING, error_message STRING,
    s3_request_key STRING, s3_response_key STRING, request_payload STRING,
    response_payload STRING, payload_truncated INT, request_hash STRING
"""
HOT_COLUMNS = _names(HOT_SCHEMA)

COLD_META_SCHEMA = """
    schema_version INT, request_id STRING, created_at STRING, service STRING,
    environment STRING, vendor_id STRING, endpoint STRING,
    loan_lifecycle_stage STRING, loan_application_number STRING, user_id STRING,
    pan_masked STRING, mobile_last4 STRING, aadhaar_last4_hash STRING,
    consent_id STRING, status STRING, http_status INT, latency_ms BIGINT,
    request_hash STRING
"""
COLD_META_COLUMNS = _names(COLD_META_SCHEMA)

# The cold table as read back: vendor_id comes from the directory, and
# correlation_id is declared but never written, so it reads NULL.
COLD_SCAN_SCHEMA = """
    schema_version INT, request_id STRING, correlation_id STRING,
    created_at STRING, service STRING, environment STRING, endpoint STRING,
    loan_lifecycle_stage STRING, loan_application_number STRING, user_id STRING,
    pan_masked STRING, mobile_last4 STRING, aadhaar_last4_hash STRING,
    consent_id STRING, status STRING, http_status INT, latency_ms BIGINT,
    request_hash STRING, year STRING, month STRING, day STRING, vendor_id STRING
"""

AUDIT_SCHEMA = """
    eventTime STRING, eventName STRING, eventSource STRING,
    userIdentity STRUCT<userName: STRING>,
    requestParameters STRUCT<bucketName: STRING, key: STRING,
        LegalHold: STRUCT<Status: STRING>>
"""

# ---------------------------------------------------------------------------
# Our own: columns that our tables add for partitioning and for picking the last copy.
# ---------------------------------------------------------------------------
HOT_TABLE_SCHEMA = HOT_SCHEMA.rstrip() + """,
    batch_id BIGINT, write_id STRING, ist_month STRING, ist_day STRING
"""

# attempts: how often a replay has found the message unfit again.
QUARANTINE_SCHEMA = """
    body STRING, cold_written BOOLEAN, parked_at TIMESTAMP, batch_id BIGINT,
    attempts INT, parked_day STRING, reason STRING
"""

COLD_PAYLOAD_SCHEMA = """
    s3_key STRING, kind STRING,
    meta STRUCT<request_id: STRING, service: STRING, vendor_id: STRING,
        endpoint: STRING, created_at: STRING, environment: STRING>,
    payload STRING, year STRING, month STRING, day STRING, vendor_id STRING
"""

# key_hash: xxhash64 of the key, by which a run is sorted.
COLD_INDEX_SCHEMA = """
    key_hash BIGINT, s3_request_key STRING, write_id STRING, cold_day STRING
"""

ROLLUP_SCHEMA = """
    window_start TIMESTAMP, vendor_id STRING, endpoint STRING, service STRING,
    status STRING, total BIGINT, total_latency BIGINT, rollup_day STRING
"""
