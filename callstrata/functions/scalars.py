"""Scalar rules of the archive as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from callstrata import contract


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def event_time(text: Column) -> Column:
    """ISO-8601 text to a timestamp; NULL when it cannot be read."""
    return F.try_to_timestamp(text)


def safe_day(text: Column, fallback: Column) -> Column:
    """UTC day `yyyy/MM/dd` of an ISO text, or of the fallback when unreadable."""
    return F.date_format(F.coalesce(event_time(text), fallback), "yyyy/MM/dd")


def sanitize_segment(text: Column) -> Column:
    """One safe path segment: no slashes, no odd characters, never empty."""
    text = F.coalesce(F.nullif(text, F.lit("")), F.lit("unknown"))
    text = F.regexp_replace(text, r"^/+", "")
    text = F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_")
    text = F.regexp_replace(text, r"^_+|_+$", "")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("unknown"))


def cold_prefix(day: Column, vendor: Column, endpoint: Column, user: Column,
                request_id: Column) -> Column:
    """Folder of one event. The vendor is a controlled id and is kept as it is; an absent
    one leaves its segment empty."""
    vendor = F.coalesce(vendor, F.lit(""))
    return F.concat_ws(
        "/", day, vendor, sanitize_segment(endpoint), sanitize_segment(user), request_id
    )


def cold_key(prefix: Column, kind: str) -> Column:
    suffix = "meta.json" if kind == "meta" else f"{kind}.json.gz"
    return F.concat(prefix, F.lit(f"/{suffix}"))


def status_from_http(code: Column) -> Column:
    return F.when(code.between(200, 299), "SUCCESS").otherwise("FAILURE")


def status_from_error(code: Column, message: Column) -> Column:
    """Transport error to status. The timeout test comes first."""
    code = F.coalesce(code, F.lit(""))
    message = F.lower(F.coalesce(message, F.lit("")))
    timed_out = code.isin(*contract.TIMEOUT_CODES)
    for word in contract.TIMEOUT_WORDS:
        timed_out = timed_out | F.contains(message, F.lit(word))
    return (
        F.when(timed_out, "TIMEOUT")
        .when(code.isin(*contract.NETWORK_ERROR_CODES), "NETWORK_ERROR")
        .otherwise("FAILURE")
    )


def http_band(code: Column) -> Column:
    return (
        F.when(code == 0, "no_response")
        .when(code < 200, "1xx")
        .when(code < 300, "2xx")
        .when(code < 400, "3xx")
        .when(code < 500, "4xx")
        .otherwise("5xx")
    )


def is_too_long(text: Column, max_bytes: int) -> Column:
    return F.octet_length(text) > max_bytes


def truncate_payload(text: Column, max_bytes: int = contract.MAX_PAYLOAD_BYTES) -> Column:
    """Cut at a byte limit. A character cut in half becomes U+FFFD."""
    head = F.substring(F.encode(text, "UTF-8"), 1, max_bytes)
    cut = F.make_valid_utf8(head.cast("string"))
    return F.when(
        is_too_long(text, max_bytes), F.concat(cut, F.lit(contract.TRUNCATED_SUFFIX))
    ).otherwise(text)


def request_hash(raw_request: Column) -> Column:
    return F.sha2(raw_request, 256)


def lag_seconds(created: Column, ingested: Column) -> Column:
    """Second boundaries crossed between the two times, not elapsed seconds."""
    return F.unix_seconds(ingested) - F.unix_seconds(created)


def ingest_lag(created: Column, ingested: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), lag_seconds(created, ingested))


def minute_of(ts: Column) -> Column:
    return F.date_trunc("MINUTE", ts)


def hot_local_time(ts: Column) -> Column:
    return F.from_utc_timestamp(ts, contract.HOT_TIME_ZONE)


def hot_month(ts: Column) -> Column:
    """Month `yyyyMM` in the hot table's zone; the cold day is in UTC."""
    return F.date_format(hot_local_time(ts), "yyyyMM")


def hot_day(ts: Column) -> Column:
    return F.date_format(hot_local_time(ts), "yyyy-MM-dd")
