"""Fixed cases for the scalar rules."""

import pytest
from pyspark.sql import functions as F

from callstrata.functions import scalars
from callstrata.operators.ingest import camel_name, truncate_payloads


def value_of(spark, column):
    return spark.range(1).select(column.alias("out")).first().out


def text(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize("value, expected", [
    ("/kyc/verify", "kyc_verify"), ("bureau-pull", "bureau-pull"), ("", "unknown"),
    (None, "unknown"), ("acct/99 x", "acct_99_x"), ("///", "unknown"), ("__a__b__", "a__b"),
    ("é/ü", "unknown"), ("/v1.2/a_b-c", "v1.2_a_b-c"),
])
def test_segment(spark, value, expected):
    assert value_of(spark, scalars.sanitize_segment(text(value))) == expected


@pytest.mark.parametrize("value, expected", [
    ("2026-05-29T08:30:00.000Z", "2026/05/29"), ("2026-05-29T23:59:59.999+05:30", "2026/05/29"),
    ("2026-05-30T01:00:00+05:30", "2026/05/29"), ("not-a-date", "2020/01/02"),
    ("", "2020/01/02"), (None, "2020/01/02"),
])
def test_day(spark, value, expected):
    fallback = F.lit("2020-01-02 00:00:00").cast("timestamp")
    assert value_of(spark, scalars.safe_day(text(value), fallback)) == expected


def test_cold_key(spark):
    prefix = scalars.cold_prefix(text("2026/05/29"), text("karza"), text("/kyc/verify"),
                                 text(""), text("r-1"))
    assert value_of(spark, scalars.cold_key(prefix, "request")) == (
        "2026/05/29/karza/kyc_verify/unknown/r-1/request.json.gz")
    assert value_of(spark, scalars.cold_key(prefix, "meta")).endswith("/r-1/meta.json")


@pytest.mark.parametrize("code, expected", [
    (200, "SUCCESS"), (299, "SUCCESS"), (300, "FAILURE"), (422, "FAILURE"), (503, "FAILURE"),
    (0, "FAILURE"), (None, "FAILURE"),
])
def test_status_from_http(spark, code, expected):
    assert value_of(spark, scalars.status_from_http(F.lit(code).cast("int"))) == expected


@pytest.mark.parametrize("code, message, expected", [
    ("ECONNABORTED", "", "TIMEOUT"), ("ETIMEDOUT", None, "TIMEOUT"),
    ("ECONNREFUSED", "", "NETWORK_ERROR"), ("ENOTFOUND", "", "NETWORK_ERROR"),
    ("ECONNRESET", "Timeout of 30s", "TIMEOUT"), ("", "request TIMED OUT", "TIMEOUT"),
    (None, None, "FAILURE"), ("EOTHER", "boom", "FAILURE"),
])
def test_status_from_error(spark, code, message, expected):
    assert value_of(spark, scalars.status_from_error(text(code), text(message))) == expected


@pytest.mark.parametrize("code, expected", [
    (0, "no_response"), (101, "1xx"), (204, "2xx"), (302, "3xx"), (404, "4xx"), (500, "5xx"),
    (999, "5xx"),
])
def test_band(spark, code, expected):
    assert value_of(spark, scalars.http_band(F.lit(code))) == expected


def test_truncation_cuts_bytes_and_marks_halves(spark):
    assert value_of(spark, scalars.truncate_payload(text("aé"), 2)) == "a�...[TRUNCATED]"
    assert value_of(spark, scalars.truncate_payload(text("aé"), 3)) == "aé"
    assert value_of(spark, scalars.truncate_payload(text("abcd"), 3)) == "abc...[TRUNCATED]"


def test_truncation_flags_and_hashes_the_whole(spark):
    frame = spark.createDataFrame(
        [("x" * 20, "y"), ("x", "y"), ("x", "y" * 20)], "request_payload string, response_payload string")
    rows = truncate_payloads(frame, 10).collect()
    assert [row.payload_truncated for row in rows] == [True, False, True]
    whole = value_of(spark, F.sha2(text("x" * 20), 256))
    assert rows[0].request_hash == whole
    assert rows[0].request_payload == "x" * 10 + "...[TRUNCATED]"


def test_lag_counts_boundaries(spark):
    at = lambda value: F.lit(value).cast("timestamp")
    assert value_of(spark, scalars.ingest_lag(
        at("2024-01-01 00:00:00.999"), at("2024-01-01 00:00:01.001"))) == 1
    assert value_of(spark, scalars.ingest_lag(
        at("2024-01-01 00:00:05"), at("2024-01-01 00:00:01"))) == 0
    assert value_of(spark, scalars.lag_seconds(
        at("2024-01-01 00:00:05"), at("2024-01-01 00:00:01"))) == -4


def test_two_calendars(spark):
    at = F.lit("2024-01-31 20:00:00").cast("timestamp")
    assert value_of(spark, scalars.hot_month(at)) == "202402"
    assert value_of(spark, F.date_format(at, "yyyyMM")) == "202401"


@pytest.mark.parametrize("snake, camel", [
    ("aadhaar_last4_hash", "aadhaarLast4Hash"), ("mobile_last4", "mobileLast4"),
    ("status", "status"), ("loan_lifecycle_stage", "loanLifecycleStage"),
])
def test_camel_names(snake, camel):
    assert camel_name(snake) == camel
