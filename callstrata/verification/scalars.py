"""Scalar rules and filters over whole test tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from callstrata import contract
from callstrata.functions import filters, scalars
from callstrata.operators.ingest import (
    camel_name, map_hot_row, parse_messages, skipped_versions, to_messages, truncate_payloads,
    version_gate, wire_rename as rename, with_cold_keys,
)
from callstrata.plans.panels import run_panel
from callstrata.verification.messages import (
    DAY_SQL, PREFIX_SQL, hot_row_select, messages, over_calls, over_wire, wire_events,
)
from callstrata.verification.panels import PANEL_SQL, over_hot
from callstrata.verification.registry import Registry
from callstrata.verification.sample import call_events, hot_events, table

registry = Registry()
QUERIES, SQL = registry.queries, registry.sql
query = registry.query

_WIRE_LIST = ", ".join(contract.WIRE_COLUMNS)


@query(over_wire(f"SELECT {_WIRE_LIST} FROM w"))
def wire_rename(spark, sf_dir):
    producer = wire_events(spark, sf_dir).select(
        *[F.col(name).alias(camel_name(name)) for name in contract.WIRE_COLUMNS])
    return rename(producer)


@query(name="version_gate", sql=over_wire("""SELECT 'kept' AS outcome, 1 AS schema_version, count(*) AS messages FROM w
    WHERE reason IS NULL OR reason NOT IN ('unparseable', 'unsupported_version')
    UNION ALL SELECT 'skipped', schema_version, count(*) FROM w
    WHERE reason = 'unsupported_version' GROUP BY schema_version"""))
def count_versions(spark, sf_dir):
    parsed = parse_messages(messages(spark, sf_dir))
    kept = version_gate(parsed).groupBy("schema_version").agg(F.count("*").alias("messages"))
    skipped = skipped_versions(parsed).withColumnRenamed("skipped", "messages")
    return kept.withColumn("outcome", F.lit("kept")).unionByName(
        skipped.withColumn("outcome", F.lit("skipped")))


@query(name="map_hot_row", sql=over_wire(hot_row_select(", delivery")))
def map_rows(spark, sf_dir):
    good = parse_messages(messages(spark, sf_dir)).where("reason IS NULL")
    return map_hot_row(with_cold_keys(good))


@query(over_wire("""SELECT loan_lifecycle_stage, count(*) AS messages,
    loan_lifecycle_stage <> 'NOT_A_STAGE' AS allowed FROM w
    WHERE event_id % 113 <> 0 AND schema_version = 1 GROUP BY 1"""))
def stage_check(spark, sf_dir):
    known = version_gate(parse_messages(messages(spark, sf_dir)))
    allowed = F.col("loan_lifecycle_stage").isin(*contract.LIFECYCLE_STAGES)
    return known.groupBy("loan_lifecycle_stage", allowed.alias("allowed")).agg(
        F.count("*").alias("messages"))


@query(over_wire(f"""SELECT request_id, delivery, {PREFIX_SQL} || '/request.json.gz' AS request_key,
    {PREFIX_SQL} || '/response.json.gz' AS response_key,
    {PREFIX_SQL} || '/meta.json' AS meta_key FROM w"""))
def cold_path(spark, sf_dir):
    events = wire_events(spark, sf_dir)
    day = scalars.safe_day(F.col("created_at"), F.col("ingested_at"))
    prefix = scalars.cold_prefix(day, F.col("vendor_id"), F.col("endpoint"), F.col("user_id"),
                                 F.col("request_id"))
    return events.select("request_id", "delivery", *[
        scalars.cold_key(prefix, kind).alias(f"{kind}_key")
        for kind in ("request", "response", "meta")])


@query(over_wire(f"SELECT request_id, delivery, {DAY_SQL} AS cold_day FROM w"))
def safe_ymd(spark, sf_dir):
    return wire_events(spark, sf_dir).select(
        "request_id", "delivery",
        scalars.safe_day(F.col("created_at"), F.col("ingested_at")).alias("cold_day"))


@query(r"""SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(
    coalesce(nullif(url, ''), 'unknown'), '^/+', ''), '[^A-Za-z0-9._-]+', '_', 'g'),
    '^_+|_+$', '', 'g'), ''), 'unknown') AS segment FROM pages""")
def sanitize_segment(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", scalars.sanitize_segment(F.col("url")).alias("segment"))


@query("""SELECT event_id, CAST(event_id * 7 % 600 AS INT) AS code,
    CASE WHEN event_id * 7 % 600 BETWEEN 200 AND 299 THEN 'SUCCESS' ELSE 'FAILURE' END AS status
    FROM events""")
def status_from_http(spark, sf_dir):
    code = F.expr("CAST(event_id * 7 % 600 AS INT)")
    return table(spark, sf_dir, "events").select(
        "event_id", code.alias("code"), scalars.status_from_http(code).alias("status"))


_CODES = (*contract.TIMEOUT_CODES, *contract.NETWORK_ERROR_CODES, "EPIPE", "")


@query(over_calls(f"""SELECT request_id, delivery, code, CASE
    WHEN code IN ('ECONNABORTED', 'ETIMEDOUT') OR contains(lower(error_message), 'timeout')
      OR contains(lower(error_message), 'timed out') THEN 'TIMEOUT'
    WHEN code IN ('ECONNREFUSED', 'ENOTFOUND', 'ECONNRESET', 'EHOSTUNREACH', 'ENETUNREACH')
      THEN 'NETWORK_ERROR' ELSE 'FAILURE' END AS category
    FROM (SELECT *, [{', '.join(f"'{code}'" for code in _CODES)}][event_id % {len(_CODES)} + 1]
      AS code FROM c)"""))
def status_from_error(spark, sf_dir):
    codes = F.array(*[F.lit(code) for code in _CODES])
    code = F.element_at(codes, F.expr(f"CAST(event_id % {len(_CODES)} + 1 AS INT)"))
    return call_events(spark, sf_dir).withColumn("code", code).select(
        "request_id", "delivery", "code",
        scalars.status_from_error(F.col("code"), F.col("error_message")).alias("category"))


@query("""SELECT band, count(*) AS events FROM (SELECT CASE WHEN code = 0 THEN 'no_response'
    WHEN code < 200 THEN '1xx' WHEN code < 300 THEN '2xx' WHEN code < 400 THEN '3xx'
    WHEN code < 500 THEN '4xx' ELSE '5xx' END AS band
    FROM (SELECT event_id * 7 % 600 AS code FROM events)) GROUP BY band""")
def http_band(spark, sf_dir):
    band = scalars.http_band(F.expr("event_id * 7 % 600"))
    return table(spark, sf_dir, "events").groupBy(band.alias("band")).agg(
        F.count("*").alias("events"))


_CUT = 301


@query(f"""SELECT doc_id, CASE WHEN strlen(text) <= {_CUT} THEN text ELSE kept ||
      CASE WHEN strlen(kept) < {_CUT} THEN chr(65533) ELSE '' END || '...[TRUNCATED]' END AS payload,
    strlen(text) > {_CUT} AS payload_truncated, sha256(text) AS request_hash
    FROM (SELECT doc_id, text, left(text, list_max(list_filter(range({_CUT} // 4, {_CUT} + 1),
      lambda k: strlen(left(text, k)) <= {_CUT}))) AS kept FROM documents)""")
def truncate_payload(spark, sf_dir):
    """Every document as a request payload, cut at a small limit; hash of the whole."""
    payloads = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("request_payload"), F.lit("null").alias("response_payload"))
    return truncate_payloads(payloads, _CUT).select(
        "doc_id", F.col("request_payload").alias("payload"), "payload_truncated", "request_hash")


@query(over_wire("""SELECT request_id, delivery,
    CASE WHEN strlen(full_body) > 1000 THEN '[OVERSIZED]' ELSE request_payload END AS request_payload,
    CASE WHEN strlen(full_body) > 1000 THEN '[OVERSIZED]' ELSE response_payload END AS response_payload,
    payload_truncated OR strlen(full_body) > 1000 AS payload_truncated
    FROM (SELECT *, '{' || array_to_string(list_filter([
      '"schema_version":' || schema_version, """ + ", ".join(
    f"""'"{name}":' || {'CAST(' + name + ' AS VARCHAR)' if name in ('http_status', 'latency_ms', 'payload_truncated') else 'CAST(to_json(CAST(' + name + ' AS VARCHAR)) AS VARCHAR)'}"""
    for name in contract.WIRE_COLUMNS[1:]) + """], lambda part: part IS NOT NULL), ',') || '}' AS full_body
      FROM w)"""))
def oversize_guard(spark, sf_dir):
    """Messages over 1000 bytes lose their payloads, not their metadata."""
    bodies = to_messages(wire_events(spark, sf_dir), max_bytes=1000)
    return bodies.select("delivery", F.from_json("body", contract.WIRE_SCHEMA).alias("e")).select(
        "e.request_id", "delivery", "e.request_payload", "e.response_payload",
        "e.payload_truncated")


@query("SELECT doc_id, sha256(text) AS request_hash FROM documents")
def request_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", scalars.request_hash(F.col("text")).alias("request_hash"))


@query(over_calls("""SELECT request_id, delivery,
    greatest(0, date_diff('second', created_at, ingested_at)) AS lag_seconds FROM c"""))
def ingest_lag(spark, sf_dir):
    return call_events(spark, sf_dir).select(
        "request_id", "delivery",
        scalars.ingest_lag(F.col("created_at"), F.col("ingested_at")).alias("lag_seconds"))


@query(over_calls("""SELECT date_trunc('minute', created_at) AS minute, count(*) AS events
    FROM c GROUP BY 1"""))
def minute_bucket(spark, sf_dir):
    minute = scalars.minute_of(F.col("created_at"))
    return call_events(spark, sf_dir).groupBy(minute.alias("minute")).agg(
        F.count("*").alias("events"))


@query("""SELECT strftime(ts + INTERVAL 330 MINUTE, '%Y%m') AS ist_month,
    strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d') AS ist_day,
    strftime(ts, '%Y/%m/%d') AS cold_day, count(*) AS events FROM events GROUP BY 1, 2, 3""")
def ist_month(spark, sf_dir):
    """Hot month and day beside the cold day: they can differ."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").groupBy(
        scalars.hot_month(ts).alias("ist_month"), scalars.hot_day(ts).alias("ist_day"),
        F.date_format(ts, "yyyy/MM/dd").alias("cold_day"),
    ).agg(F.count("*").alias("events"))


# -- filters ----------------------------------------------------------------------


@query(over_hot("""SELECT vendor_id, loan_lifecycle_stage, count(*) AS events FROM v
    WHERE vendor_id LIKE '%-b%' AND loan_lifecycle_stage LIKE 'B%_BRE' AND service LIKE '%'
    GROUP BY 1, 2"""))
def like_filter(spark, sf_dir):
    rows = filters.like_filter(
        hot_events(spark, sf_dir), vendor_id="%-b%", loan_lifecycle_stage="B%_BRE", service="%")
    return rows.groupBy("vendor_id", "loan_lifecycle_stage").agg(F.count("*").alias("events"))


@query(over_hot("""SELECT 'created_at' AS clock, count(*) AS events FROM v
    WHERE created_at BETWEEN TIMESTAMP '2024-01-01 02:00:00' AND TIMESTAMP '2024-01-01 05:30:00'
    UNION ALL SELECT 'ingested_at', count(*) FROM v
    WHERE ingested_at BETWEEN TIMESTAMP '2024-01-01 02:00:00' AND TIMESTAMP '2024-01-01 05:30:00'
    UNION ALL SELECT 'last 6 hours', count(*) FROM v
    WHERE created_at BETWEEN TIMESTAMP '2024-01-01 05:00:00' AND TIMESTAMP '2024-01-01 11:00:00'"""))
def time_filter(spark, sf_dir):
    hot = hot_events(spark, sf_dir)
    start, end = "2024-01-01 02:00:00", "2024-01-01 05:30:00"

    def counted(rows, name):
        return rows.agg(F.count("*").alias("events")).withColumn("clock", F.lit(name))

    return (
        counted(filters.time_filter(hot, "created_at", start, end), "created_at")
        .unionByName(counted(filters.time_filter(hot, "ingested_at", start, end), "ingested_at"))
        .unionByName(counted(
            filters.last_hours(hot, "created_at", 6, "2024-01-01 11:00:00"), "last 6 hours"))
    )


_FILTERED = {
    "ops_completeness": {"environment": "prod", "vendor": "%"},
    "fun_vendor_ranking": {"vendor": "%", "service": "payment-api", "stage": "%_BRE"},
    "lat_slow_ranking": {"vendor": "s%", "endpoint": "/p%"},
    "fail_breakdown": {"vendor": "easebuzz", "service": "%-api"},
}
_FILTERED_SQL = {
    "ops_completeness": "environment LIKE 'prod' AND vendor_id LIKE '%'",
    "fun_vendor_ranking": "service LIKE 'payment-api' AND loan_lifecycle_stage LIKE '%_BRE'",
    "lat_slow_ranking": "vendor_id LIKE 's%' AND endpoint LIKE '/p%'",
    "fail_breakdown": "vendor_id LIKE 'easebuzz' AND service LIKE '%-api'",
}


def _filtered(name, variables):
    return lambda spark, sf_dir: run_panel(
        name, hot_events(spark, sf_dir), start="2024-01-01 01:00:00", end="2024-01-01 09:00:00",
        **variables)


for _name, _variables in _FILTERED.items():
    QUERIES[f"{_name}_filtered"] = _filtered(_name, _variables)
    SQL[f"{_name}_filtered"] = over_hot(PANEL_SQL[_name].replace(
        "FROM v", f"""FROM (SELECT * FROM v WHERE {_FILTERED_SQL[_name]} AND created_at
        BETWEEN TIMESTAMP '2024-01-01 01:00:00' AND TIMESTAMP '2024-01-01 09:00:00')"""))
