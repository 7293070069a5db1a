"""Alert rules over the whole sample, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from callstrata.contract import LATENCY_BUCKETS_MS, VENDOR_TIERS
from callstrata.operators.ingest import parse_messages, quarantine_rows
from callstrata.operators.islands import held_for as hold
from callstrata.plans import alerts
from callstrata.sources.audit import parse_audit
from callstrata.verification.archive import AUDIT_BUCKET, AUDIT_SQL, audit_log
from callstrata.verification.messages import messages, over_calls, over_wire
from callstrata.verification.panels import over_hot
from callstrata.verification.registry import Registry
from callstrata.verification.sample import call_events, hot_events

registry = Registry()
QUERIES, SQL = registry.queries, registry.sql
query = registry.query


def members(tier: str) -> str:
    return ", ".join(f"'{vendor}'" for vendor, its in VENDOR_TIERS if its == tier)


def windows_sql(tier: str, size: int, aggregates: str) -> str:
    """Each event copied into the windows that hold it: the plain definition."""
    return f"""SELECT vendor_id, window_end, {aggregates} FROM (
        SELECT v.*, unnest(generate_series(date_trunc('minute', created_at) + INTERVAL 1 MINUTE,
          date_trunc('minute', created_at) + INTERVAL {size} MINUTE, INTERVAL 1 MINUTE))
          AS window_end FROM v WHERE vendor_id IN ({members(tier)}))
        GROUP BY vendor_id, window_end"""


def held_sql(windows: str, value: str, condition: str, minutes: int,
             key: str = "vendor_id") -> str:
    """Runs of true evaluations, by subtracting the row number from the minute."""
    return f"""SELECT {key}, window_end, value, min(window_end) OVER run AS active_since,
        window_end - min(window_end) OVER run >= INTERVAL {minutes} MINUTE AS firing
        FROM (SELECT *, epoch(window_end) / 60 - row_number() OVER (
            PARTITION BY {key} ORDER BY window_end) AS island
          FROM (SELECT {key}, window_end, CAST({value} AS DOUBLE) AS value
            FROM ({windows}) WHERE {condition}))
        WINDOW run AS (PARTITION BY {key}, island ORDER BY window_end)"""


_TIER_VALUES = ", ".join(f"('{vendor}', '{tier}')" for vendor, tier in VENDOR_TIERS)


@query(over_hot(f"""SELECT vendor_id, tier, count(*) AS calls FROM v
    JOIN (VALUES {_TIER_VALUES}) AS t(vendor_id, tier) USING (vendor_id) GROUP BY 1, 2"""))
def vendor_tier(spark, sf_dir):
    tiers = F.broadcast(alerts.vendor_tiers(spark))
    return hot_events(spark, sf_dir).join(tiers, "vendor_id").groupBy("vendor_id", "tier").agg(
        F.count("*").alias("calls"))


FAILURES_SQL = "count(*) FILTER (WHERE status <> 'SUCCESS')"


def _rate_query(name):
    return lambda spark, sf_dir: alerts.alert_failure_rate(hot_events(spark, sf_dir), name)


for _name, _rule in alerts.FAILURE_RATE_RULES.items():
    QUERIES[f"alert_{_name}"] = _rate_query(_name)
    SQL[f"alert_{_name}"] = over_hot(held_sql(
        windows_sql(_rule.tier, _rule.window_minutes,
                    f"{FAILURES_SQL} * 100.0::DOUBLE / count(*) AS rate"),
        "rate", f"rate > {_rule.threshold}", _rule.hold_minutes))


@query(over_hot(held_sql(
    windows_sql("P1", 5, "count(*) AS calls, count(*) FILTER (WHERE status = 'SUCCESS') AS ok"),
    "calls", "ok = 0 AND calls > 0", 1)))
def alert_p1_all_failing(spark, sf_dir):
    return alerts.alert_all_failing(hot_events(spark, sf_dir))


@query(over_hot(held_sql(
    windows_sql("P1", 5, "round(quantile_cont(latency_ms, 0.95), 6) AS p95"),
    "p95", "p95 > 5000", 3)))
def alert_p1_latency(spark, sf_dir):
    return alerts.alert_latency(hot_events(spark, sf_dir))


@query(over_hot(windows_sql("P1", 5, "round(quantile_cont(latency_ms, 0.95), 6) AS p95_ms")))
def p1_latency_windows(spark, sf_dir):
    return alerts.latency_windows(hot_events(spark, sf_dir), "exact")


def _histogram_sql() -> str:
    cases = []
    below_bound, below = 0, "0"
    for le in LATENCY_BUCKETS_MS:
        share = f"(0.95::DOUBLE * n - {below}) / (le_{le} - {below})"
        cases.append(f"WHEN le_{le} >= 0.95::DOUBLE * n THEN {below_bound} + {le - below_bound} * {share}")
        below_bound, below = le, f"le_{le}"
    counts = ", ".join(f"count(*) FILTER (WHERE latency_ms <= {le}) AS le_{le}"
                       for le in LATENCY_BUCKETS_MS)
    return f"""SELECT vendor_id, window_end, round(CASE {' '.join(cases)}
        ELSE {LATENCY_BUCKETS_MS[-1]} END, 6) AS p95_ms
        FROM ({windows_sql('P1', 5, counts + ', count(*) AS n')})"""


@query(over_hot(_histogram_sql()))
def p1_latency_histogram(spark, sf_dir):
    return alerts.latency_windows(hot_events(spark, sf_dir), "histogram")


@query(over_hot(held_sql(_histogram_sql(), "p95_ms", "p95_ms > 5000", 3)))
def alert_p1_latency_histogram(spark, sf_dir):
    """Never fires: the last finite bucket equals the threshold."""
    return alerts.alert_latency(hot_events(spark, sf_dir), "histogram")


@query(over_hot(held_sql(
    windows_sql("P1", 5, "count(*) FILTER (WHERE status = 'TIMEOUT') / 300.0::DOUBLE AS rate"),
    "rate", "rate > 1", 2)))
def alert_p1_timeouts(spark, sf_dir):
    return alerts.alert_timeouts(hot_events(spark, sf_dir))


# The sample has far less than one timeout a second.
@query(over_hot(held_sql(
    windows_sql("P1", 5, "count(*) FILTER (WHERE status = 'TIMEOUT') / 300.0::DOUBLE AS rate"),
    "rate", "rate > 0.003", 2)))
def alert_p1_timeouts_low(spark, sf_dir):
    return alerts.alert_timeouts(hot_events(spark, sf_dir), threshold=0.003)


@query(over_hot(windows_sql("P1", 5, f"""count(*) AS calls,
    count(*) FILTER (WHERE status = 'SUCCESS') AS successes, {FAILURES_SQL} AS failures,
    count(*) FILTER (WHERE status = 'TIMEOUT') AS timeouts""")))
def p1_sliding_calls(spark, sf_dir):
    return alerts.sliding_calls(hot_events(spark, sf_dir), alerts.P1_TIMEOUTS)


# -- quarantine, errors, backlog ---------------------------------------------------

_PARKED_SQL = """SELECT ingested_at AS parked_at, reason FROM w
    WHERE reason IS NOT NULL AND reason <> 'unsupported_version'"""


def parked(spark, sf_dir):
    return quarantine_rows(parse_messages(messages(spark, sf_dir)))


@query(over_wire(f"""SELECT time_bucket(INTERVAL 5 MINUTE, parked_at) + INTERVAL 5 MINUTE
    AS window_end, count(*) AS parked, count(*) > 0 AS firing FROM ({_PARKED_SQL}) GROUP BY 1"""))
def alert_quarantine(spark, sf_dir):
    return alerts.alert_quarantine(parked(spark, sf_dir))


def _error_windows(size: int) -> str:
    return f"""SELECT 'infra' AS tier, window_end, count(*) AS errors FROM (
        SELECT unnest(generate_series(date_trunc('minute', parked_at) + INTERVAL 1 MINUTE,
          date_trunc('minute', parked_at) + INTERVAL {size} MINUTE, INTERVAL 1 MINUTE))
          AS window_end FROM ({_PARKED_SQL})) GROUP BY window_end"""


@query(over_wire(held_sql(_error_windows(5), "errors / 300.0::DOUBLE",
                          "errors / 300.0::DOUBLE > 0.01", 2, "tier")))
def alert_error_rate(spark, sf_dir):
    return alerts.alert_error_rate(parked(spark, sf_dir), threshold=0.01)


@query(over_wire(held_sql(_error_windows(1), "errors", "errors > 1", 1, "tier")))
def alert_errors_per_minute(spark, sf_dir):
    return alerts.alert_error_rate(parked(spark, sf_dir), form="per_minute", threshold=1)


# Every minute beside every event that waits at it: the definition as a range join.
_BACKLOG_SQL = """SELECT minute AS window_end, count(*) AS waiting,
    CAST(max(epoch(minute) - floor(epoch(created_at))) AS BIGINT) AS oldest_age_seconds
    FROM (SELECT unnest(generate_series(
        (SELECT date_trunc('minute', min(created_at)) FROM c),
        (SELECT max(ingested_at) FROM c), INTERVAL 1 MINUTE)) AS minute) m
    JOIN c ON c.created_at <= m.minute AND m.minute < c.ingested_at GROUP BY minute"""


@query(over_calls(_BACKLOG_SQL))
def backlog_by_minute(spark, sf_dir):
    return alerts.backlog(call_events(spark, sf_dir))


@query(over_calls(", s AS (SELECT 'infra' AS tier, * FROM (" + _BACKLOG_SQL + ")) "
    "SELECT *, 'age' AS rule FROM ("
    + held_sql("SELECT * FROM s", "oldest_age_seconds", "oldest_age_seconds > 60", 2, "tier")
    + ") UNION ALL SELECT *, 'depth' AS rule FROM ("
    + held_sql("SELECT * FROM s", "waiting", "waiting > 20", 2, "tier") + ")"
    ).replace(") , s AS", "), s AS"))
def alert_backlog(spark, sf_dir):
    return alerts.alert_backlog(call_events(spark, sf_dir), depth=20)


# -- audit --------------------------------------------------------------------------


@query(f"""SELECT time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end,
    count(*) AS reads, count(*) > 20 AS firing FROM ({AUDIT_SQL})
    WHERE event_name = 'GetObject' AND bucket = 'archive' GROUP BY 1""")
def alert_read_spike(spark, sf_dir):
    return alerts.alert_read_spike(parse_audit(audit_log(spark, sf_dir)), AUDIT_BUCKET, 20)


@query(f"""SELECT event_time, object_key, user_name FROM ({AUDIT_SQL})
    WHERE event_name = 'PutObjectLegalHold' AND hold_status = 'OFF' AND bucket = 'archive'""")
def alert_hold_removed(spark, sf_dir):
    return alerts.alert_hold_removed(parse_audit(audit_log(spark, sf_dir)), AUDIT_BUCKET)


@query(over_hot(held_sql(
    """SELECT vendor_id, date_trunc('minute', created_at) AS window_end, count(*) AS calls
       FROM v GROUP BY 1, 2""", "calls", "calls >= 2", 3)))
def held_for(spark, sf_dir):
    """Vendors with two or more calls in every minute for three minutes."""
    minutes = hot_events(spark, sf_dir).groupBy(
        "vendor_id", F.date_trunc("MINUTE", "created_at").alias("window_end")
    ).agg(F.count("*").alias("calls"))
    judged = minutes.select(
        "vendor_id", "window_end", F.col("calls").cast("double").alias("value"),
        (F.col("calls") >= 2).alias("breaching"))
    return hold(judged, ["vendor_id"], 3).drop("breaching")
