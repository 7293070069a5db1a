"""Panels and filter variables with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from callstrata.plans.levels import LEVELS, with_level
from callstrata.plans.panels import PANELS, run_panel
from callstrata.plans.variables import VARIABLES, var_values
from callstrata.verification.sample import DUCKDB_HOT_EVENTS, hot_events

_MINUTE = "date_trunc('minute', created_at) AS time"
_LAG = "greatest(0, date_diff('second', created_at, ingested_at))"
_FAILED = "status IN ('FAILURE', 'TIMEOUT', 'NETWORK_ERROR')"
_PII = " OR ".join(
    f"regexp_matches({column}, '{shape}')"
    for shape in ("[A-Z]{5}[0-9]{4}[A-Z]", "[6-9][0-9]{9}")
    for column in ("request_payload", "response_payload")
)


def _count_if(condition: str, name: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT) AS {name}"


def _percent(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) * 100.0::DOUBLE / count(*)"


def _rate(condition: str, name: str) -> str:
    return f"CASE WHEN count(*) = 0 THEN 0.0::DOUBLE ELSE round({_percent(condition)}, 2) END AS {name}"


def _q(value: str, q: float, name: str) -> str:
    return f"round(quantile_cont({value}, {q}), 6) AS {name}"


def _missing(column: str, name: str) -> str:
    return _count_if(f"{column} = ''", name)


PANEL_SQL = {
    "ops_events": "SELECT count(*) AS events FROM v",
    "ops_lag_p95": f"SELECT {_q(_LAG, 0.95, 'p95_lag_seconds')} FROM v",
    "ops_dup_ids": """SELECT count(*) AS duplicate_request_ids FROM
        (SELECT request_id FROM v GROUP BY request_id HAVING count(*) > 1)""",
    "ops_truncated": f"SELECT {_count_if('payload_truncated = 1', 'truncated_payloads')} FROM v",
    "ops_missing_keys": "SELECT " + _count_if(
        "s3_request_key = '' OR s3_response_key = ''", "rows_missing_s3_keys") + " FROM v",
    "ops_possible_pii": f"SELECT {_count_if(_PII, 'possible_pii_rows')} FROM v",
    "ops_insert_rate": """SELECT date_trunc('minute', ingested_at) AS time, environment,
        count(*) AS rows FROM v GROUP BY 1, 2""",
    "ops_lag_by_minute": f"""SELECT {_MINUTE}, vendor_id, {_q(_LAG, 0.95, 'p95_lag_seconds')}
        FROM v GROUP BY 1, 2""",
    "ops_latency_by_vendor": f"""SELECT {_MINUTE}, vendor_id, {_q('latency_ms', 0.95, 'p95_ms')}
        FROM v GROUP BY 1, 2""",
    "ops_error_mix": f"""SELECT {_MINUTE}, status, count(*) AS calls FROM v
        WHERE status <> 'SUCCESS' GROUP BY 1, 2""",
    "ops_completeness": f"""SELECT vendor_id, count(*) AS rows,
        {_missing('user_id', 'missing_user_id')},
        {_count_if('loan_application_number IS NULL', 'missing_lan')},
        {_missing('request_hash', 'missing_request_hash')},
        {_count_if("s3_request_key = '' OR s3_response_key = ''", 'missing_s3_key')},
        {_missing('pan_masked', 'missing_pan_mask')},
        {_missing('mobile_hash', 'missing_mobile_hash')},
        {_missing('aadhaar_last4_hash', 'missing_aadhaar_hash')}
        FROM v GROUP BY vendor_id""",
    "ops_slowest_endpoints": f"""SELECT vendor_id, endpoint, count(*) AS calls,
        round(avg(latency_ms), 0) AS avg_ms, {_q('latency_ms', 0.5, 'p50_ms')},
        {_q('latency_ms', 0.95, 'p95_ms')}, {_q('latency_ms', 0.99, 'p99_ms')},
        max(latency_ms) AS max_ms FROM v GROUP BY 1, 2 HAVING count(*) >= 3
        ORDER BY p95_ms DESC, vendor_id, endpoint LIMIT 50""",
    "ops_dup_deliveries": """SELECT request_id, min(vendor_id) AS vendor_id,
        min(endpoint) AS endpoint, min(created_at) AS first_seen,
        max(ingested_at) AS last_ingested, count(*) AS copies FROM v GROUP BY request_id
        HAVING count(*) > 1 ORDER BY copies DESC, last_ingested DESC, request_id LIMIT 100""",
    "ops_watchlist": f"""SELECT created_at, vendor_id, endpoint, request_id, pan_masked,
        mobile_last4, payload_truncated, strlen(request_payload) AS request_payload_bytes,
        strlen(response_payload) AS response_payload_bytes FROM v
        WHERE {_PII} OR payload_truncated = 1 ORDER BY created_at DESC, request_id LIMIT 100""",
    "fun_calls": "SELECT count(*) AS calls FROM v",
    "fun_success_rate": f"""SELECT {_rate("status = 'SUCCESS'", 'success_rate')} FROM v""",
    "fun_impacted_users": """SELECT count(DISTINCT user_id) AS users FROM v
        WHERE user_id <> '' AND status <> 'SUCCESS'""",
    "fun_impacted_loans": """SELECT count(DISTINCT loan_application_number) AS loan_apps FROM v
        WHERE loan_application_number IS NOT NULL AND status <> 'SUCCESS'""",
    "fun_transport_errors": "SELECT " + _count_if(
        "status IN ('TIMEOUT', 'NETWORK_ERROR')", "transport_errors") + " FROM v",
    "fun_p95": f"SELECT {_q('latency_ms', 0.95, 'p95_ms')} FROM v",
    "fun_volume": f"SELECT {_MINUTE}, vendor_id, count(*) AS calls FROM v GROUP BY 1, 2",
    "fun_success_by_vendor": f"""SELECT {_MINUTE}, vendor_id,
        {_percent("status = 'SUCCESS'")} AS success_rate FROM v GROUP BY 1, 2""",
    "fun_stage_health": f"""SELECT loan_lifecycle_stage AS stage, count(*) AS calls,
        count(DISTINCT user_id) AS users, count(DISTINCT loan_application_number) AS loan_apps,
        {_count_if("status = 'SUCCESS'", 'successes')},
        {_count_if("status <> 'SUCCESS'", 'failures')},
        round({_percent("status = 'SUCCESS'")}, 2) AS success_rate,
        round(round(quantile_cont(latency_ms, 0.95), 6), 0) AS p95_ms FROM v GROUP BY 1""",
    "fun_vendor_ranking": f"""SELECT vendor_id, count(*) AS calls,
        {_count_if("status = 'SUCCESS'", 'successes')},
        {_count_if("status <> 'SUCCESS'", 'failures')},
        round({_percent("status = 'SUCCESS'")}, 2) AS success_rate,
        round(round(quantile_cont(latency_ms, 0.95), 6), 0) AS p95_ms,
        round(avg(latency_ms), 0) AS avg_ms FROM v GROUP BY 1""",
    "fun_top_failing": """SELECT vendor_id, endpoint, status, count(*) AS failures,
        count(DISTINCT user_id) AS impacted_users, round(avg(latency_ms), 0) AS avg_ms FROM v
        WHERE status <> 'SUCCESS' GROUP BY 1, 2, 3
        ORDER BY failures DESC, vendor_id, endpoint, status LIMIT 50""",
    "fun_recent_failed": """SELECT created_at, service, vendor_id, endpoint,
        loan_lifecycle_stage AS stage, loan_application_number, user_id, status, http_status,
        latency_ms, error_code, error_message, request_id FROM v WHERE status <> 'SUCCESS'
        ORDER BY created_at DESC, request_id, latency_ms LIMIT 100""",
    "lat_p50": f"SELECT {_q('latency_ms', 0.5, 'p50_ms')} FROM v",
    "lat_p95": f"SELECT {_q('latency_ms', 0.95, 'p95_ms')} FROM v",
    "lat_p99": f"SELECT {_q('latency_ms', 0.99, 'p99_ms')} FROM v",
    "lat_max": "SELECT max(latency_ms) AS max_ms FROM v",
    "lat_p95_by_vendor": f"""SELECT {_MINUTE}, vendor_id, {_q('latency_ms', 0.95, 'p95_ms')}
        FROM v GROUP BY 1, 2""",
    "lat_quantiles": f"""SELECT {_MINUTE}, {_q('latency_ms', 0.5, 'p50_ms')},
        {_q('latency_ms', 0.95, 'p95_ms')}, {_q('latency_ms', 0.99, 'p99_ms')}
        FROM v GROUP BY 1""",
    "lat_timeouts": f"""SELECT {_MINUTE}, vendor_id, count(*) AS timeouts FROM v
        WHERE status = 'TIMEOUT' GROUP BY 1, 2""",
    "lat_slow_ranking": f"""SELECT vendor_id, endpoint, count(*) AS calls,
        {_q('latency_ms', 0.5, 'p50_ms')}, {_q('latency_ms', 0.95, 'p95_ms')},
        {_q('latency_ms', 0.99, 'p99_ms')}, max(latency_ms) AS max_ms,
        {_count_if("status = 'TIMEOUT'", 'timeouts')} FROM v GROUP BY 1, 2
        ORDER BY p95_ms DESC, vendor_id, endpoint LIMIT 50""",
    "fail_rate": f"SELECT {_rate(_FAILED, 'failure_rate')} FROM v",
    "fail_calls": f"SELECT {_count_if(_FAILED, 'failed_calls')} FROM v",
    "fail_timeout_rate": f"""SELECT {_rate("status = 'TIMEOUT'", 'timeout_rate')} FROM v""",
    "fail_network_rate": "SELECT " + _rate(
        "status = 'NETWORK_ERROR'", "network_error_rate") + " FROM v",
    "fail_rate_by_vendor": f"""SELECT {_MINUTE}, vendor_id, {_percent(_FAILED)} AS failure_rate
        FROM v GROUP BY 1, 2""",
    "fail_by_status": f"""SELECT {_MINUTE}, status, count(*) AS calls FROM v
        WHERE status <> 'SUCCESS' GROUP BY 1, 2""",
    "fail_breakdown": """SELECT vendor_id, endpoint, status, http_status, error_code,
        count(*) AS calls, count(DISTINCT user_id) AS impacted_users,
        round(avg(latency_ms), 0) AS avg_latency_ms FROM v WHERE status <> 'SUCCESS'
        GROUP BY 1, 2, 3, 4, 5
        ORDER BY calls DESC, vendor_id, endpoint, status, http_status, error_code LIMIT 100""",
    "fail_recent": """SELECT created_at, service, vendor_id, endpoint, status, http_status,
        latency_ms, error_code, error_message, user_id, loan_application_number, request_id
        FROM v WHERE status <> 'SUCCESS' ORDER BY created_at DESC, request_id, latency_ms
        LIMIT 100""",
}


def over_hot(sql: str) -> str:
    """SQL over the hot table, named v."""
    return f"WITH v AS ({DUCKDB_HOT_EVENTS}) {sql}"


QUERIES = {}
SQL = {}


def _panel_query(name):
    return lambda spark, sf_dir: run_panel(name, hot_events(spark, sf_dir))


for _name in PANELS:
    QUERIES[_name] = _panel_query(_name)
    SQL[_name] = over_hot(PANEL_SQL[_name])


# -- levels ---------------------------------------------------------------------


def _level_query(spark, sf_dir):
    """All single-value panels with a colour, one row each."""
    hot = hot_events(spark, sf_dir)
    rows = None
    for name, (column, _) in LEVELS.items():
        row = with_level(name, run_panel(name, hot)).select(
            F.lit(name).alias("panel"), F.col(column).cast("double").alias("value"), "level")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def _level_sql():
    parts = []
    for name, (column, (base, *steps)) in LEVELS.items():
        colour = f"'{base}'"
        for step, at_least in steps:
            colour = f"CASE WHEN value >= {at_least} THEN '{step}' ELSE {colour} END"
        parts.append(f"""SELECT '{name}' AS panel, value, {colour} AS level
            FROM (SELECT CAST({column} AS DOUBLE) AS value FROM ({PANEL_SQL[name]}))""")
    return over_hot(" UNION ALL ".join(parts))


QUERIES["panel_level"] = _level_query
SQL["panel_level"] = _level_sql()


# -- filter variables -----------------------------------------------------------


def _variable_query(column):
    return lambda spark, sf_dir: var_values(hot_events(spark, sf_dir), column)


for _board, _columns in VARIABLES.items():
    for _column in _columns:
        _key = f"var_values_{_board}_{_column}"
        QUERIES[_key] = _variable_query(_column)
        SQL[_key] = over_hot(f"SELECT DISTINCT {_column} FROM v ORDER BY 1")
