"""Rollups, vendor views, counters, lookups and panels on other sources."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from callstrata import contract
from callstrata.operators import lookups, retention, rollup
from callstrata.operators.dedup import hot_final
from callstrata.plans.panels import PANELS, run_panel
from callstrata.session import fresh_path
from callstrata.sources.hot import HotTable
from callstrata.sources.rollups import RollupTable
from callstrata.verification.archive import CUT_SQL, FINAL_SQL, clock_after
from callstrata.verification.messages import over_calls
from callstrata.verification.panels import PANEL_SQL, over_hot
from callstrata.verification.registry import Registry
from callstrata.verification.sample import call_events, hot_events

registry = Registry()
QUERIES, SQL = registry.queries, registry.sql
query = registry.query

ROLLUP_SQL = """SELECT date_trunc('minute', created_at) AS window_start, vendor_id, endpoint,
    service, status, count(*) AS total, CAST(sum(latency_ms) AS BIGINT) AS total_latency
    FROM v GROUP BY 1, 2, 3, 4, 5"""


@query(over_hot(ROLLUP_SQL))
def rollup_1m(spark, sf_dir):
    return rollup.rollup_1m(hot_events(spark, sf_dir))


@query(over_hot(ROLLUP_SQL))
def rollup_merge(spark, sf_dir):
    """Partial sums of two inserts, on disk, added up."""
    rows = hot_events(spark, sf_dir)
    table = RollupTable(spark, fresh_path(spark, "rollup"))
    noon = F.lit("2024-01-01 06:00:30").cast("timestamp")
    table.add(rows.where(F.col("ingested_at") < noon), "batch-0")
    table.add(rows.where(F.col("ingested_at") >= noon), "batch-1")
    return table.merged()


@query(over_hot(f"SELECT * FROM ({ROLLUP_SQL}) WHERE window_start > {CUT_SQL}"))
def expire_rollup(spark, sf_dir):
    return retention.expire_rollup(
        rollup.rollup_1m(hot_events(spark, sf_dir)), clock_after(contract.ROLLUP_RETENTION_DAYS))


def _vendor_view(vendor):
    return lambda spark, sf_dir: rollup.vendor_view(
        hot_events(spark, sf_dir), vendor).select(*contract.HOT_COLUMNS)


for _view, _vendor in rollup.vendor_view_names().items():
    QUERIES[_view] = _vendor_view(_vendor)
    SQL[_view] = over_hot(
        f"SELECT {', '.join(contract.HOT_COLUMNS)} FROM v WHERE vendor_id = '{_vendor}'")


@query(over_hot("""SELECT vendor_id, endpoint, status, CASE WHEN http_status = 0 THEN 'no_response'
    WHEN http_status < 200 THEN '1xx' WHEN http_status < 300 THEN '2xx'
    WHEN http_status < 400 THEN '3xx' WHEN http_status < 500 THEN '4xx' ELSE '5xx' END
    AS http_status, count(*) AS calls FROM v GROUP BY 1, 2, 3, 4"""))
def calls_total(spark, sf_dir):
    return rollup.calls_total(hot_events(spark, sf_dir))


@query(over_hot("SELECT vendor_id, endpoint, status, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE latency_ms <= {le}) AS BIGINT) AS le_{le}"
    for le in contract.LATENCY_BUCKETS_MS) + """, count(*) AS le_inf,
    CAST(sum(latency_ms) AS BIGINT) AS latency_sum FROM v GROUP BY 1, 2, 3"""))
def latency_histogram(spark, sf_dir):
    return rollup.latency_histogram(hot_events(spark, sf_dir))


# -- panels over the deduplicated view and the rollup -------------------------------

_FINAL_PANELS = (
    "ops_events", "ops_dup_ids", "fun_vendor_ranking", "fun_stage_health", "lat_quantiles",
    "fail_rate_by_vendor", "fail_recent",
)


def _final_panel(name):
    return lambda spark, sf_dir: run_panel(name, hot_final(hot_events(spark, sf_dir)))


for _name in _FINAL_PANELS:
    QUERIES[f"{_name}_final"] = _final_panel(_name)
    SQL[f"{_name}_final"] = over_hot(PANEL_SQL[_name].replace("FROM v", f"FROM ({FINAL_SQL})"))


def _rollup_panel(name):
    return lambda spark, sf_dir: run_panel(
        name, rollup.rollup_1m(hot_events(spark, sf_dir)), from_rollup=True)


for _name, _panel in PANELS.items():
    if _panel.additive:
        QUERIES[f"{_name}_rollup"] = _rollup_panel(_name)
        SQL[f"{_name}_rollup"] = over_hot(PANEL_SQL[_name])


# -- lookups ------------------------------------------------------------------------

_HOT_LIST = ", ".join(contract.HOT_COLUMNS)
_LOOKUPS = {
    "user_id": "user-42", "loan_application_number": "LAN-42", "pan_masked": "ABC****94F",
    "status": "TIMEOUT",
    "mobile_hash": hashlib.sha256(b"+919000000194").hexdigest(),
}


def _stored_hot(spark, sf_dir):
    """The hot table on disk, with its bloom filters."""
    hot = HotTable(spark, fresh_path(spark, "hot"), distinct_per_group=10_000)
    hot.write(hot_events(spark, sf_dir), "batch-0")
    return hot.raw()


@query(over_hot(f"""SELECT {_HOT_LIST} FROM v
    WHERE request_id = '00000000-0000-4000-8000-000000000194'"""))
def find_event(spark, sf_dir):
    return lookups.find_event(
        _stored_hot(spark, sf_dir), "00000000-0000-4000-8000-000000000194"
    ).select(*contract.HOT_COLUMNS)


def _find_by(column, value):
    return lambda spark, sf_dir: lookups.find_by(
        hot_events(spark, sf_dir), column, value).select(*contract.HOT_COLUMNS)


for _column, _value in _LOOKUPS.items():
    QUERIES[f"find_by_{_column}"] = _find_by(_column, _value)
    SQL[f"find_by_{_column}"] = over_hot(f"SELECT {_HOT_LIST} FROM v WHERE {_column} = '{_value}'")


@query(over_hot("""SELECT request_id, vendor_id, endpoint, status, latency_ms, created_at FROM v
    ORDER BY created_at DESC, request_id, latency_ms LIMIT 10"""))
def latest_n(spark, sf_dir):
    return lookups.latest_n(hot_events(spark, sf_dir), 10)


_HOUR_SQL = """SELECT vendor_id, status, count(*) AS calls FROM v
    WHERE created_at >= TIMESTAMP '2024-01-01 10:30:00' - INTERVAL 1 HOUR GROUP BY 1, 2"""


@query(over_hot(_HOUR_SQL))
def vendor_status_1h(spark, sf_dir):
    now = F.lit("2024-01-01 10:30:00").cast("timestamp")
    return lookups.vendor_status_1h(hot_events(spark, sf_dir), now)


@query(over_hot(_HOUR_SQL))
def vendor_status_1h_by_calls(spark, sf_dir):
    now = F.lit("2024-01-01 10:30:00").cast("timestamp")
    return lookups.vendor_status_1h(hot_events(spark, sf_dir), now, order="calls")


@query(over_hot("""SELECT max(created_at) AS latest_event, max(ingested_at) AS latest_ingest,
    round(quantile_cont(date_diff('second', created_at, ingested_at), 0.95), 6)
    AS p95_ingest_lag_seconds FROM v"""))
def freshness(spark, sf_dir):
    return lookups.freshness(hot_events(spark, sf_dir))


@query(over_calls("SELECT count(*) AS events FROM c"))
def count_all(spark, sf_dir):
    return lookups.count_all(call_events(spark, sf_dir))
