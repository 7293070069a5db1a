"""The 42 dashboard panels as DataFrame queries over the hot table.

Each panel reads rows of the hot table (or, where only counts are needed, of the
minute rollup), after the filters of its board. Where the order of a top-k list
could tie, group keys or all shown columns are the last sort keys.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from callstrata.contract import FAILED_STATUSES, TRANSPORT_ERROR_STATUSES
from callstrata.functions.filters import EVERYTHING, like_filter, time_filter
from callstrata.functions.masking import may_hold_pii
from callstrata.functions.quantiles import quantile, value_counts, weighted_quantile
from callstrata.functions.scalars import ingest_lag, minute_of

# Variables of each board: name in the dashboard to column of the hot table.
BOARDS = {
    "ops": {"environment": "environment", "vendor": "vendor_id"},
    "fun": {"vendor": "vendor_id", "service": "service", "stage": "loan_lifecycle_stage"},
    "lat": {"vendor": "vendor_id", "endpoint": "endpoint"},
    "fail": {"vendor": "vendor_id", "service": "service"},
}


@dataclass(frozen=True)
class Panel:
    name: str
    build: Callable[..., DataFrame]
    time_column: str
    additive: bool
    takes_mode: bool

    @property
    def board(self) -> str:
        return self.name.split("_", 1)[0]


PANELS: dict[str, Panel] = {}


def panel(time_column: str = "created_at", additive: bool = False, quantiles: bool = False):
    """Register a panel. Additive panels can also read the minute rollup."""

    def wrap(build):
        PANELS[build.__name__] = Panel(build.__name__, build, time_column, additive, quantiles)
        return build

    return wrap


def run_panel(name: str, rows: DataFrame, *, start=None, end=None, mode: str = "exact",
              from_rollup: bool = False, **variables: str) -> DataFrame:
    """One panel over `rows`, with its board's filters.

    `rows` is the hot table with every delivery, its deduplicated view, or, with
    from_rollup=True, the minute rollup. Rollup rows are added up by the panel, so
    partial sums need not be merged first.
    """
    chosen = PANELS[name]
    columns = BOARDS[chosen.board]
    unknown = set(variables) - set(columns)
    if unknown:
        raise ValueError(f"{name} has no variable {sorted(unknown)}")
    if from_rollup:
        if not chosen.additive:
            raise ValueError(f"{name} needs single events, the rollup holds counts only")
        rows = rows.withColumnRenamed("window_start", "created_at")
    wanted = {columns[key]: pattern for key, pattern in variables.items()
              if pattern != EVERYTHING}
    missing = set(wanted) - set(rows.columns)
    if missing:
        raise ValueError(f"the rollup cannot filter on {sorted(missing)}")
    rows = like_filter(time_filter(rows, chosen.time_column, start, end), **wanted)
    if chosen.additive:
        rows = rows.withColumn("_calls", F.col("total") if from_rollup else F.lit(1))
    return chosen.build(rows, mode=mode) if chosen.takes_mode else chosen.build(rows)


# -- shared pieces ----------------------------------------------------------

# Functions, because a column cannot be built before there is a session.


def minute() -> Column:
    return minute_of(F.col("created_at"))


def succeeded() -> Column:
    return F.col("status") == "SUCCESS"


def not_succeeded() -> Column:
    return F.col("status") != "SUCCESS"


def failed() -> Column:
    return F.col("status").isin(*FAILED_STATUSES)


def keys_missing() -> Column:
    return (F.col("s3_request_key") == "") | (F.col("s3_response_key") == "")


def lag() -> Column:
    return ingest_lag(F.col("created_at"), F.col("ingested_at"))


def latency() -> Column:
    return F.col("latency_ms")


def suspect() -> Column:
    return may_hold_pii(F.col("request_payload"), F.col("response_payload"))


def counted_rows() -> Column:
    return F.sum("_rows")


def average() -> Column:
    return F.sum(F.col("_value") * F.col("_rows")) / counted_rows()


def _calls(condition: Column | None = None) -> Column:
    """Number of calls, counting a rollup row as often as it stands for."""
    counted = F.col("_calls") if condition is None else F.when(condition, F.col("_calls"))
    return F.coalesce(F.sum(counted), F.lit(0)).cast("bigint")


def _percent(part: Column, whole: Column) -> Column:
    return part * 100.0 / whole


def _rate(condition: Column) -> Column:
    """Share of calls in percent with two decimals, 0 when there are none."""
    return F.when(_calls() == 0, F.lit(0.0)).otherwise(
        F.round(_percent(_calls(condition), _calls()), 2)
    )


def _per_minute(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(minute().alias("time"), *keys)


def _minute_quantiles(rows: DataFrame, keys: list[str], value: Column, named: dict[str, float],
                      mode: str) -> DataFrame:
    timed = rows.withColumn("time", minute())
    return quantile(timed, ["time", *keys], value, named, mode).orderBy("time", *keys)


# -- operations and data quality ---------------------------------------------


@panel(additive=True)
def ops_events(rows):
    return rows.agg(_calls().alias("events"))


@panel(quantiles=True)
def ops_lag_p95(rows, mode):
    return quantile(rows, [], lag(), {"p95_lag_seconds": 0.95}, mode)


@panel()
def ops_dup_ids(rows):
    repeated = rows.groupBy("request_id").count().where("count > 1")
    return repeated.agg(F.count("*").alias("duplicate_request_ids"))


@panel()
def ops_truncated(rows):
    return rows.agg(F.count_if(F.col("payload_truncated") == 1).alias("truncated_payloads"))


@panel()
def ops_missing_keys(rows):
    return rows.agg(F.count_if(keys_missing()).alias("rows_missing_s3_keys"))


@panel()
def ops_possible_pii(rows):
    return rows.agg(F.count_if(suspect()).alias("possible_pii_rows"))


@panel(time_column="ingested_at")
def ops_insert_rate(rows):
    arrival = minute_of(F.col("ingested_at")).alias("time")
    return rows.groupBy(arrival, "environment").agg(F.count("*").alias("rows")).orderBy(
        "time", "environment")


@panel(quantiles=True)
def ops_lag_by_minute(rows, mode):
    return _minute_quantiles(rows, ["vendor_id"], lag(), {"p95_lag_seconds": 0.95}, mode)


@panel(quantiles=True)
def ops_latency_by_vendor(rows, mode):
    return _minute_quantiles(rows, ["vendor_id"], latency(), {"p95_ms": 0.95}, mode)


@panel(additive=True)
def ops_error_mix(rows):
    return _per_minute(rows.where(not_succeeded()), "status").agg(
        _calls().alias("calls")).orderBy("time", "status")


@panel()
def ops_completeness(rows):
    def missing(column):
        return F.count_if(F.col(column) == "")

    return rows.groupBy("vendor_id").agg(
        F.count("*").alias("rows"),
        missing("user_id").alias("missing_user_id"),
        F.count_if(F.col("loan_application_number").isNull()).alias("missing_lan"),
        missing("request_hash").alias("missing_request_hash"),
        F.count_if(keys_missing()).alias("missing_s3_key"),
        missing("pan_masked").alias("missing_pan_mask"),
        missing("mobile_hash").alias("missing_mobile_hash"),
        missing("aadhaar_last4_hash").alias("missing_aadhaar_hash"),
    ).orderBy(F.desc("rows"), "vendor_id")


@panel()
def ops_slowest_endpoints(rows):
    keys = ["vendor_id", "endpoint"]
    return (
        value_counts(rows, keys, latency())
        .groupBy(*keys)
        .agg(
            counted_rows().alias("calls"),
            F.round(average(), 0).alias("avg_ms"),
            weighted_quantile(0.50).alias("p50_ms"),
            weighted_quantile(0.95).alias("p95_ms"),
            weighted_quantile(0.99).alias("p99_ms"),
            F.max("_value").alias("max_ms"),
        )
        .where("calls >= 3")
        .orderBy(F.desc("p95_ms"), *keys)
        .limit(50)
    )


@panel()
def ops_dup_deliveries(rows):
    worst = (
        rows.groupBy("request_id")
        .agg(
            F.min("created_at").alias("first_seen"),
            F.max("ingested_at").alias("last_ingested"),
            F.count("*").alias("copies"),
        )
        .where("copies > 1")
        .orderBy(F.desc("copies"), F.desc("last_ingested"), "request_id")
        .limit(100)
    )
    # Names are looked up for the 100 ids only: the first aggregate then holds no
    # strings but its key, which keeps it a hash aggregate.
    found = ["request_id", "first_seen", "last_ingested", "copies"]
    return (
        rows.select("request_id", "vendor_id", "endpoint")
        .join(F.broadcast(worst), "request_id")
        .groupBy(*found)
        .agg(F.min("vendor_id").alias("vendor_id"), F.min("endpoint").alias("endpoint"))
        .select("request_id", "vendor_id", "endpoint", *found[1:])
        .orderBy(F.desc("copies"), F.desc("last_ingested"), "request_id")
    )


@panel()
def ops_watchlist(rows):
    return (
        rows.where(suspect() | (F.col("payload_truncated") == 1))
        .select(
            "created_at", "vendor_id", "endpoint", "request_id", "pan_masked", "mobile_last4",
            "payload_truncated",
            F.octet_length("request_payload").cast("bigint").alias("request_payload_bytes"),
            F.octet_length("response_payload").cast("bigint").alias("response_payload_bytes"),
        )
        .orderBy(F.desc("created_at"), "request_id")
        .limit(100)
    )


# -- business funnel ----------------------------------------------------------


@panel(additive=True)
def fun_calls(rows):
    return rows.agg(_calls().alias("calls"))


@panel(additive=True)
def fun_success_rate(rows):
    return rows.agg(_rate(succeeded()).alias("success_rate"))


@panel()
def fun_impacted_users(rows):
    hit = rows.where((F.col("user_id") != "") & not_succeeded())
    return hit.agg(F.count_distinct("user_id").alias("users"))


@panel()
def fun_impacted_loans(rows):
    hit = rows.where(F.col("loan_application_number").isNotNull() & not_succeeded())
    return hit.agg(F.count_distinct("loan_application_number").alias("loan_apps"))


@panel(additive=True)
def fun_transport_errors(rows):
    return rows.agg(
        _calls(F.col("status").isin(*TRANSPORT_ERROR_STATUSES)).alias("transport_errors"))


@panel(quantiles=True)
def fun_p95(rows, mode):
    return quantile(rows, [], latency(), {"p95_ms": 0.95}, mode)


@panel(additive=True)
def fun_volume(rows):
    return _per_minute(rows, "vendor_id").agg(_calls().alias("calls")).orderBy(
        "time", "vendor_id")


@panel(additive=True)
def fun_success_by_vendor(rows):
    return _per_minute(rows, "vendor_id").agg(
        _percent(_calls(succeeded()), _calls()).alias("success_rate")
    ).orderBy("time", "vendor_id")


@panel()
def fun_stage_health(rows):
    rows = rows.withColumn("stage", F.col("loan_lifecycle_stage"))
    people = rows.groupBy("stage").agg(
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("loan_application_number").alias("loan_apps"),
    )
    calls = (
        value_counts(rows, ["stage"], latency(), F.count_if(succeeded()).alias("_ok"))
        .groupBy("stage")
        .agg(
            counted_rows().alias("calls"),
            F.sum("_ok").alias("successes"),
            (counted_rows() - F.sum("_ok")).alias("failures"),
            F.round(_percent(F.sum("_ok"), counted_rows()), 2).alias("success_rate"),
            F.round(weighted_quantile(0.95), 0).alias("p95_ms"),
        )
    )
    return (
        calls.join(people, "stage")
        .select("stage", "calls", "users", "loan_apps", "successes", "failures",
                "success_rate", "p95_ms")
        .orderBy(F.desc("calls"), "stage")
    )


@panel()
def fun_vendor_ranking(rows):
    return (
        value_counts(rows, ["vendor_id"], latency(), F.count_if(succeeded()).alias("_ok"))
        .groupBy("vendor_id")
        .agg(
            counted_rows().alias("calls"),
            F.sum("_ok").alias("successes"),
            (counted_rows() - F.sum("_ok")).alias("failures"),
            F.round(_percent(F.sum("_ok"), counted_rows()), 2).alias("success_rate"),
            F.round(weighted_quantile(0.95), 0).alias("p95_ms"),
            F.round(average(), 0).alias("avg_ms"),
        )
        .orderBy(F.desc("failures"), F.desc("p95_ms"), "vendor_id")
    )


@panel()
def fun_top_failing(rows):
    keys = ["vendor_id", "endpoint", "status"]
    return (
        rows.where(not_succeeded())
        .groupBy(*keys)
        .agg(
            F.count("*").alias("failures"),
            F.count_distinct("user_id").alias("impacted_users"),
            F.round(F.avg("latency_ms"), 0).alias("avg_ms"),
        )
        .orderBy(F.desc("failures"), *keys)
        .limit(50)
    )


@panel()
def fun_recent_failed(rows):
    return (
        rows.where(not_succeeded())
        .select(
            "created_at", "service", "vendor_id", "endpoint",
            F.col("loan_lifecycle_stage").alias("stage"), "loan_application_number", "user_id",
            "status", "http_status", "latency_ms", "error_code", "error_message", "request_id",
        )
        .orderBy(F.desc("created_at"), "request_id", "latency_ms")
        .limit(100)
    )


# -- latency -------------------------------------------------------------------


@panel(quantiles=True)
def lat_p50(rows, mode):
    return quantile(rows, [], latency(), {"p50_ms": 0.50}, mode)


@panel(quantiles=True)
def lat_p95(rows, mode):
    return quantile(rows, [], latency(), {"p95_ms": 0.95}, mode)


@panel(quantiles=True)
def lat_p99(rows, mode):
    return quantile(rows, [], latency(), {"p99_ms": 0.99}, mode)


@panel()
def lat_max(rows):
    return rows.agg(F.max("latency_ms").alias("max_ms"))


@panel(quantiles=True)
def lat_p95_by_vendor(rows, mode):
    return _minute_quantiles(rows, ["vendor_id"], latency(), {"p95_ms": 0.95}, mode)


@panel(quantiles=True)
def lat_quantiles(rows, mode):
    named = {"p50_ms": 0.50, "p95_ms": 0.95, "p99_ms": 0.99}
    return _minute_quantiles(rows, [], latency(), named, mode)


@panel(additive=True)
def lat_timeouts(rows):
    return _per_minute(rows.where(F.col("status") == "TIMEOUT"), "vendor_id").agg(
        _calls().alias("timeouts")).orderBy("time", "vendor_id")


@panel()
def lat_slow_ranking(rows):
    keys = ["vendor_id", "endpoint"]
    timed_out = F.count_if(F.col("status") == "TIMEOUT").alias("_timeouts")
    return (
        value_counts(rows, keys, latency(), timed_out)
        .groupBy(*keys)
        .agg(
            counted_rows().alias("calls"),
            weighted_quantile(0.50).alias("p50_ms"),
            weighted_quantile(0.95).alias("p95_ms"),
            weighted_quantile(0.99).alias("p99_ms"),
            F.max("_value").alias("max_ms"),
            F.sum("_timeouts").alias("timeouts"),
        )
        .orderBy(F.desc("p95_ms"), *keys)
        .limit(50)
    )


# -- failure rate ---------------------------------------------------------------


@panel(additive=True)
def fail_rate(rows):
    return rows.agg(_rate(failed()).alias("failure_rate"))


@panel(additive=True)
def fail_calls(rows):
    return rows.agg(_calls(failed()).alias("failed_calls"))


@panel(additive=True)
def fail_timeout_rate(rows):
    return rows.agg(_rate(F.col("status") == "TIMEOUT").alias("timeout_rate"))


@panel(additive=True)
def fail_network_rate(rows):
    return rows.agg(_rate(F.col("status") == "NETWORK_ERROR").alias("network_error_rate"))


@panel(additive=True)
def fail_rate_by_vendor(rows):
    return _per_minute(rows, "vendor_id").agg(
        _percent(_calls(failed()), _calls()).alias("failure_rate")
    ).orderBy("time", "vendor_id")


@panel(additive=True)
def fail_by_status(rows):
    return _per_minute(rows.where(not_succeeded()), "status").agg(
        _calls().alias("calls")).orderBy("time", "status")


@panel()
def fail_breakdown(rows):
    keys = ["vendor_id", "endpoint", "status", "http_status", "error_code"]
    return (
        rows.where(not_succeeded())
        .groupBy(*keys)
        .agg(
            F.count("*").alias("calls"),
            F.count_distinct("user_id").alias("impacted_users"),
            F.round(F.avg("latency_ms"), 0).alias("avg_latency_ms"),
        )
        .orderBy(F.desc("calls"), *keys)
        .limit(100)
    )


@panel()
def fail_recent(rows):
    return (
        rows.where(not_succeeded())
        .select(
            "created_at", "service", "vendor_id", "endpoint", "status", "http_status",
            "latency_ms", "error_code", "error_message", "user_id", "loan_application_number",
            "request_id",
        )
        .orderBy(F.desc("created_at"), "request_id", "latency_ms")
        .limit(100)
    )
