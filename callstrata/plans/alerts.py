"""Alert rules as windowed conditions over the hot table, quarantine and audit log.

Sliding windows are built from per-minute counts: events are aggregated once, and
only the minute rows are copied into the windows they belong to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callstrata.contract import FAILED_STATUSES, LATENCY_BUCKETS_MS, VENDOR_TIERS
from callstrata.functions.quantiles import value_counts, weighted_quantile
from callstrata.functions.scalars import minute_of
from callstrata.operators.intervals import parked_by_minute, waiting_by_minute
from callstrata.operators.islands import held_for
from callstrata.operators.rollup import bucket_counts


@dataclass(frozen=True)
class Rule:
    tier: str
    window_minutes: int
    threshold: float
    hold_minutes: int


# ---------------------------------------------------------------------------
# Tier, window, threshold and how long the condition must hold.
# ---------------------------------------------------------------------------
FAILURE_RATE_RULES = {
    "p1_rate_high": Rule("P1", 5, 5.0, 2),
    "p1_rate_critical": Rule("P1", 5, 25.0, 1),
    "p2_rate_high": Rule("P2", 10, 10.0, 5),
}
P1_ALL_FAILING = Rule("P1", 5, 0.0, 1)
P1_LATENCY = Rule("P1", 5, 5000.0, 3)
P1_TIMEOUTS = Rule("P1", 5, 1.0, 2)
QUARANTINE_WINDOW_MINUTES = 5
QUARANTINE_LEVEL = Rule("infra", 1, 0, 5)
ERROR_RATE = Rule("infra", 5, 0.1, 2)
ERRORS_PER_MINUTE = Rule("infra", 1, 5, 1)
BACKLOG_AGE_SECONDS = Rule("infra", 1, 60, 2)
BACKLOG_DEPTH = Rule("infra", 1, 5000, 2)
READ_SPIKE = Rule("compliance", 5, 50, 0)
READ_EVENT = "GetObject"
HOLD_EVENT = "PutObjectLegalHold"
HOLD_REMOVED = "OFF"


def vendor_tiers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(VENDOR_TIERS), "vendor_id string, tier string")


def of_tier(rows: DataFrame, tier: str) -> DataFrame:
    """Rows of the vendors in a tier. Vendors without a tier raise no alert.

    As a list of values the condition reaches the scan; a join would not.
    """
    members = [vendor for vendor, its_tier in VENDOR_TIERS if its_tier == tier]
    return rows.where(F.col("vendor_id").isin(members))


def into_windows(minutes: DataFrame, size: int) -> DataFrame:
    """Copy each minute row into the windows of `size` minutes that hold it."""
    step = F.make_dt_interval(mins=F.lit(1))
    last = F.col("minute") + F.make_dt_interval(mins=F.lit(size))
    ends = F.sequence(F.col("minute") + step, last, step)
    return minutes.withColumn("window_end", F.explode(ends)).drop("minute")


def outcome_counts() -> dict[str, Column]:
    status = F.col("status")
    return {
        "calls": F.count("*"),
        "successes": F.count_if(status == "SUCCESS"),
        "failures": F.count_if(status.isin(*FAILED_STATUSES)),
        "timeouts": F.count_if(status == "TIMEOUT"),
    }


def sliding_calls(rows: DataFrame, rule: Rule) -> DataFrame:
    """Calls by outcome per vendor of the tier and window."""
    counts = outcome_counts()
    minutes = of_tier(rows, rule.tier).groupBy(
        minute_of(F.col("created_at")).alias("minute"), "vendor_id"
    ).agg(*[column.alias(name) for name, column in counts.items()])
    return into_windows(minutes, rule.window_minutes).groupBy("vendor_id", "window_end").agg(
        *[F.sum(name).alias(name) for name in counts])


def _evaluate(windows: DataFrame, value: Column, condition: Column, rule: Rule) -> DataFrame:
    judged = windows.select(
        "vendor_id", "window_end", value.cast("double").alias("value"),
        condition.alias("breaching"))
    return held_for(judged, ["vendor_id"], rule.hold_minutes).drop("breaching")


def alert_failure_rate(rows: DataFrame, name: str) -> DataFrame:
    rule = FAILURE_RATE_RULES[name]
    rate = F.col("failures") * 100.0 / F.col("calls")
    return _evaluate(sliding_calls(rows, rule), rate, rate > rule.threshold, rule)


def alert_all_failing(rows: DataFrame) -> DataFrame:
    windows = sliding_calls(rows, P1_ALL_FAILING)
    none_ok = (F.col("successes") == 0) & (F.col("calls") > 0)
    return _evaluate(windows, F.col("calls"), none_ok, P1_ALL_FAILING)


def alert_timeouts(rows: DataFrame, threshold: float = P1_TIMEOUTS.threshold) -> DataFrame:
    windows = sliding_calls(rows, P1_TIMEOUTS)
    per_second = F.col("timeouts") / (P1_TIMEOUTS.window_minutes * 60)
    return _evaluate(windows, per_second, per_second > threshold, P1_TIMEOUTS)


def histogram_quantile(q: float) -> Column:
    """Quantile from cumulative bucket counts, linear within a bucket.

    Beyond the last finite bucket the answer is that bucket's bound.
    """
    rank = F.col("le_inf") * q
    result = None
    below_bound, below_count = 0, F.lit(0)
    for bound in LATENCY_BUCKETS_MS:
        count = F.col(f"le_{bound}")
        share = (rank - below_count) / F.nullif(count - below_count, F.lit(0))
        value = below_bound + (bound - below_bound) * share
        result = F.when(count >= rank, value) if result is None else result.when(
            count >= rank, value)
        below_bound, below_count = bound, count
    return result.otherwise(float(LATENCY_BUCKETS_MS[-1]))


def latency_windows(rows: DataFrame, mode: str, rule: Rule = P1_LATENCY) -> DataFrame:
    """p95 latency per vendor and window: "histogram" as alerting systems see it,
    or "exact"."""
    members = of_tier(rows, rule.tier).withColumn("minute", minute_of(F.col("created_at")))
    keys = ["vendor_id", "window_end"]
    if mode == "histogram":
        minutes = members.groupBy("minute", "vendor_id").agg(
            *bucket_counts(), F.count("*").alias("le_inf"))
        names = [name for name in minutes.columns if name.startswith("le_")]
        windows = into_windows(minutes, rule.window_minutes).groupBy(*keys).agg(
            *[F.sum(name).alias(name) for name in names])
        return windows.select(*keys, F.round(histogram_quantile(0.95), 6).alias("p95_ms"))
    if mode != "exact":
        raise ValueError(f"unknown latency mode: {mode}")
    minutes = value_counts(members, ["minute", "vendor_id"], F.col("latency_ms"))
    return into_windows(minutes, rule.window_minutes).groupBy(*keys).agg(
        weighted_quantile(0.95).alias("p95_ms"))


def alert_latency(rows: DataFrame, mode: str = "exact") -> DataFrame:
    """p95 over the threshold. In histogram mode it cannot fire: the last finite
    bucket equals the threshold."""
    p95 = F.col("p95_ms")
    return _evaluate(latency_windows(rows, mode), p95, p95 > P1_LATENCY.threshold, P1_LATENCY)


def alert_quarantine(parked: DataFrame) -> DataFrame:
    """Five-minute windows in which records were parked: arrivals. Whether any still
    waits is told by `alert_quarantine_level`."""
    span = F.window("parked_at", f"{QUARANTINE_WINDOW_MINUTES} minutes")
    return parked.groupBy(span.alias("w")).agg(F.count("*").alias("parked")).select(
        F.col("w.end").alias("window_end"), "parked", (F.col("parked") > 0).alias("firing"))


def alert_quarantine_level(waiting: DataFrame, cleared: DataFrame, until=None,
                           hold_minutes: int = QUARANTINE_LEVEL.hold_minutes) -> DataFrame:
    """Minutes at which parked messages wait; fires once some do for five minutes, and
    for as long as any is left, however long ago it was parked."""
    minutes = parked_by_minute(waiting, cleared, until)
    held = F.unix_seconds("window_end") - F.unix_seconds("active_since")
    return minutes.withColumn("firing", held >= hold_minutes * 60)


def _parked_windows(parked: DataFrame, minutes: int) -> DataFrame:
    per_minute = parked.groupBy(minute_of(F.col("parked_at")).alias("minute"), "reason").agg(
        F.count("*").alias("errors"))
    return into_windows(per_minute, minutes).groupBy("window_end").agg(
        F.sum("errors").alias("errors"))


def _held_overall(windows: DataFrame, value: Column, rule: Rule) -> DataFrame:
    judged = windows.select(
        F.lit(rule.tier).alias("tier"), "window_end", value.cast("double").alias("value"),
        (value > rule.threshold).alias("breaching"))
    return held_for(judged, ["tier"], rule.hold_minutes).drop("breaching")


def alert_error_rate(parked: DataFrame, form: str = "per_second",
                     threshold: float | None = None) -> DataFrame:
    """Processing errors per second over five minutes, or per minute twice."""
    rule = ERROR_RATE if form == "per_second" else ERRORS_PER_MINUTE
    if threshold is not None:
        rule = Rule(rule.tier, rule.window_minutes, threshold, rule.hold_minutes)
    windows = _parked_windows(parked, rule.window_minutes)
    errors = F.col("errors")
    value = errors / (rule.window_minutes * 60) if form == "per_second" else errors
    return _held_overall(windows, value, rule)


def backlog(events: DataFrame) -> DataFrame:
    """Waiting events and the age of the oldest, per minute."""
    age = F.unix_seconds("minute") - F.unix_seconds("oldest_created")
    return waiting_by_minute(events).select(
        F.col("minute").alias("window_end"), "waiting", age.alias("oldest_age_seconds"))


def alert_backlog(events: DataFrame, depth: float = BACKLOG_DEPTH.threshold,
                  age: float = BACKLOG_AGE_SECONDS.threshold) -> DataFrame:
    """Oldest event too old for two minutes, or too many waiting for three."""
    rules = {
        "age": (F.col("oldest_age_seconds"), age, BACKLOG_AGE_SECONDS),
        "depth": (F.col("waiting"), depth, BACKLOG_DEPTH),
    }
    # Both rules judge the same pass over the events.
    judged = backlog(events).select("window_end", F.inline(F.array(*[
        F.struct(F.lit(rule.tier).alias("tier"), F.lit(name).alias("rule"),
                 value.cast("double").alias("value"), (value > limit).alias("breaching"),
                 F.lit(rule.hold_minutes).alias("hold_minutes"))
        for name, (value, limit, rule) in rules.items()])))
    return held_for(judged, ["tier", "rule"], F.col("hold_minutes")).drop(
        "breaching", "hold_minutes")


def alert_read_spike(audit: DataFrame, bucket: str,
                     threshold: int = int(READ_SPIKE.threshold)) -> DataFrame:
    """Object reads of the archive per five minutes; no reads, no window."""
    reads = audit.where((F.col("event_name") == READ_EVENT) & (F.col("bucket") == bucket))
    span = F.window("event_time", f"{READ_SPIKE.window_minutes} minutes")
    return reads.groupBy(span.alias("w")).agg(F.count("*").alias("reads")).select(
        F.col("w.end").alias("window_end"), "reads",
        (F.col("reads") > threshold).alias("firing"))


def alert_hold_removed(audit: DataFrame, bucket: str) -> DataFrame:
    """Every removal of a legal hold in the archive, at once."""
    removed = (F.col("event_name") == HOLD_EVENT) & (F.col("hold_status") == HOLD_REMOVED)
    return audit.where(removed & (F.col("bucket") == bucket)).select(
        "event_time", "object_key", "user_name")
