"""Stateful stream forms: rollup windows, alert windows, and deduplication.

The archive's default is different: ingest writes partial sums per micro-batch,
which never lose late rows, and deduplication happens on read. These forms suit
consumers that need results while the stream runs and accept a lateness limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callstrata.contract import REDELIVERY_HORIZON_DAYS
from callstrata.operators.rollup import ROLLUP_KEYS
from callstrata.plans import alerts


def rollup_stream(events: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """The minute rollup as event-time windows with a lateness limit."""
    return (
        events.withWatermark("created_at", lateness)
        .groupBy(F.window("created_at", "1 minute").alias("w"), *ROLLUP_KEYS[1:])
        .agg(F.count("*").alias("total"), F.sum("latency_ms").alias("total_latency"))
        .select(F.col("w.start").alias("window_start"), *ROLLUP_KEYS[1:], "total",
                "total_latency")
    )


def alert_conditions(tier: str) -> tuple[int, dict[str, Column]]:
    """Window size in minutes and the conditions of a tier, over alert_stream columns."""
    rates = alerts.FAILURE_RATE_RULES
    rate = F.col("failure_rate")
    if tier == "P2":
        return rates["p2_rate_high"].window_minutes, {
            "rate_high": rate > rates["p2_rate_high"].threshold}
    if tier != "P1":
        raise ValueError(f"no stream rules for tier {tier}")
    minutes = rates["p1_rate_high"].window_minutes
    return minutes, {
        "rate_high": rate > rates["p1_rate_high"].threshold,
        "rate_critical": rate > rates["p1_rate_critical"].threshold,
        "all_failing": F.col("successes") == 0,
        "latency": F.col("p95_ms") > alerts.P1_LATENCY.threshold,
        "timeout_spike": F.col("timeouts") > alerts.P1_TIMEOUTS.threshold * minutes * 60,
    }


def alert_stream(events: DataFrame, tier: str, lateness: str = "10 minutes") -> DataFrame:
    """Sliding windows per vendor of a tier, with the condition of each of its rules.

    The quantile's state holds one counter per distinct latency of a window.
    """
    minutes, conditions = alert_conditions(tier)
    p95 = F.round(F.percentile("latency_ms", 0.95), 6)
    return (
        alerts.of_tier(events, tier)
        .withWatermark("created_at", lateness)
        .groupBy(F.window("created_at", f"{minutes} minutes", "1 minute").alias("w"), "vendor_id")
        .agg(*[column.alias(name) for name, column in alerts.outcome_counts().items()],
             p95.alias("p95_ms"))
        .withColumn("failure_rate", F.col("failures") * 100.0 / F.col("calls"))
        .select("vendor_id", F.col("w.end").alias("window_end"), *alerts.outcome_counts(),
                "failure_rate", "p95_ms",
                *[condition.alias(name) for name, condition in conditions.items()])
    )


def dedup_stream(events: DataFrame, horizon_days: int = REDELIVERY_HORIZON_DAYS,
                 spread: int = 8) -> DataFrame:
    """Collapse re-deliveries inside the horizon; keeps a first copy, not the last.

    Stateful deduplication sends all copies of an id to one task. So that a very
    hot id does not, copies are first collapsed in `spread` groups per id, and
    what is left once more per id. spread=1 keeps one state per id, not two.
    """
    events = events.withWatermark("ingested_at", f"{horizon_days} days")
    if spread > 1:
        group = F.pmod(F.xxhash64("ingested_at", "latency_ms"), F.lit(spread))
        events = events.withColumn("_group", group).dropDuplicatesWithinWatermark(
            ["request_id", "_group"]).drop("_group")
    return events.dropDuplicatesWithinWatermark(["request_id"])
