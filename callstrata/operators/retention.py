"""Row, payload and rollup expiry, storage tiers, and cold/hot reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callstrata import contract


def cutoff(now: Column, days: int) -> Column:
    return now - F.make_dt_interval(days=F.lit(days))


def expire_rows(hot: DataFrame, now: Column,
                days: int = contract.ROW_RETENTION_DAYS) -> DataFrame:
    """Rows still inside the retention period, to the exact edge."""
    return hot.where(F.col("created_at") > cutoff(now, days))


def expire_payloads(hot: DataFrame, now: Column,
                    days: int = contract.PAYLOAD_RETENTION_DAYS) -> DataFrame:
    """Payload copies become empty after their period; the row stays."""
    old = F.col("created_at") <= cutoff(now, days)
    return hot.withColumns({
        name: F.when(old, "").otherwise(F.col(name))
        for name in ("request_payload", "response_payload")
    })


def expire_rollup(rollup: DataFrame, now: Column,
                  days: int = contract.ROLLUP_RETENTION_DAYS) -> DataFrame:
    return rollup.where(F.col("window_start") > cutoff(now, days))


def tier_of(age_days: Column) -> Column:
    """Storage tier of a cold object by age. Objects never expire."""
    return (
        F.when(age_days >= contract.DEEP_ARCHIVE_DAYS, "DEEP_ARCHIVE")
        .when(age_days >= contract.INFREQUENT_ACCESS_DAYS, "STANDARD_IA")
        .otherwise("STANDARD")
    )


def tier_inventory(objects: DataFrame, today: Column) -> DataFrame:
    """Objects and bytes per tier; `objects` has created_at and object_bytes."""
    age = F.date_diff(today, F.to_date("created_at"))
    return objects.groupBy(tier_of(age).alias("tier")).agg(
        F.count("*").alias("objects"), F.sum("object_bytes").alias("bytes"))


def reconcile(quarantine: DataFrame, cold: DataFrame, hot: DataFrame) -> DataFrame:
    """Where each request is, and what that means. One row per request_id.

    Each side is first reduced to one row per id, so a request with very many
    copies cannot multiply in the joins.
    """

    def counted(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy("request_id").agg(F.count("*").alias(name))

    joined = (
        counted(quarantine, "parked")
        .join(counted(cold, "cold_copies"), "request_id", "full_outer")
        .join(counted(hot, "hot_copies"), "request_id", "full_outer")
        .na.fill(0, ["parked", "cold_copies", "hot_copies"])
    )
    in_cold, in_hot = F.col("cold_copies") > 0, F.col("hot_copies") > 0
    verdict = (
        F.when(in_cold & in_hot, "archived")
        .when(in_cold, "cold_only")
        .when(in_hot, "hot_only")
        .otherwise("parked_only")
    )
    return joined.withColumn("verdict", verdict)
