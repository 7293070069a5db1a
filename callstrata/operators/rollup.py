"""Minute rollups, per-vendor views, and the call counter and histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callstrata.contract import LATENCY_BUCKETS_MS, VENDOR_VIEWS
from callstrata.functions.scalars import http_band, minute_of

ROLLUP_KEYS = ("window_start", "vendor_id", "endpoint", "service", "status")


def rollup_1m(rows: DataFrame) -> DataFrame:
    """Partial sums per minute and outcome. Duplicates count, as on insert."""
    return rows.groupBy(
        minute_of(F.col("created_at")).alias("window_start"), *ROLLUP_KEYS[1:]
    ).agg(F.count("*").alias("total"), F.sum("latency_ms").alias("total_latency"))


def rollup_merge(partials: DataFrame) -> DataFrame:
    """Partial sums of any number of batches, added up."""
    return partials.groupBy(*ROLLUP_KEYS).agg(
        F.sum("total").alias("total"), F.sum("total_latency").alias("total_latency"))


def vendor_view(hot: DataFrame, vendor_id: str) -> DataFrame:
    """All columns of one vendor's rows; the id must match exactly."""
    return hot.where(F.col("vendor_id") == vendor_id)


def vendor_view_names() -> dict[str, str]:
    return {f"mv_{vendor.replace('-', '_')}": vendor for vendor in VENDOR_VIEWS}


def calls_total(rows: DataFrame) -> DataFrame:
    return rows.groupBy(
        "vendor_id", "endpoint", "status", http_band(F.col("http_status")).alias("http_status")
    ).agg(F.count("*").alias("calls"))


def bucket_counts():
    """Cumulative counts per upper bound, as aggregate columns."""
    return [F.count_if(F.col("latency_ms") <= le).alias(f"le_{le}") for le in LATENCY_BUCKETS_MS]


def latency_histogram(rows: DataFrame, *keys: str) -> DataFrame:
    """Cumulative bucket counts with total count and sum, one row per key."""
    keys = keys or ("vendor_id", "endpoint", "status")
    return rows.groupBy(*keys).agg(
        *bucket_counts(), F.count("*").alias("le_inf"), F.sum("latency_ms").alias("latency_sum"))
