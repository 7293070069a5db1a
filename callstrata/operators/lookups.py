"""Point lookups and the ad-hoc queries operators run by hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callstrata.functions.filters import last_hours
from callstrata.functions.masking import hash_mobile
from callstrata.functions.quantiles import value_counts, weighted_quantile
from callstrata.functions.scalars import lag_seconds

# Columns with a Parquet bloom filter in the hot table, so that an equality
# lookup skips row groups.
LOOKUP_COLUMNS = (
    "request_id", "user_id", "loan_application_number", "mobile_hash", "pan_masked", "status",
)


def find_by(hot: DataFrame, column: str, value: str) -> DataFrame:
    if column not in LOOKUP_COLUMNS:
        raise ValueError(f"no lookup on {column}; choose one of {', '.join(LOOKUP_COLUMNS)}")
    return hot.where(F.col(column) == value)


def find_event(hot: DataFrame, request_id: str) -> DataFrame:
    return find_by(hot, "request_id", request_id)


def lookup_by_mobile(hot: DataFrame, mobile: str, key: str) -> DataFrame:
    """Events of a customer, found by hashing the number at query time.

    The hash has no column input, so Spark folds it to a literal before the
    scan and the filter is pushed down like any other equality.
    """
    return hot.where(F.col("mobile_hash") == hash_mobile(F.lit(mobile), key))


def latest_n(hot: DataFrame, n: int = 10) -> DataFrame:
    return (
        hot.select("request_id", "vendor_id", "endpoint", "status", "latency_ms", "created_at")
        .orderBy(F.desc("created_at"), "request_id", "latency_ms")
        .limit(n)
    )


def vendor_status_1h(hot: DataFrame, now: Column, order: str = "vendor") -> DataFrame:
    """Calls per vendor and status in the hour before `now`, and later rows."""
    recent = hot.where(F.col("created_at") >= now - F.make_dt_interval(hours=F.lit(1)))
    counts = recent.groupBy("vendor_id", "status").agg(F.count("*").alias("calls"))
    if order == "vendor":
        return counts.orderBy("vendor_id", F.desc("calls"), "status")
    return counts.orderBy(F.desc("calls"), "vendor_id", "status")


def freshness(hot: DataFrame) -> DataFrame:
    """Newest times and the p95 of the lag, which may be negative here."""
    lag = lag_seconds(F.col("created_at"), F.col("ingested_at"))
    newest = (F.max("created_at").alias("_created"), F.max("ingested_at").alias("_ingested"))
    return value_counts(hot, [], lag, *newest).agg(
        F.max("_created").alias("latest_event"),
        F.max("_ingested").alias("latest_ingest"),
        weighted_quantile(0.95).alias("p95_ingest_lag_seconds"),
    )


def count_all(hot: DataFrame) -> DataFrame:
    return hot.agg(F.count("*").alias("events"))


def recent(hot: DataFrame, now, hours: int = 6) -> DataFrame:
    """The dashboards' default range."""
    return last_hours(hot, "created_at", hours, now)
