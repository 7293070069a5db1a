"""Threshold colours of single-value panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# ---------------------------------------------------------------------------
# Panel, shown column, and the first value of each worse colour.
# ---------------------------------------------------------------------------
LEVELS = {
    "fail_rate": ("failure_rate", ("green", ("yellow", 5), ("red", 15))),
    "fun_success_rate": ("success_rate", ("red", ("yellow", 90), ("green", 97))),
    "fun_p95": ("p95_ms", ("green", ("yellow", 2000), ("red", 5000))),
    "lat_p95": ("p95_ms", ("green", ("yellow", 2000), ("red", 5000))),
    "ops_lag_p95": ("p95_lag_seconds", ("green", ("yellow", 60), ("red", 300))),
    "ops_dup_ids": ("duplicate_request_ids", ("green", ("yellow", 1), ("red", 10))),
    "ops_missing_keys": ("rows_missing_s3_keys", ("green", ("red", 1))),
    "ops_possible_pii": ("possible_pii_rows", ("green", ("red", 1))),
}


def level_of(panel: str, value: Column) -> Column:
    """Colour of a value; an empty panel has the base colour."""
    base, *steps = LEVELS[panel][1]
    colour = F.lit(base)
    for name, at_least in steps:
        colour = F.when(value >= at_least, name).otherwise(colour)
    return colour


def with_level(panel: str, result: DataFrame) -> DataFrame:
    column = LEVELS[panel][0]
    return result.withColumn("level", level_of(panel, F.col(column)))
