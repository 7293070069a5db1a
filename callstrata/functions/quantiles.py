"""Exact and approximate quantiles that stay small in every task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def value_counts(df: DataFrame, keys: Sequence[str], value: Column, *extra: Column) -> DataFrame:
    """Rows per (keys, value), with any further additive aggregates.

    The shuffle key holds the value, so a key with a third of all rows is spread
    over as many tasks as it has distinct values, after map-side combination.
    """
    return df.groupBy(*keys, value.alias("_value")).agg(F.count("*").alias("_rows"), *extra)


def weighted_quantile(q: float) -> Column:
    """Exact interpolated quantile over value_counts rows.

    Values are whole numbers and q has two decimals, so the true result has at
    most two; rounding only removes what binary interpolation adds.
    """
    return F.round(F.percentile(F.col("_value"), F.lit(q), F.col("_rows")), 6)


def quantile(df: DataFrame, keys: Sequence[str], value: Column, named: dict[str, float],
             mode: str = "exact") -> DataFrame:
    """Quantiles of `value` per key.

    mode="exact" interpolates between neighbours. The state of a group is one
    counter per distinct value (whole milliseconds or seconds), not per row.
    mode="approx" keeps a fixed-size sketch and returns an actual element.
    """
    if mode == "approx":
        return df.groupBy(*keys).agg(
            *[F.percentile_approx(value, F.lit(q), F.lit(10000)).cast("double").alias(name)
              for name, q in named.items()]
        )
    if mode != "exact":
        raise ValueError(f"unknown quantile mode: {mode}")
    counts = value_counts(df, keys, value)
    return counts.groupBy(*keys).agg(
        *[weighted_quantile(q).alias(name) for name, q in named.items()]
    )
