"""Dashboard filters: inclusive time range and LIKE on a few columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callstrata.functions.scalars import hot_day, hot_month

EVERYTHING = "%"


def like_filter(df: DataFrame, **patterns: str | None) -> DataFrame:
    """Keep rows where each named column matches its LIKE pattern.

    `_` and `%` are wildcards, also inside names such as BANK_BRE. A bare `%`
    adds no predicate: the filter columns are never NULL.
    """
    for name, pattern in patterns.items():
        if pattern is not None and pattern != EVERYTHING:
            df = df.where(F.col(name).like(pattern))
    return df


def _as_time(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def time_filter(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Inclusive range on a time column.

    A range on created_at also bounds the partition columns of the hot table,
    where the frame has them: Spark does not derive those bounds by itself.
    """
    prune = column == "created_at"
    for bound, above in ((start, True), (end, False)):
        if bound is None:
            continue
        at = _as_time(bound)
        df = df.where(F.col(column) >= at if above else F.col(column) <= at)
        if prune:
            for name, part in (("ist_month", hot_month), ("ist_day", hot_day)):
                if name in df.columns:
                    edge = part(at)
                    df = df.where(F.col(name) >= edge if above else F.col(name) <= edge)
    return df


def last_hours(df: DataFrame, column: str, hours: int, now) -> DataFrame:
    """The dashboards' relative range: the last `hours` before `now`."""
    at = _as_time(now)
    return time_filter(df, column, at - F.make_dt_interval(hours=F.lit(hours)), at)
