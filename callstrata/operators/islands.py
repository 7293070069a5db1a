"""Conditions that must hold for a time before they count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def held_for(evaluations: DataFrame, keys: list[str], minutes: int | Column, condition: str = "breaching",
             step_minutes: int = 1) -> DataFrame:
    """Evaluations where the condition is true, with since when and if it fires.

    A missing evaluation ends a run just as a false one does. The window is per
    key and holds one row per evaluation, however many events there were.
    """
    at = F.unix_seconds("window_end")
    run_order = Window.partitionBy(*keys).orderBy("window_end")
    starts = F.coalesce(at - F.lag(at).over(run_order) != step_minutes * 60, F.lit(True))
    true_only = evaluations.where(F.col(condition)).withColumn(
        "_start", F.when(starts, F.col("window_end")))
    since = F.max("_start").over(run_order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        true_only.withColumn("active_since", since)
        .withColumn("firing", at - F.unix_seconds("active_since") >= minutes * 60)
        .drop("_start")
    )
