"""Levels over time from changes: how many wait at each minute, and since when.

Changes are first added up per minute, which combines before the shuffle. Running sums,
minima and starts are then made in two steps, within each day and over one row per day, so
that no task has all minutes. Between two changes nothing differs, so a row stands for all
minutes until the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

MINUTES_A_DAY = 1440


def sweep(changes: DataFrame) -> DataFrame:
    """Levels after each minute with a change.

    `changes` has minute (a number), delta, and `least`: a value that counts until that
    minute, or NULL. Returns day, minute, delta, next_minute (NULL for the last), level and
    least_later: the smallest `least` of later minutes.
    """
    minutes = changes.groupBy(
        F.expr(f"minute DIV {MINUTES_A_DAY}").alias("day"), "minute").agg(
        F.sum("delta").alias("delta"), F.min("least").alias("least"))
    in_day = Window.partitionBy("day").orderBy("minute")
    so_far = in_day.rowsBetween(Window.unboundedPreceding, 0)
    later = in_day.rowsBetween(1, Window.unboundedFollowing)
    within = minutes.withColumns({
        "risen": F.sum("delta").over(so_far),
        "later": F.min("least").over(later),
        "next": F.lead("minute").over(in_day),
    })
    # One row per day with changes: the only step that one task does alone.
    over_days = Window.orderBy("day")
    before = over_days.rowsBetween(Window.unboundedPreceding, -1)
    after = over_days.rowsBetween(1, Window.unboundedFollowing)
    days = minutes.groupBy("day").agg(
        F.sum("delta").alias("delta"), F.min("least").alias("least"),
        F.min("minute").alias("first"))
    days = days.select(
        "day", F.sum("delta").over(before).alias("carried"),
        F.min("least").over(after).alias("day_later"),
        F.lead("first").over(over_days).alias("day_next"))
    # Every day is found; a left join adds no filter below, so both sides use one aggregate
    # of the minutes, and the minutes are dealt out by day already.
    return within.join(days, "day", "left").select(
        "day", "minute", "delta",
        (F.coalesce("carried", F.lit(0)) + F.col("risen")).alias("level"),
        F.coalesce("next", "day_next").alias("next_minute"),
        F.least("later", "day_later").alias("least_later"))


def with_since(levels: DataFrame) -> DataFrame:
    """Adds since: the minute at which the level last rose above zero."""
    began = F.when((F.col("level") > 0) & (F.col("level") - F.col("delta") <= 0),
                   F.col("minute"))
    marked = levels.withColumn("began", began)
    over_days = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = marked.groupBy("day").agg(F.max("began").alias("last_began")).select(
        "day", F.max("last_began").over(over_days).alias("began_before"))
    so_far = Window.partitionBy("day").orderBy("minute").rowsBetween(
        Window.unboundedPreceding, 0)
    return (marked.withColumn("in_day", F.max("began").over(so_far))
            .join(days, "day", "left")
            .withColumn("since", F.coalesce("in_day", "began_before"))
            .drop("began", "in_day", "began_before"))


def each_minute(levels: DataFrame, until=None) -> DataFrame:
    """One row for every minute with a level above zero, up to the last change or until a
    minute that is given."""
    end = F.coalesce(F.col("next_minute") - 1, F.lit(until), F.col("minute"))
    return levels.where("level > 0").withColumn("end", end).where("end >= minute").withColumn(
        "minute", F.explode(F.sequence("minute", "end"))).drop("end")


def minute_after(time) -> Column:
    """The first full minute that is not before a time, as a number."""
    return F.ceil(F.unix_micros(time) / 60_000_000).cast("bigint")


def as_time(minute) -> Column:
    return F.timestamp_seconds(F.col(minute) * 60)


def waiting_by_minute(events: DataFrame) -> DataFrame:
    """Events created but not yet ingested at each full minute.

    Returns minute, waiting and oldest_created, for minutes with any. Of all events that
    are ingested later, the first created one waits, if any does: so the oldest at a
    minute is the least over later ingest minutes, and one pass over both changes of each
    event gives the number and the age.
    """
    spans = events.select(
        minute_after("created_at").alias("first"), minute_after("ingested_at").alias("end"),
        F.col("created_at").alias("created")).where("first < end")
    none = F.lit(None).cast("timestamp")
    changes = spans.select(F.inline(F.array(
        F.struct(F.col("first").alias("minute"), F.lit(1).alias("delta"), none.alias("least")),
        F.struct(F.col("end").alias("minute"), F.lit(-1).alias("delta"),
                 F.col("created").alias("least")))))
    return each_minute(sweep(changes)).select(
        as_time("minute").alias("minute"), F.col("level").alias("waiting"),
        F.col("least_later").alias("oldest_created"))


def parked_by_minute(waiting: DataFrame, cleared: DataFrame, until=None) -> DataFrame:
    """Parked messages that wait at each full minute, and since when any does.

    `waiting` has parked_at of those that wait now, `cleared` also cleared_at of those
    that do not any more. Without `until` the last minute is that of the last change.
    """
    def change(at: str, delta: int):
        return F.struct(minute_after(at).alias("minute"), F.lit(delta).alias("delta"),
                        F.lit(None).cast("timestamp").alias("least"))

    changes = waiting.select(change("parked_at", 1).alias("c")).unionByName(
        cleared.select(F.explode(F.array(
            change("parked_at", 1), change("cleared_at", -1))).alias("c"))).select("c.*")
    last = None if until is None else minute_after(until)
    return each_minute(with_since(sweep(changes)), last).select(
        as_time("minute").alias("window_end"), F.col("level").alias("waiting"),
        as_time("since").alias("active_since"))
