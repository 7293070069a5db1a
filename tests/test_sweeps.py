"""Levels over time against a plain loop over minutes."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from callstrata.operators.intervals import parked_by_minute, waiting_by_minute
from callstrata.plans.alerts import alert_quarantine_level

START = datetime(2024, 1, 1, 22)


def spans(seed, n, days):
    draw = random.Random(seed)
    found = []
    for _ in range(n):
        first = START + timedelta(seconds=draw.randrange(days * 86400))
        wait = draw.choice([0, 20, 60, 61, 3600, 200_000])
        found.append((first, first + timedelta(seconds=wait)))
    return found


def minutes(found):
    low = min(a for a, _ in found).replace(second=0)
    high = max(b for _, b in found)
    while low <= high:
        yield low
        low += timedelta(minutes=1)


@pytest.mark.parametrize("seed, n, days", [(1, 1, 1), (2, 40, 3), (3, 12, 12)])
def test_waiting_equals_a_loop(spark, seed, n, days):
    found = spans(seed, n, days)
    frame = spark.createDataFrame(found, "created_at timestamp, ingested_at timestamp")
    expected = {}
    for minute in minutes(found):
        waiting = [a for a, b in found if a <= minute < b]
        if waiting:
            expected[minute] = (len(waiting), min(waiting))
    got = {r.minute: (r.waiting, r.oldest_created) for r in waiting_by_minute(frame).collect()}
    assert got == expected


def test_parked_messages_keep_firing_for_days(spark):
    parked = [(START,), (START + timedelta(days=9),)]
    cleared = [(START + timedelta(minutes=10), START + timedelta(minutes=12)),
               (START - timedelta(minutes=30), START - timedelta(minutes=29, seconds=30)),
               (START - timedelta(minutes=20), START - timedelta(minutes=17))]
    until = START + timedelta(days=10)
    rows = alert_quarantine_level(
        spark.createDataFrame(parked, "parked_at timestamp"),
        spark.createDataFrame(cleared, "parked_at timestamp, cleared_at timestamp"),
        F.lit(str(until)).cast("timestamp")).orderBy("window_end").collect()
    got = {r.window_end: (r.waiting, r.active_since, r.firing) for r in rows}
    early = START - timedelta(minutes=20)
    assert got[early] == (1, early, False) and START - timedelta(minutes=17) not in got
    assert got[START] == (1, START, False)
    assert got[START + timedelta(minutes=5)] == (1, START, True)
    assert got[START + timedelta(minutes=11)][0] == 2
    assert got[START + timedelta(days=5, minutes=3)] == (1, START, True)
    assert got[until] == (2, START, True)
    # half a minute between two full ones is not seen
    assert START - timedelta(minutes=30) in got and START - timedelta(minutes=29) not in got
    assert len(got) == 1 + 3 + 10 * 1440 + 1


def test_no_changes_no_levels(spark):
    none = spark.createDataFrame([], "parked_at timestamp, cleared_at timestamp")
    assert parked_by_minute(none, none).count() == 0
    events = spark.createDataFrame([], "created_at timestamp, ingested_at timestamp")
    assert waiting_by_minute(events).count() == 0
