"""Brute-force checks of the operators on data with one very hot key."""

import random
from datetime import datetime, timedelta

import numpy
import pytest
from pyspark.sql import functions as F

from callstrata.functions.quantiles import quantile
from callstrata.operators.dedup import hot_final, not_yet_cold
from callstrata.operators.intervals import waiting_by_minute
from callstrata.operators.islands import held_for
from callstrata.operators.retention import reconcile, tier_of
from callstrata.plans.alerts import alert_read_spike, histogram_quantile
from callstrata.plans.levels import level_of

START = datetime(2024, 1, 1)


def test_quantiles_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", rng.randrange(0, 3000)) for i in range(9000)]
    frame = spark.createDataFrame(rows, "k string, v bigint")
    named = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    for row in quantile(frame, ["k"], F.col("v"), named).collect():
        values = [v for k, v in rows if k == row.k]
        for name, q in named.items():
            assert row[name] == pytest.approx(numpy.quantile(values, q), abs=1e-6)
    approximate = quantile(frame, ["k"], F.col("v"), named, "approx").where("k = 'hot'").first()
    values = sorted(v for k, v in rows if k == "hot")
    assert approximate.p95 in values


def test_quantile_of_nothing(spark):
    frame = spark.createDataFrame([], "v bigint")
    assert quantile(frame, [], F.col("v"), {"p": 0.5}).first().p is None


@pytest.mark.parametrize("seed, longest", [(1, 5), (2, 90), (3, 20_000)])
def test_waiting_events_against_all_pairs(spark, seed, longest):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        created = START + timedelta(seconds=rng.randrange(0, 36_000), milliseconds=rng.randrange(1000))
        if i % 5 == 0:
            created = created.replace(second=0, microsecond=0)
        lag = timedelta(seconds=rng.randrange(-30, longest * 60))
        rows.append((created, START + timedelta(minutes=7) if i % 50 == 0 else created + lag))
    frame = spark.createDataFrame(rows, "created_at timestamp, ingested_at timestamp")
    found = {r.minute: (r.waiting, r.oldest_created) for r in waiting_by_minute(frame).collect()}
    expected, minute = {}, START
    last = max(ingested for _, ingested in rows)
    while minute <= last:
        open_ = [created for created, ingested in rows if created <= minute < ingested]
        if open_:
            expected[minute] = (len(open_), min(open_))
        minute += timedelta(minutes=1)
    assert found == expected


def test_last_copy_wins_for_an_id_with_a_third_of_all_rows(spark):
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        rows.append(("hot" if hot else f"r{i % 700}", START, START + timedelta(seconds=i % 10),
                     i // 100, i))
    frame = spark.createDataFrame(
        rows, "request_id string, created_at timestamp, ingested_at timestamp, batch_id int, delivery int")
    expected = {}
    for row in rows:
        best = expected.get(row[0])
        if best is None or row[2:] > best[2:]:
            expected[row[0]] = row
    assert {tuple(r) for r in hot_final(frame).collect()} == set(expected.values())
    plan = hot_final(frame)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ids_are_kept_apart_by_local_month(spark):
    rows = [("a", datetime(2024, 1, 31, 18, 0), START, 1), ("a", datetime(2024, 1, 31, 19, 0), START, 2)]
    frame = spark.createDataFrame(
        rows, "request_id string, created_at timestamp, ingested_at timestamp, delivery int")
    assert hot_final(frame).count() == 2


def test_cold_keys_are_not_written_twice(spark):
    events = spark.createDataFrame(
        [("k1", START, 1), ("k1", START, 2), ("k2", START, 1), ("k3", START, 1)],
        "s3_request_key string, received_at timestamp, delivery int")
    known = spark.createDataFrame([("k2",), ("k2",), ("k9",)], "s3_request_key string")
    left = {(r.s3_request_key, r.delivery) for r in not_yet_cold(events, known).collect()}
    assert left == {("k1", 1), ("k3", 1)}


def evaluations(spark, minutes):
    rows = [("v", START + timedelta(minutes=m), flag) for m, flag in minutes]
    return spark.createDataFrame(rows, "k string, window_end timestamp, breaching boolean")


def test_held_for(spark):
    frame = evaluations(spark, [(0, True), (1, True), (2, True), (3, False), (4, True), (5, True),
                                (7, True), (8, True), (9, True)])
    firing = {(r.window_end - START).seconds // 60: r.firing
              for r in held_for(frame, ["k"], 2).collect()}
    assert firing == {0: False, 1: False, 2: True, 4: False, 5: False, 7: False, 8: False, 9: True}
    assert all(r.firing for r in held_for(frame, ["k"], 0).collect())


def test_reconcile(spark):
    side = lambda *ids: spark.createDataFrame([(i,) for i in ids], "request_id string")
    rows = {r.request_id: (r.verdict, r.parked, r.cold_copies, r.hot_copies) for r in reconcile(
        side("p", "c"), side("c", "b"), side("b", "b", "h")).collect()}
    assert rows == {"p": ("parked_only", 1, 0, 0), "c": ("cold_only", 1, 1, 0),
                    "b": ("archived", 0, 1, 2), "h": ("hot_only", 0, 0, 1)}


@pytest.mark.parametrize("age, tier", [
    (0, "STANDARD"), (89, "STANDARD"), (90, "STANDARD_IA"), (364, "STANDARD_IA"),
    (365, "DEEP_ARCHIVE"), (4000, "DEEP_ARCHIVE")])
def test_tiers(spark, age, tier):
    assert spark.range(1).select(tier_of(F.lit(age)).alias("t")).first().t == tier


@pytest.mark.parametrize("panel, value, level", [
    ("fail_rate", 4.99, "green"), ("fail_rate", 5.0, "yellow"), ("fail_rate", 15.0, "red"),
    ("fun_success_rate", 89.9, "red"), ("fun_success_rate", 90.0, "yellow"),
    ("fun_success_rate", 97.0, "green"), ("ops_missing_keys", 1, "red"), ("lat_p95", None, "green"),
])
def test_levels(spark, panel, value, level):
    column = level_of(panel, F.lit(value).cast("double"))
    assert spark.range(1).select(column.alias("l")).first().l == level


@pytest.mark.parametrize("counts, expected", [
    ((10, 10, 10, 10, 10, 10, 10, 10), 47.5),
    ((0, 0, 0, 0, 0, 100, 100, 100), 1950.0),
    ((0, 0, 0, 0, 0, 0, 0, 5), 5000.0),
    ((50, 50, 50, 100, 100, 100, 100, 100), 470.0),
])
def test_histogram_quantile(spark, counts, expected):
    names = ["le_50", "le_100", "le_200", "le_500", "le_1000", "le_2000", "le_5000", "le_inf"]
    frame = spark.createDataFrame([counts], ", ".join(f"{n} bigint" for n in names))
    assert frame.select(histogram_quantile(0.95).alias("q")).first().q == pytest.approx(expected)


def test_read_spike_counts_one_bucket_only(spark):
    rows = [(START + timedelta(seconds=i), "GetObject", "archive") for i in range(60)]
    rows += [(START, "GetObject", "other")] * 60 + [(START, "PutObject", "archive")] * 60
    audit = spark.createDataFrame(rows, "event_time timestamp, event_name string, bucket string")
    windows = alert_read_spike(audit, "archive").collect()
    assert [(r.reads, r.firing) for r in windows] == [(60, True)]
