"""Held alerts of a stream: runs over micro-batches and restarts, quantiles, ends."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from callstrata.plans import alerts
from callstrata.session import LARGE_STATE_CONF, fresh_path, keep_large_state
from callstrata.streaming.alert_state import _percentile, held_alert_stream, judged

START = datetime(2024, 1, 1, 10)


@pytest.fixture(scope="module")
def large_state(spark):
    before = {key: spark.conf.get(key, None) for key in LARGE_STATE_CONF}
    keep_large_state(spark)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def calls(spark, *rows):
    return spark.createDataFrame(
        [(START + timedelta(minutes=m, seconds=20), vendor, status, latency)
         for m, vendor, status, latency in rows],
        "created_at timestamp, vendor_id string, status string, latency_ms bigint").coalesce(1)


def run(spark, folder, checkpoint, out):
    stream = spark.readStream.schema(
        "created_at timestamp, vendor_id string, status string, latency_ms bigint").option(
        "maxFilesPerTrigger", 1).parquet(folder)
    held_alert_stream(stream, "30 minutes").writeStream.format("parquet").option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()


def test_a_run_goes_on_after_a_restart_and_ends_when_calls_stop(spark, large_state):
    folder, checkpoint, out = (fresh_path(spark, name) for name in ("in", "checkpoint", "out"))
    first = [(m, "synoriq", "FAILURE", 100 + m) for m in range(0, 4)]
    second = [(m, "synoriq", "TIMEOUT", 6000) for m in range(4, 8)]
    later = [(m, "synoriq", "FAILURE", 100) for m in range(25, 27)]
    rows = second + first + later + [(5, "digitap", "FAILURE", 1), (5, "karza", "FAILURE", 1)]
    calls(spark, *second).write.mode("append").parquet(folder)
    calls(spark, *first, (5, "digitap", "FAILURE", 1), (5, "karza", "FAILURE", 1)).write.mode(
        "append").parquet(folder)
    run(spark, folder, checkpoint, out)
    assert spark.read.parquet(out).count() == 0, "the watermark has passed no window"
    calls(spark, *later, (39, "synoriq", "SUCCESS", 1)).write.mode("append").parquet(folder)
    run(spark, folder, checkpoint, out)
    before = spark.read.parquet(out).count()
    assert before > 0
    calls(spark, (9999, "synoriq", "SUCCESS", 1)).write.mode("append").parquet(folder)
    run(spark, folder, checkpoint, out)

    frame = calls(spark, *rows, (39, "synoriq", "SUCCESS", 1)).withColumn("service", F.lit("s"))
    expected = None
    for rule, batch in (
            *((name, alerts.alert_failure_rate(frame, name)) for name in alerts.FAILURE_RATE_RULES),
            ("p1_all_failing", alerts.alert_all_failing(frame)),
            ("p1_latency", alerts.alert_latency(frame)),
            ("p1_timeouts", alerts.alert_timeouts(frame))):
        batch = batch.withColumn("rule", F.lit(rule)).select(
            "vendor_id", "rule", "window_end", "value", "active_since", "firing")
        expected = batch if expected is None else expected.unionByName(batch)
    want = sorted(tuple(r) for r in expected.collect())
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(expected.columns).collect())
    assert got == want and len(got) > before
    rate = {r[2]: (r[4], r[5]) for r in got if r[:2] == ("synoriq", "p1_rate_high")}
    assert rate[START + timedelta(minutes=2)] == (START + timedelta(minutes=1), False)
    assert rate[START + timedelta(minutes=12)] == (START + timedelta(minutes=1), True)
    assert START + timedelta(minutes=13) not in rate, "no calls, no run"
    assert rate[START + timedelta(minutes=26)] == (START + timedelta(minutes=26), False)


@pytest.mark.parametrize("values", [[5], [1, 2], [1, 1, 1, 9], list(range(40)), [7] * 21 + [8]])
def test_quantile_interpolates(spark, values):
    counts = {v: values.count(v) for v in set(values)}
    expected = spark.createDataFrame([(v,) for v in values], "v bigint").agg(
        F.round(F.percentile("v", 0.95), 6)).first()[0]
    assert _percentile(counts, 0.95) == expected


def test_rules_by_hand():
    minute = {"counts": [4, 1, 3, 2], "latencies": {"10": 3, "9000": 1}}
    assert judged([minute], 5, "rate", 5.0) == (75.0, True)
    assert judged([minute], 5, "none_ok", 0.0) == (4.0, False)
    assert judged([minute, minute], 5, "timeouts", 1.0) == (4 / 300, False)
    assert judged([minute], 5, "p95", 5000.0)[1]
