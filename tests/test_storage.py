"""The tables on disk: pruning, pushdown, compaction and retention."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from callstrata import contract
from callstrata.functions.filters import time_filter
from callstrata.operators.lookups import find_by
from callstrata.session import fresh_path
from callstrata.sources.hot import HotTable
from callstrata.sources.quarantine import Quarantine
from callstrata.sources.rollups import RollupTable


def event(request_id, created, **changes):
    row = {name: "" for name in contract.HOT_COLUMNS}
    row.update(schema_version=1, request_id=request_id, created_at=created,
               ingested_at=created + timedelta(seconds=1), http_status=200, latency_ms=5,
               payload_truncated=0, vendor_id="karza", status="SUCCESS", request_payload="{}",
               response_payload="null")
    row.update(changes)
    return tuple(row[name] for name in contract.HOT_COLUMNS)


@pytest.fixture()
def hot(spark):
    table = HotTable(spark, fresh_path(spark, "hot"), distinct_per_group=1000)
    days = [datetime(2024, 1, 1, 12) + timedelta(days=d) for d in range(0, 100, 10)]
    first = [event(f"r{i}", day) for i, day in enumerate(days)]
    again = [event(f"r{i}", day, ingested_at=day + timedelta(hours=1), latency_ms=9)
             for i, day in enumerate(days[:5])]
    table.write(spark.createDataFrame(first, contract.HOT_SCHEMA), "batch-0", 0)
    table.write(spark.createDataFrame(again, contract.HOT_SCHEMA), "batch-1", 1)
    return table


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_same_write_replaces_itself(spark, hot):
    before = hot.raw().count()
    rows = hot.raw().where("write_id = 'batch-1'").select(*contract.HOT_COLUMNS)
    copy = spark.createDataFrame(rows.collect(), contract.HOT_SCHEMA)
    hot.write(copy, "batch-1", 1)
    assert hot.raw().count() == before == 15


def test_time_filter_prunes_partitions_and_is_pushed_down(hot):
    rows = time_filter(hot.raw(), "created_at", "2024-01-05 00:00:00", "2024-01-25 00:00:00")
    plan = plan_of(rows.select("request_id"))
    partition_part = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ist_month" in partition_part and "ist_day" in partition_part
    assert "GreaterThanOrEqual(created_at" in plan and "LessThanOrEqual(created_at" in plan
    assert "request_payload" not in plan.split("ReadSchema")[1]
    assert rows.count() == 4


def test_lookup_is_pushed_down(hot):
    assert "EqualTo(user_id,user-1)" in plan_of(find_by(hot.raw(), "user_id", "user-1"))
    with pytest.raises(ValueError):
        find_by(hot.raw(), "endpoint", "x")


def test_bloom_filters_are_written(hot):
    import glob

    import pyarrow.parquet as pq

    assert hot.options["parquet.bloom.filter.enabled#request_id"] == "true"
    files = glob.glob(f"{hot.path}/ist_month=202401/**/*.parquet", recursive=True)
    column = pq.ParquetFile(files[0]).metadata.row_group(0).column(1)
    assert column.path_in_schema == "request_id" and column.compression == "ZSTD"


def test_compaction_keeps_the_final_rows(hot):
    expected = {(r.request_id, r.latency_ms) for r in hot.final().collect()}
    assert hot.compact("202401") == 8 and hot.compact("209901") == 0
    assert {(r.request_id, r.latency_ms) for r in hot.final().collect()} == expected
    january = hot.raw().where("ist_month = '202401'")
    assert january.count() == 4
    assert hot.raw().count() == 4 + 7
    assert {r.batch_id for r in january.collect()} == {1}


def test_compaction_rewrites_only_touched_days(spark, hot):
    for month in ("202401", "202402", "202403", "202404"):
        hot.compact(month)
    assert hot.compact("202401") == 0, "nothing new"
    assert "Window" not in plan_of(hot.final()), "settled months are not shuffled"
    expected = {r.request_id: r.latency_ms for r in hot.final().collect()}

    late = [event("r1", datetime(2024, 1, 25, 12), ingested_at=datetime(2024, 3, 1), latency_ms=77),
            event("new", datetime(2024, 1, 25, 12))]
    hot.write(spark.createDataFrame(late, contract.HOT_SCHEMA), "batch-2", 2)
    expected.update(r1=77, new=5)
    assert "Window" in plan_of(hot.final())
    assert {r.request_id: r.latency_ms for r in hot.final().collect()} == expected
    assert hot.compact("202401") == 2, "the new day, and the day of the older copy"
    assert {r.request_id: r.latency_ms for r in hot.raw().collect()} == expected


def test_rows_expire_by_whole_days_and_readers_see_the_exact_edge(hot):
    now = datetime(2024, 1, 11, 13) + timedelta(days=90)
    at = F.lit(str(now)).cast("timestamp")
    assert hot.drop_expired(now) == 1
    assert hot.raw().where("request_id = 'r0'").count() == 0
    assert hot.raw().where("request_id = 'r1'").count() == 2, "its day is not over"
    assert {r.request_id for r in hot.current(at).collect()} == {f"r{i}" for i in range(2, 10)}


def test_payloads_are_blanked_once(spark, hot):
    now = F.lit("2024-02-15 00:00:00").cast("timestamp")
    blanked = hot.blank_payloads(now)
    assert blanked == 4
    rows = {(r.request_id, r.latency_ms): r.request_payload for r in hot.raw().collect()}
    assert len(rows) == 15
    assert {rid for (rid, _), payload in rows.items() if payload == ""} == {"r0", "r1"}
    assert hot.blank_payloads(now) == 0, "nothing left to rewrite"


def test_quarantine_and_rollup_expire(spark):
    day = datetime(2024, 1, 1, 12)
    parked = spark.createDataFrame(
        [("b", "unparseable", False, day), ("c", "bad_stage", True, day + timedelta(days=20))],
        "body string, reason string, cold_written boolean, parked_at timestamp")
    quarantine = Quarantine(spark, fresh_path(spark, "quarantine"))
    assert quarantine.rows().count() == 0
    quarantine.write(parked, "batch-0")
    assert quarantine.drop_expired(day + timedelta(days=20)) == 1
    assert [r.body for r in quarantine.rows().collect()] == ["c"]

    rollup = RollupTable(spark, fresh_path(spark, "rollup"))
    assert rollup.merged().count() == 0
    rollup.add(spark.createDataFrame(
        [event("a", day), event("b", day + timedelta(days=40))], contract.HOT_SCHEMA), "batch-0")
    assert rollup.drop_expired(day + timedelta(days=40)) == 1
    assert rollup.merged().count() == 1
