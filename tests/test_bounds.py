"""Work per task and per join stays bounded as tables grow."""

import pytest
from pyspark.sql import functions as F

from callstrata.operators import dedup
from callstrata.operators.dedup import MAX_BROADCAST_KEYS, new_objects, not_yet_cold
from callstrata.session import bounded_tasks, fresh_path
from callstrata.sources import committed
from callstrata.sources.cold import ColdArchive
from callstrata.sources.files import path_exists, staged
from callstrata.sources.hot import HotTable
from callstrata.streaming import replay
from callstrata.streaming.ingest import Archive
from callstrata.verification import sample, streams
from callstrata.verification.archive import archived_events
from test_ingest import body, frame


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", [None, MAX_BROADCAST_KEYS + 1])
def test_keys_of_no_small_number_are_not_broadcast(spark, size):
    path = fresh_path(spark, "keys")
    spark.range(1000).select(F.format_string("a/%d", "id").alias("s3_request_key")).write.parquet(path)
    batch = spark.createDataFrame([("a/1", 1), ("b/2", 2), ("b/2", 3)],
                                  "s3_request_key string, received_at int")
    new = not_yet_cold(batch, spark.read.parquet(path), size)
    assert "BroadcastHashJoin" not in plan_of(new)
    assert [tuple(row) for row in new.collect()] == [("b/2", 2)]


@pytest.fixture(scope="module")
def larger(spark):
    """The events of five tasks in one file, as one split."""
    folder = fresh_path(spark, "larger")
    rows = 5 * sample.ROWS_PER_TASK - 10
    spark.range(rows).select(
        F.col("id").alias("event_id"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"),
        (F.col("id") % 100).alias("user_id"), F.lit("view").alias("event_type"),
        F.lit(1.5).alias("value")).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def test_call_events_are_made_by_tasks_of_few_events(spark, larger):
    most = (sample.call_events(spark, larger).groupBy(F.spark_partition_id()).count()
            .agg(F.max("count"), F.count("*")).first())
    assert most[0] < 2 * sample.ROWS_PER_TASK and most[1] == 5


def test_streams_read_files_of_few_events(spark, larger):
    rows = sample.hot_events(spark, larger).select("request_id", "created_at")
    path, half = sample.landed(spark, rows, "parquet", streams.FILES)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()
    assert max(row["count"] for row in files) < 2 * sample.ROWS_PER_TASK
    assert (len(files), half) == (5, 3)


def test_landed_files_make_two_batches_of_a_small_table(spark, sf_dir):
    rows = sample.hot_events(spark, sf_dir).select("request_id")
    path, half = sample.landed(spark, rows, "parquet", streams.FILES)
    assert half == streams.FILES // 2
    assert spark.read.parquet(path).count() == rows.count()


def test_metadata_is_compressed_and_whole(spark, sf_dir):
    archive = ColdArchive(spark, fresh_path(spark, "cold"))
    events = archived_events(spark, sf_dir)
    archive.write(events, "batch-0")
    assert all(file.path.endswith(".gz") for file in archive.meta.files())
    assert archive.metadata().count() == events.count()
    assert archive.malformed().count() == 0


def test_bounds_nest_and_end(spark):
    names = ("spark.sql.files.maxPartitionBytes",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes",
             "spark.sql.adaptive.coalescePartitions.initialPartitionNum")

    def seen():
        return [spark.conf.get(name, None) for name in names]

    before = seen()
    with bounded_tasks(spark):
        with bounded_tasks(spark, 10_000_000):
            assert seen() == [str(8 << 20), str(32 << 20), "200"]
        assert seen()[:2] == [str(8 << 20), str(32 << 20)]
    assert seen() == before
    spark.conf.set(names[0], "1m")
    try:
        with bounded_tasks(spark):
            assert spark.conf.get(names[0]) == "1m"
    finally:
        spark.conf.unset(names[0])


def test_streaming_ingest_takes_few_bytes_a_task(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(Archive, "ingest", lambda self, messages, batch_id, *, source:
                        seen.append(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    streams._stream_into_archive(spark, sf_dir)
    assert seen == [str(8 << 20)] * 2


def test_only_rows_that_may_not_be_new_are_dealt_out(spark):
    """Three keys: one new, one that came twice, one that the archive has."""
    path = fresh_path(spark, "keys")
    spark.createDataFrame([("a",), ("z",)], "s3_request_key string").write.parquet(path)
    batch = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 4), ("b", 3), ("c", 5), (None, 6)],
        "s3_request_key string, received_at int")
    with new_objects(batch, spark.read.parquet(path)) as new:
        assert sorted(map(tuple, new.collect()), key=str) == [("b", 3), ("c", 5), (None, 6)]
        single = plan_of(new).split("Union")[1]
        assert "LeftAnti, BuildRight" in single
    wide = sorted(map(tuple, not_yet_cold(batch, spark.read.parquet(path)).collect()), key=str)
    assert wide == [("b", 3), ("c", 5), (None, 6)]


def test_many_rows_that_may_not_be_new_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(dedup, "MAX_BROADCAST_KEYS", 1)
    keys = spark.createDataFrame([("a",), ("z",)], "s3_request_key string")
    batch = spark.createDataFrame([("a", 1), ("b", 4), ("b", 3), ("c", 5)],
                                  "s3_request_key string, received_at int")
    with new_objects(batch, keys) as new:
        assert "BroadcastHashJoin" not in plan_of(new)
        assert sorted(map(tuple, new.collect())) == [("b", 3), ("c", 5)]


def test_a_micro_batch_has_few_files_of_a_large_table(spark, monkeypatch):
    rows = spark.range(100).repartition(10)
    monkeypatch.setattr(sample, "BATCH_FILES", 3)
    path, most = sample.landed(spark, rows, "parquet", streams.FILES)
    assert most == 3 and spark.read.parquet(path).count() == 100


def test_replaced_rows_are_shuffled_in_enough_partitions(spark, monkeypatch):
    seen = []

    def bounded(session, rows=None):
        seen.append(rows)
        return bounded_tasks(session, rows)

    monkeypatch.setattr(committed, "bounded_tasks", bounded)
    table = committed.CommittedTable(spark, fresh_path(spark, "t"), "id BIGINT, part STRING",
                                     ("part",), ranges=("id",))
    table.write(spark.range(20).withColumn("part", F.lit("x")), "first")
    table.replace(table.files(), table.read().distinct(), "second")
    assert seen == [None, 20] and table.read().count() == 20


def test_deduplication_keeps_its_state_on_disk(spark, sf_dir, monkeypatch):
    name = "spark.sql.streaming.stateStore.providerClass"
    seen, run = [], streams.finish
    monkeypatch.setattr(streams, "finish", lambda stream: (
        seen.append(spark.conf.get(name)), run(stream)))
    before = spark.conf.get(name)
    found = streams.deduplicated(spark, sf_dir)
    assert "RocksDB" in seen[0] and spark.conf.get(name) == before
    assert found.count() == found.select("request_id").distinct().count()


def kept_on_the_heap(spark, besides):
    """Ids of what the session keeps in memory now."""
    kept = spark.sparkContext._jsc.getPersistentRDDs()
    return {k for k in kept.keySet() if kept[k].getStorageLevel().useMemory()} - set(besides)


IDS = [f"11111111-2222-4333-8444-55555555555{n}" for n in range(4)]


def test_a_batch_is_not_kept_on_the_heap(spark, monkeypatch):
    before, seen, write = kept_on_the_heap(spark, ()), [], HotTable.write

    def watched(self, rows, *some, **named):
        seen.append((kept_on_the_heap(spark, before), len(rows.inputFiles())))
        write(self, rows, *some, **named)

    monkeypatch.setattr(HotTable, "write", watched)
    archive = Archive.at(spark, fresh_path(spark, "archive"))
    archive.ingest(frame(spark, body(request_id=IDS[0]), body(request_id=IDS[1]), "{ poison"),
                   0, source="q")
    assert [kept for kept, _ in seen] == [set()]
    assert seen[0][1] > 0, "the hot rows are made from stored fields"
    assert archive.hot.raw().count() == 2
    assert [r.body for r in archive.quarantine.rows().collect()] == ["{ poison"]


def test_staged_rows_are_gone_after_their_block(spark):
    with pytest.raises(ZeroDivisionError), staged(spark.range(5), "some") as rows:
        path = rows.inputFiles()[0].rsplit("/", 1)[0]
        assert rows.count() == 5 and path_exists(spark, path)
        1 / 0
    assert not path_exists(spark, path)


def test_known_keys_are_not_kept_on_the_heap(spark):
    keys = spark.createDataFrame([("a",), ("z",)], "s3_request_key string")
    batch = spark.createDataFrame([("a", 1), ("b", 4)], "s3_request_key string, received_at int")
    before = kept_on_the_heap(spark, ())
    with new_objects(batch, keys) as new:
        assert [tuple(row) for row in new.collect()] == [("b", 4)]
        assert kept_on_the_heap(spark, before) == set()


@pytest.mark.parametrize("few", [False, True])
def test_rebuilt_rows_are_shuffled_in_enough_partitions(spark, monkeypatch, few):
    """Four archived events, one of them missing: with it the metadata of all four is
    shuffled, and their documents, too, unless it is sent to all tasks."""
    archive = Archive.at(spark, fresh_path(spark, "archive"))
    archive.ingest(frame(spark, *[body(request_id=i) for i in IDS]), 0, source="q")
    hot = archive.hot.table
    hot.replace(hot.files(), hot.read().where(F.col("request_id") != IDS[0]), "kept")
    seen = []

    def bounded(session, rows=None):
        seen.append(rows)
        return bounded_tasks(session, rows)

    monkeypatch.setattr(replay, "bounded_tasks", bounded)
    monkeypatch.setattr(replay, "BROADCAST_BYTES", replay.BROADCAST_BYTES if few else 0)
    assert replay.rebuild_hot(archive, "2026/05/28", "2026/05/30") == 1
    assert seen == [4, 1 if few else 4]
    assert sorted(r.request_id for r in archive.hot.raw().collect()) == IDS
