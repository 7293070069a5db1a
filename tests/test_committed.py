"""Tables by commits: snapshots, conflicts, retries, pruning, merging and their cost."""

import json
import random
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from callstrata import contract
from callstrata.operators.dedup import not_yet_cold
from callstrata.session import fresh_path
from callstrata.sources import committed
from callstrata.sources.committed import CommitLog, CommittedTable, Conflict, DataFile
from callstrata.sources.files import list_files, read_text, write_text
from callstrata.sources.hot import HotTable
from callstrata.sources.key_index import KeyIndex
from callstrata.sources.rollups import RollupTable

from test_storage import event

SCHEMA = "n BIGINT, name STRING, day STRING"


@pytest.fixture()
def table(spark):
    return CommittedTable(spark, fresh_path(spark, "table"), SCHEMA, ("day",), ranges=("n",))


def rows(spark, *values, day="d1"):
    return spark.createDataFrame([(n, f"x{n}", day) for n in values], SCHEMA)


def numbers(frame):
    return sorted(r.n for r in frame.collect())


def test_writes_append_and_retries_replace(spark, table):
    assert table.read().count() == 0 and table.read().columns == ["n", "name", "day"]
    table.write(rows(spark, 1, 2), "a")
    table.write(rows(spark, 3, day="d2"), "b")
    table.write(rows(spark, 1, 2, 4), "a")
    assert numbers(table.read()) == [1, 2, 3, 4]
    # another process finds the same
    other = CommittedTable(spark, table.path, SCHEMA, ("day",), ranges=("n",))
    assert numbers(other.read()) == [1, 2, 3, 4]
    table.write(rows(spark).limit(0), "a")
    assert numbers(other.read()) == [3], "a retry without rows takes its own rows out"


def test_odd_partition_values(spark, table):
    for number, day in enumerate(["a/b", "x=y z", "[k]%{1}", "", "é"]):
        table.write(rows(spark, number, day=day), f"w{number}")
    found = {r.n: r.day for r in table.read().collect()}
    assert found == {0: "a/b", 1: "x=y z", 2: "[k]%{1}", 3: None, 4: "é"}
    assert {f.partition("day") for f in table.files()} == {"a/b", "x=y z", "[k]%{1}", None, "é"}
    assert {f.rows for f in table.files()} == {1}


def test_files_know_their_ranges(spark, table):
    table.write(rows(spark, *range(10)), "a")
    table.write(rows(spark, *range(100, 110)), "b")
    table.write(spark.createDataFrame([(None, "x", "d1")], SCHEMA), "c")
    assert [f.ranges["n"] for f in table.files(lambda f: f.write_id == "b")] == [(100, 109)]
    near = table.files(lambda f: f.meets("n", 5, 50))
    assert {f.write_id for f in near} == {"a"}
    assert numbers(table.read(near)) == list(range(10))
    assert {f.write_id for f in table.files(lambda f: f.meets("n", 200))} == set()


def test_readers_see_each_row_once_while_files_are_replaced(spark, table):
    for n in range(4):
        table.write(rows(spark, n), f"w{n}")
    before = table.read()
    assert table.merge_small(most=3) == 4
    assert len(table.files()) == 1
    assert numbers(before) == numbers(table.read()) == [0, 1, 2, 3]
    assert table.vacuum(grace=3600) == 0, "open readers keep their files"
    assert table.vacuum(grace=0) == 4
    assert len(list_files(spark, table.path)) == 1 and numbers(table.read()) == [0, 1, 2, 3]
    assert table.vacuum(grace=0) == 0


def test_second_of_two_replacements_changes_nothing(spark, table):
    table.write(rows(spark, 1), "a")
    old = table.files()
    other = CommittedTable(spark, table.path, SCHEMA, ("day",), ranges=("n",))
    other.replace(old, rows(spark, 10), "m1")
    with pytest.raises(Conflict):
        table.replace(old, rows(spark, 20), "m2")
    assert numbers(table.read()) == numbers(other.read()) == [10]
    assert len(list_files(spark, table.path)) == 2, "what lost was deleted"


def test_files_of_a_failed_write_are_not_read(spark, table, monkeypatch):
    table.write(rows(spark, 1), "a")
    monkeypatch.setattr(table.log, "commit", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.write(rows(spark, 2), "b")
    monkeypatch.undo()
    assert numbers(table.read()) == [1]


def test_concurrent_commits_all_count(spark):
    path = fresh_path(spark, "log")
    logs = [CommitLog(spark, path) for _ in range(4)]

    def work(log, name):
        for n in range(6):
            log.commit(lambda: ([DataFile(f"day=x/{name}-{n}.parquet", name, 1, 1)], ()))

    threads = [threading.Thread(target=work, args=(log, f"w{i}")) for i, log in enumerate(logs)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    fresh = CommitLog(spark, path)
    fresh.refresh()
    assert fresh.version == 24 and len(fresh.live) == 24


def test_commit_number_is_taken_once(spark):
    path = fresh_path(spark, "numbers") + "/1.json"
    assert write_text(spark, path, "first") and not write_text(spark, path, "second")
    assert read_text(spark, path) == "first"
    assert write_text(spark, path, "third", replace=True) and read_text(spark, path) == "third"
    assert read_text(spark, path + "-none") is None


def test_a_batch_costs_the_same_after_many(spark, monkeypatch):
    path = fresh_path(spark, "log")
    log = CommitLog(spark, path)
    reads = []
    monkeypatch.setattr(committed, "read_text",
                        lambda spark, path: reads.append(path) or read_text(spark, path))
    per_batch = []
    for n in range(200):
        reads.clear()
        log.commit(lambda: ([DataFile(f"day=x/{n}.parquet", f"w{n}", 1, 1)], ()))
        per_batch.append(len(reads))
    assert set(per_batch) == {2}, "one look for a next commit, one at the last checkpoint"
    # a new process reads the last checkpoint and what came after it
    reads.clear()
    fresh = CommitLog(spark, path)
    fresh.refresh()
    assert fresh.live == log.live and fresh.by_write == log.by_write
    late = CommitLog(spark, path)
    late._load(committed.CHECKPOINT * 3)
    reads.clear()
    late.refresh()
    assert late.live.keys() == log.live.keys() and len(reads) <= 200 - 192 + 2


def test_first_look_starts_at_the_checkpoint_when_old_commits_are_gone(spark):
    path = fresh_path(spark, "log")
    log = CommitLog(spark, path)
    for n in range(committed.CHECKPOINT + 3):
        log.commit(lambda: ([DataFile(f"day=x/{n}.parquet", f"w{n}", 1, 1)],
                            [f"day=x/{n - 1}.parquet"] if n % 5 == 0 and n else ()))
    from callstrata.sources.files import drop_files
    drop_files(spark, [log._commit_path(v) for v in range(1, committed.CHECKPOINT + 1)])
    fresh = CommitLog(spark, path)
    fresh.refresh()
    assert fresh.live == log.live and fresh.gone.keys() == log.gone.keys()


# -- the hot table ---------------------------------------------------------------------


def test_hot_files_lie_in_day_folders_only(spark):
    hot = HotTable(spark, fresh_path(spark, "hot"), distinct_per_group=100)
    day = datetime(2024, 1, 1, 12)
    for n in range(5):
        hot.write(spark.createDataFrame([event(f"r{n}", day)], contract.HOT_SCHEMA), f"b-{n}")
    folders = {path.rsplit("/", 1)[0] for path, _ in list_files(spark, hot.path)}
    assert folders == {"ist_month=202401/ist_day=2024-01-01"}
    assert len(hot.raw().inputFiles()) == 5
    assert hot.compact("202401") == 5 and len(hot.raw().inputFiles()) == 1
    assert hot.raw().count() == 5 and hot.vacuum(0) == 5


def test_range_of_ingest_times_reads_only_its_files(spark):
    hot = HotTable(spark, fresh_path(spark, "hot"), distinct_per_group=100)
    day = datetime(2024, 1, 1, 12)
    for n in range(4):
        hot.write(spark.createDataFrame(
            [event(f"r{n}", day, ingested_at=day + timedelta(hours=n))],
            contract.HOT_SCHEMA), f"b-{n}")
    late = hot.between("ingested_at", day + timedelta(hours=2), None)
    assert len(late.inputFiles()) == 2 and {r.request_id for r in late.collect()} == {"r2", "r3"}
    some = hot.between("created_at", day, day)
    assert some.count() == 4
    assert hot.between("created_at", day + timedelta(days=1), None).count() == 0
    with pytest.raises(ValueError):
        hot.between("status", None, None)


def test_range_without_copies_sees_copies_outside_of_it(spark):
    hot = HotTable(spark, fresh_path(spark, "hot"), distinct_per_group=100)
    day = datetime(2024, 1, 5, 12)
    hot.write(spark.createDataFrame([event("r", day)], contract.HOT_SCHEMA), "b-0")
    hot.write(spark.createDataFrame(
        [event("r", day + timedelta(days=3), ingested_at=day + timedelta(days=9))],
        contract.HOT_SCHEMA), "b-1")
    assert hot.between("created_at", day, day, final=True).count() == 0
    assert hot.between("created_at", day, day).count() == 1


def test_rollup_days_are_merged(spark):
    rollup = RollupTable(spark, fresh_path(spark, "rollup"))
    day = datetime(2024, 1, 1, 12)
    for n in range(6):
        rollup.add(spark.createDataFrame(
            [event(f"r{n}", day), event(f"s{n}", day)], contract.HOT_SCHEMA), f"b-{n}")
    expected = [tuple(r) for r in rollup.merged().collect()]
    assert rollup.compact(most=3) == 0, "batches that may be tried again stay"
    assert rollup.compact(most=3, settled=0) == 6
    assert rollup.partials().count() == 1
    assert [tuple(r) for r in rollup.merged().collect()] == expected
    assert expected[0][-2] == 12


# -- the key index -----------------------------------------------------------------------


def test_index_has_few_runs_and_finds_exactly_its_keys(spark):
    index = KeyIndex(spark, fresh_path(spark, "index"))
    draw = random.Random(1)
    known, sizes = {}, []
    for n in range(30):
        keys = [f"2024/01/0{1 + k % 2}/v/e/u/{draw.random()}/request.json.gz" for k in range(6)]
        known[f"w{n}"] = keys
        index.add(spark.createDataFrame([(k, k[:10]) for k in keys],
                                        "s3_request_key string, cold_day string"), f"w{n}")
        sizes.append(len(index.files(["2024/01/01"])))
    assert max(sizes) <= 9 + 1 and sizes[-1] <= 9
    every = [k for keys in known.values() for k in keys]
    days = ["2024/01/01", "2024/01/02"]
    assert {r[0] for r in index.keys(days).collect()} == set(every)
    asked = draw.sample(every, 20) + ["2024/01/01/v/e/u/new/request.json.gz"]
    frame = spark.createDataFrame([(k,) for k in asked + asked[:3]], "s3_request_key string")
    for size in (None, 24):
        found = [r[0] for r in index.known(frame, days, size=size).collect()]
        assert sorted(found) == sorted(set(asked) & set(every))
    # what a write itself put in is not known to it, in merged runs either
    own = spark.createDataFrame([(k,) for k in known["w0"]], "s3_request_key string")
    assert index.known(own, days, except_write="w0").count() == 0
    assert index.known(own, days, except_write="w1").count() == 6
    assert index.known(own, ["2023/01/01"]).count() == 0


def test_index_of_many_hits_joins(spark, monkeypatch):
    from callstrata.sources import key_index

    monkeypatch.setattr(key_index, "NAMED_HASHES", 2)
    index = KeyIndex(spark, fresh_path(spark, "index"))
    keys = [f"2024/01/01/v/e/u/{n}/request.json.gz" for n in range(50)]
    frame = spark.createDataFrame([(k, k[:10]) for k in keys],
                                  "s3_request_key string, cold_day string")
    index.add(frame, "w")
    assert index.known(frame.limit(40), ["2024/01/01"]).count() == 40


def test_colliding_hashes_do_not_hide_a_key(spark, monkeypatch):
    from callstrata.sources import key_index

    monkeypatch.setattr(key_index, "key_hash", lambda key: F.lit(7).cast("bigint"))
    index = KeyIndex(spark, fresh_path(spark, "index"))
    frame = spark.createDataFrame([("a", "d"), ("b", "d")], "s3_request_key string, cold_day string")
    index.add(frame, "w")
    asked = spark.createDataFrame([("b",), ("c",)], "s3_request_key string")
    known = index.known(asked, ["d"])
    assert [r[0] for r in known.collect()] == ["b"]
    left = not_yet_cold(asked.withColumn("received_at", F.current_timestamp()), known, 2)
    assert [r.s3_request_key for r in left.collect()] == ["c"]


def test_entries_survive_json(spark):
    file = DataFile("a=1/b.parquet", "w", 3, 4, {"n": (None, None)})
    assert DataFile.of(json.loads(json.dumps(file.entry()))).ranges == {"n": (None, None)}
