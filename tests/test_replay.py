"""Replays of parked and of archived events that die at any step, and hot failures."""

import json
import uuid
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from callstrata import contract
from callstrata.session import fresh_path
from callstrata.sources.hot import HotTable
from callstrata.sources.quarantine import HOT_FAILED
from callstrata.sources.wire import stream_messages
from callstrata.streaming.ingest import Archive, start_ingest
from callstrata.streaming.replay import MOST_ATTEMPTS, rebuild_hot, replay_parked
from test_ingest import FULL, REQUIRED, body, frame, land


class Died(RuntimeError):
    pass


def die(*_, **__):
    raise Died


class Down(HotTable):
    def write(self, *_, **__):
        raise OSError("the hot table is down")


@pytest.fixture()
def archive(spark):
    return Archive.at(spark, fresh_path(spark, "archive"), park_hot_failures=True)


def state(archive):
    """All that a replay may touch."""
    return (
        sorted((r.request_id, r.latency_ms) for r in archive.hot.raw().collect()),
        sorted((r.request_id, r.s3_request_key) for r in archive.cold.metadata().collect()),
        archive.cold.documents().count(),
        sorted(tuple(map(str, r)) for r in archive.rollup.merged().collect()),
        sorted((r.body, r.reason) for r in archive.quarantine.rows().collect()),
    )


IDS = [f"11111111-2222-4333-8444-55555555555{n}" for n in range(4)]


def outage(archive):
    """Two messages wait for the hot table, one is unfit."""
    archive.ingest(frame(archive.hot.spark, body(request_id=IDS[0]), "{ poison"), 0, source="q")
    down = replace(archive, hot=Down(archive.hot.spark, archive.hot.path))
    down.ingest(frame(archive.hot.spark, body(request_id=IDS[1]),
                      body(request_id=IDS[2], latency_ms=7)), 1, source="q")


def test_hot_failure_parks_the_messages_and_the_batch_succeeds(archive):
    outage(archive)
    parked = {(r.reason, r.cold_written) for r in archive.quarantine.rows().collect()}
    assert parked == {("unparseable", False), (HOT_FAILED, True)}
    assert archive.cold.metadata().count() == 3, "cold has them"
    assert [r.request_id for r in archive.hot.raw().collect()] == [IDS[0]]
    assert archive.rollup.merged().agg(F.sum("total")).first()[0] == 1


def test_failed_batch_that_runs_again_leaves_nothing_parked(archive):
    outage(archive)
    archive.ingest(frame(archive.hot.spark, body(request_id=IDS[1]),
                         body(request_id=IDS[2], latency_ms=7)), 1, source="q")
    assert [r.reason for r in archive.quarantine.rows().collect()] == ["unparseable"]
    assert archive.hot.raw().count() == archive.cold.metadata().count() == 3


def test_stream_goes_on_while_the_hot_table_is_down(spark, archive):
    folder, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "checkpoint")
    down = replace(archive, hot=Down(spark, archive.hot.path))
    land(spark, folder, "1", body(request_id=IDS[0]))
    start_ingest(stream_messages(spark, folder), down, checkpoint, every=None).awaitTermination()
    land(spark, folder, "2", body(request_id=IDS[1]))
    start_ingest(stream_messages(spark, folder), archive, checkpoint, every=None
                 ).awaitTermination()
    assert [r.request_id for r in archive.hot.raw().collect()] == [IDS[1]]
    assert replay_parked(archive) == 1
    assert {r.request_id for r in archive.hot.raw().collect()} == set(IDS[:2])


def test_both_down_fails_the_batch(archive, monkeypatch):
    monkeypatch.setattr(archive.hot, "write", die)
    monkeypatch.setattr(archive.quarantine, "write", die)
    with pytest.raises(Died):
        archive.ingest(frame(archive.hot.spark, body()), 0, source="q")


def replayed(archive):
    assert replay_parked(archive, (HOT_FAILED,)) == 2
    return state(archive)


def test_replay_puts_parked_messages_into_all_tables(archive):
    outage(archive)
    hot, cold, documents, rollup, parked = replayed(archive)
    assert hot == [(IDS[0], 142), (IDS[1], 142), (IDS[2], 7)]
    assert len(cold) == 3 and documents == 6
    assert parked == [("{ poison", "unparseable")]
    assert archive.rollup.merged().agg(F.sum("total")).first()[0] == 3
    assert {r.reason for r in archive.quarantine.cleared().collect()} == {HOT_FAILED}
    before = state(archive)
    assert replay_parked(archive, (HOT_FAILED,)) == 0 and state(archive) == before


@pytest.mark.parametrize("step", [
    "cold.write", "hot.write", "rollup.add", "ledger.advance", "quarantine.clear",
    "quarantine.table.remove", "ledger.finish"])
def test_replay_that_died_at_any_step_is_taken_up(spark, archive, monkeypatch, step):
    outage(archive)
    # a message that was never archived, so that the replay writes cold, too
    archive.quarantine.write(frame(spark, body(request_id=IDS[3])).select(
        "body", F.lit(HOT_FAILED).alias("reason"), F.lit(False).alias("cold_written"),
        F.col("received_at").alias("parked_at")), "by-hand")
    # a hot table that fails would be parked; a process that died parks nothing
    one = replace(archive, park_hot_failures=False)
    *owners, name = step.split(".")
    owner = one
    for part in owners:
        owner = getattr(owner, part)
    with monkeypatch.context() as patch:
        patch.setattr(owner, name, die)
        with pytest.raises(Died):
            replay_parked(one, (HOT_FAILED,))
    late = frame(spark, body(request_id=str(uuid.uuid4()), loan_lifecycle_stage="NEW"))
    again = Archive.at(spark, archive.hot.path.rsplit("/", 1)[0])
    again.ingest(late, 5, source="q")
    assert replay_parked(again, (HOT_FAILED,)) == 3
    hot, cold, documents, rollup, parked = state(again)
    assert hot == [(IDS[0], 142), (IDS[1], 142), (IDS[2], 7), (IDS[3], 142)]
    assert len(cold) == 5 and documents == 10
    assert again.rollup.merged().agg(F.sum("total")).first()[0] == 4
    assert sorted(reason for _, reason in parked) == ["bad_stage", "unparseable"]
    assert again.quarantine.cleared().count() == 3
    assert replay_parked(again, (HOT_FAILED,)) == 0


def test_unfit_messages_come_back_with_one_attempt_more_until_they_stay(archive):
    outage(archive)
    assert replay_parked(archive) == 3
    for attempt in range(1, MOST_ATTEMPTS):
        row = archive.quarantine.rows().first()
        assert (row.reason, row.attempts) == ("unparseable", attempt)
        assert replay_parked(archive) == 1
    assert archive.quarantine.rows().first().attempts == MOST_ATTEMPTS
    assert replay_parked(archive) == 0
    assert archive.hot.raw().count() == 3


# -- from the archive --------------------------------------------------------------------


def lose(archive, *ids):
    table = archive.hot.table
    table.replace(table.files(), table.read().where(~F.col("request_id").isin(*ids)), "lost")


def three_vendors(spark, archive):
    archive.ingest(frame(
        spark, body(request_id=IDS[0], request_payload='{"k":1}'),
        body(request_id=IDS[1], vendor_id="", request_payload='{"k":2}'),
        body(REQUIRED, request_id=IDS[2], vendor_id=None, request_payload='{"k":3}',
             response_payload="{}"),
        body(request_id=IDS[3], latency_ms="many")), 0, source="q")


def test_rebuild_appends_events_of_empty_and_absent_vendors(spark, archive):
    three_vendors(spark, archive)
    before = {r.request_id: (r.vendor_id, r.request_payload) for r in archive.hot.raw().collect()}
    assert before == {IDS[0]: ("karza", '{"k":1}'), IDS[1]: ("", '{"k":2}'), IDS[2]: ("", '{"k":3}')}
    assert archive.cold.events().count() == 4
    lose(archive, *IDS)
    assert rebuild_hot(archive, "2026/05/29", "2026/05/30", vendor_id="") == 2
    assert {r.request_id for r in archive.hot.raw().collect()} == {IDS[1], IDS[2]}
    assert rebuild_hot(archive, "2026/05/28", "2026/05/28") == 0, "another day"
    assert rebuild_hot(archive, "2026/05/29", "2026/05/29") == 1, "not the one with a bad field"
    after = {r.request_id: (r.vendor_id, r.request_payload) for r in archive.hot.raw().collect()}
    assert after == before
    assert rebuild_hot(archive, "2026/05/29", "2026/05/29") == 0


@pytest.mark.parametrize("step", ["hot.write", "rollup.add", "ledger.advance", "ledger.finish"])
def test_rebuild_that_died_is_taken_up(spark, archive, monkeypatch, step):
    three_vendors(spark, archive)
    lose(archive, IDS[0])
    counted = archive.rollup.merged().agg(F.sum("total")).first()[0]
    owner, name = step.split(".")
    with monkeypatch.context() as patch:
        patch.setattr(getattr(archive, owner), name, die)
        with pytest.raises(Died):
            rebuild_hot(archive, "2026/05/29", "2026/05/29")
    again = Archive.at(spark, archive.hot.path.rsplit("/", 1)[0])
    rebuild_hot(again, "2026/05/29", "2026/05/29")
    assert sorted(r.request_id for r in again.hot.raw().collect()) == IDS[:3]
    assert again.rollup.merged().agg(F.sum("total")).first()[0] == counted + 1
    assert rebuild_hot(again, "2026/05/29", "2026/05/29") == 0


def test_few_missing_events_read_the_documents_without_a_shuffle(spark, archive):
    three_vendors(spark, archive)
    rows = archive.cold.metadata("karza").where(F.col("request_id") == IDS[0])
    plan = archive.cold.with_payloads(rows, "karza", ["2026/05/29"], few=True)
    assert plan.count() == 1
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftSemi") == 2
    physical = plan._jdf.queryExecution().sparkPlan().toString()
    semi = [line for line in physical.splitlines() if "LeftSemi" in line]
    assert len(semi) == 2 and all("BroadcastHashJoin" in line for line in semi)


def test_required_values_are_never_null(spark, archive):
    archive.ingest(frame(spark, body(
        {k: FULL[k] for k in ("schema_version", "request_id", "created_at",
                              "loan_lifecycle_stage")})), 0, source="q")
    row = archive.hot.raw().first()
    assert (row.vendor_id, row.status, row.latency_ms, row.service, row.endpoint) == (
        "", "", 0, "", "")
    nullable = {"loan_application_number", "http_status"}
    assert [n for n in contract.HOT_COLUMNS if row[n] is None and n not in nullable] == []
    merged = archive.rollup.merged().first()
    assert (merged.vendor_id, merged.total, merged.total_latency) == ("", 1, 0)


def test_a_field_of_the_wrong_type_keeps_the_others_and_goes_to_cold(spark, archive):
    wrong = {"http_status": "none", "payload_truncated": "yes", "latency_ms": 1.5}
    for number, (name, value) in enumerate(wrong.items()):
        archive.ingest(frame(spark, body(request_id=IDS[number], **{name: value})), number,
                       source="q")
    assert {r.reason for r in archive.quarantine.rows().collect()} == {"bad_field"}
    assert {r.user_id for r in archive.cold.metadata().collect()} == {"user-5"}
    assert archive.hot.raw().count() == 0
    assert archive.cold.events().where("request_payload IS NULL").count() == 0


def test_malformed_lines_of_the_archive_are_counted(spark, archive):
    three_vendors(spark, archive)
    assert archive.cold.malformed().count() == 0
    path = archive.cold.meta.files()[0].path
    text = f"{archive.cold.meta.data_path}/{path}"
    lines = [r.value for r in spark.read.text(text).collect()]
    with open(text.replace("file:", ""), "w", encoding="utf-8") as target:
        target.write("\n".join([*lines, "{ broken"]))
    import pathlib
    crc = pathlib.Path(text.replace("file:", ""))
    (crc.parent / f".{crc.name}.crc").unlink(missing_ok=True)
    assert [tuple(r) for r in archive.cold.malformed().collect()] == [("{ broken", 1)]
    assert json.loads(lines[0])
