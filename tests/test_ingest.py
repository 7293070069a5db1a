"""Ingest of single messages, and the streaming job with its failure cases."""

import json
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from callstrata import contract
from callstrata.operators.ingest import (
    hot_rows, parse_messages, quarantine_rows, skipped_versions, to_messages, wire_rename,
)
from callstrata.operators.dedup import MAX_BROADCAST_KEYS, not_yet_cold
from callstrata.plans.views import register_views
from callstrata.session import LARGE_STATE_CONF, fresh_path, keep_large_state
from callstrata.sources.wire import stream_messages
from callstrata.streaming.ingest import Archive, start_ingest
from callstrata.streaming.windows import dedup_stream

FULL = {
    "schema_version": 1, "request_id": "11111111-2222-4333-8444-555555555555",
    "created_at": "2026-05-29T08:30:00.000Z", "service": "identity-api",
    "environment": "prod", "vendor_id": "karza", "endpoint": "/kyc/verify",
    "vendor_ref_id": "txn-1", "loan_lifecycle_stage": "KYC",
    "loan_application_number": "LAN-1", "user_id": "user-5", "pan_masked": "ABC****34F",
    "mobile_hash": "aa", "mobile_last4": "3210", "aadhaar_last4_hash": "bb",
    "consent_id": "c-1", "status": "SUCCESS", "http_status": 200, "latency_ms": 142,
    "request_payload": '{"pan":"ABCDE1234F","mobile":"9876543210"}',
    "response_payload": '{"aadhaar":"1234 5678 9012"}',
    "payload_truncated": False, "request_hash": "cc", "correlation_id": "ignored",
}
REQUIRED = {key: FULL[key] for key in (
    "schema_version", "request_id", "created_at", "service", "vendor_id", "endpoint",
    "loan_lifecycle_stage", "status", "latency_ms")}


def body(base=FULL, **changes):
    return json.dumps({**base, **changes})


def frame(spark, *bodies):
    at = datetime(2026, 5, 29, 8, 30, 1, 500_000)
    return spark.createDataFrame([(b, at) for b in bodies], "body string, received_at timestamp")


def reasons(spark, *bodies):
    parsed = parse_messages(frame(spark, *bodies)).select("body", "reason").collect()
    found = {row.body: row.reason for row in parsed}
    return [found[b] for b in bodies]


def test_full_event(spark):
    row = hot_rows(frame(spark, body())).first().asDict()
    assert list(row) == list(contract.HOT_COLUMNS)
    assert row["request_payload"] == '{"pan":"ABC****34F","mobile":"******3210"}'
    assert row["response_payload"] == '{"aadhaar":"[AADHAAR_REDACTED]"}'
    assert row["aadhaar_last4_encrypted"] == ""
    assert row["payload_truncated"] == 0
    assert row["s3_request_key"] == (
        "2026/05/29/karza/kyc_verify/user-5/" + FULL["request_id"] + "/request.json.gz")
    assert row["environment"] == "prod"


def test_defaults_replace_only_missing_values(spark):
    row = hot_rows(frame(spark, body(
        REQUIRED, http_status=0, latency_ms=0, environment="", request_payload="{}",
        response_payload="null")), "staging").first()
    assert row.environment == "" and row.http_status == 0 and row.latency_ms == 0
    assert row.loan_application_number is None
    for name in contract.OPTIONAL_WIRE_COLUMNS:
        if name != "loan_application_number":
            assert row[name] == "", name
    row = hot_rows(frame(spark, body(REQUIRED, request_payload="1", response_payload="2")),
                   "staging").first()
    assert row.environment == "staging" and row.http_status is None
    assert "/unknown/" in row.s3_request_key


def test_each_bad_message_is_set_aside_alone(spark):
    cases = {
        body(): None,
        "{ this is not json": "unparseable",
        "": "unparseable",
        "null": "unparseable",
        "[" + body() + "]": "unparseable",
        body() + " x": "unparseable",
        " " + body() + " \n": None,
        body(latency_ms="many"): "bad_field",
        body(schema_version=2): "unsupported_version",
        json.dumps({k: v for k, v in FULL.items() if k != "schema_version"}):
            "unsupported_version",
        body(request_id="good-1"): "bad_request_id",
        body(loan_lifecycle_stage=""): "bad_stage",
        body(loan_lifecycle_stage="kyc"): "bad_stage",
        body(created_at="yesterday"): "bad_created_at",
    }
    assert reasons(spark, *cases) == list(cases.values())
    parsed = parse_messages(frame(spark, *cases))
    assert quarantine_rows(parsed).count() == 10
    assert {row.schema_version for row in skipped_versions(parsed).collect()} == {2, None}


@pytest.mark.parametrize("stage", contract.LIFECYCLE_STAGES)
def test_all_stages_pass(spark, stage):
    assert reasons(spark, body(loan_lifecycle_stage=stage)) == [None]


def test_oversized_message_keeps_metadata(spark):
    events = spark.read.schema(contract.WIRE_SCHEMA).json(
        spark.createDataFrame([(body(request_payload="x" * 500),)], "value string").rdd.map(
            lambda row: row.value))
    small = json.loads(to_messages(events, max_bytes=400).first().body)
    assert small["request_payload"] == small["response_payload"] == "[OVERSIZED]"
    assert small["payload_truncated"] is True and small["user_id"] == "user-5"
    assert json.loads(to_messages(events).first().body)["request_payload"] == "x" * 500


def test_rename(spark):
    names = wire_rename(spark.createDataFrame(
        [tuple("x" * 25)], [
            "schemaVersion", "requestId", "createdAt", "service", "environment", "vendorId",
            "endpoint", "vendorRefId", "loanLifecycleStage", "loanApplicationNumber", "userId",
            "panMasked", "mobileHash", "mobileLast4", "aadhaarLast4Hash", "consentId", "status",
            "httpStatus", "latencyMs", "errorCode", "errorMessage", "requestPayload",
            "responsePayload", "payloadTruncated", "requestHash"])).columns
    assert names == list(contract.WIRE_COLUMNS)


# -- streaming ----------------------------------------------------------------------


def land(spark, folder, name, *bodies):
    """One landed file."""
    spark.createDataFrame([(b,) for b in bodies], "value string").coalesce(1).write.mode(
        "append").text(folder)


def run(spark, archive, folder, checkpoint):
    start_ingest(stream_messages(spark, folder), archive, checkpoint, every=None
                 ).awaitTermination()


@pytest.fixture()
def place(spark):
    return (Archive.at(spark, fresh_path(spark, "archive")), fresh_path(spark, "landing"),
            fresh_path(spark, "checkpoint"))


def test_stream_survives_restart_redelivery_and_poison(spark, place):
    archive, folder, checkpoint = place
    other = str(uuid.uuid4())
    land(spark, folder, "1", body(), "{ poison", body(schema_version=2, request_id=other))
    run(spark, archive, folder, checkpoint)
    land(spark, folder, "2", body(latency_ms=143), body(request_id=other))
    run(spark, archive, folder, checkpoint)  # a new query on the same checkpoint

    assert archive.hot.raw().count() == 3
    final = {row.request_id: row for row in archive.hot.final().collect()}
    assert len(final) == 2
    assert final[FULL["request_id"]].latency_ms == 143, "the last delivery wins"
    assert archive.cold.metadata().count() == 2, "a re-delivery is not archived again"
    meta = archive.cold.metadata().where(F.col("request_id") == FULL["request_id"]).first()
    assert meta.latency_ms == 142 and meta.correlation_id is None
    assert [row.reason for row in archive.quarantine.rows().collect()] == ["unparseable"]
    merged = archive.rollup.merged().agg(F.sum("total").alias("n")).first()
    assert merged.n == 3, "the rollup counts deliveries"
    documents = archive.cold.documents().where("kind = 'request'").collect()
    assert all("ABCDE1234F" in row.payload for row in documents), "cold keeps the raw text"
    assert archive.hot.raw().where(F.col("request_payload").contains("ABCDE1234F")).count() == 0


def test_batch_that_failed_between_cold_and_hot_runs_again(spark, place, monkeypatch):
    archive, folder, checkpoint = place
    land(spark, folder, "1", body(), body(request_id=str(uuid.uuid4())))
    write = archive.hot.write
    monkeypatch.setattr(archive.hot, "write", lambda *a, **k: 1 / 0)
    with pytest.raises(Exception):
        run(spark, archive, folder, checkpoint)
    assert archive.cold.metadata().count() == 2 and archive.hot.raw().count() == 0
    monkeypatch.setattr(archive.hot, "write", write)
    run(spark, archive, folder, checkpoint)
    assert archive.cold.metadata().count() == 2
    assert archive.cold.documents().count() == 4
    assert archive.hot.raw().count() == 2


def test_cold_scan_needs_a_vendor(spark, place):
    archive, folder, checkpoint = place
    land(spark, folder, "1", body(), body(vendor_id="crif", request_id=str(uuid.uuid4())))
    run(spark, archive, folder, checkpoint)
    with pytest.raises(ValueError):
        archive.cold.scan("")
    assert archive.cold.scan("crif", year="2026", month="05", day="29").count() == 1
    assert archive.cold.scan("crif", year="2025").count() == 0
    plan = archive.cold.scan("crif", year="2026")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan.replace("\n", " ") or (
        "vendor_id" in plan.split("PartitionFilters")[1].split("]")[0])


def test_views_for_sql(spark, place):
    archive, folder, checkpoint = place
    land(spark, folder, "1", body(), body(latency_ms=900, loan_lifecycle_stage="BANK_BRE"),
         body(vendor_id="crif", request_id=str(uuid.uuid4()), status="FAILURE"))
    run(spark, archive, folder, checkpoint)
    names = register_views(archive)
    assert {"call_events", "call_events_final", "minute_rollup", "mv_crif"} <= set(names)
    text = """SELECT vendor_id, count(*) AS calls,
        round(count_if(status <> 'SUCCESS') * 100.0D / count(*), 2) AS failure_rate
        FROM call_events WHERE vendor_id LIKE :vendor
        AND created_at BETWEEN :from AND :to GROUP BY vendor_id HAVING calls >= 1
        ORDER BY vendor_id"""
    at = {"from": datetime(2026, 5, 1), "to": datetime(2026, 6, 1)}
    rows = spark.sql(text, args={"vendor": "%", **at}).collect()
    assert [tuple(r) for r in rows] == [("crif", 1, 100.0), ("karza", 2, 0.0)]
    assert spark.sql(text, args={"vendor": "k_rza", **at}).count() == 1
    assert spark.table("call_events_final").count() == 2
    assert spark.table("mv_crif").count() == 1
    assert spark.sql("SELECT sum(total) AS n FROM minute_rollup").first().n == 3


def test_stream_dedup_collapses_a_hot_id(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [("hot" if i % 3 else f"r{i}", datetime(2024, 1, 1, 0, i // 60, i % 60), i)
            for i in range(600)]
    frame = spark.createDataFrame(rows, "request_id string, ingested_at timestamp, latency_ms bigint")
    frame.repartition(3).write.parquet(folder)
    before = {key: spark.conf.get(key, None) for key in LARGE_STATE_CONF}
    for spread in (1, 8):
        if spread == 8:
            keep_large_state(spark)
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        dedup_stream(stream, spread=spread).writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / f"cp{spread}")).trigger(
            availableNow=True).start(f"{out}{spread}").awaitTermination()
        kept = [r.request_id for r in spark.read.parquet(f"{out}{spread}").collect()]
        assert len(kept) == len(set(kept)) == 201
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_large_batches_do_not_broadcast_their_keys(spark, place):
    archive, folder, checkpoint = place
    land(spark, folder, "1", body())
    run(spark, archive, folder, checkpoint)
    events = spark.createDataFrame(
        [("k", datetime(2026, 5, 29))], "s3_request_key string, received_at timestamp")
    keys = archive.cold.request_keys(["2026/05/29"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small, large = (
            not_yet_cold(events, keys, n)._jdf.queryExecution().executedPlan().toString()
            for n in (1, MAX_BROADCAST_KEYS + 1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in small and "BroadcastHashJoin" not in large


def test_streams_with_own_checkpoints_do_not_overwrite_each_other(spark, place):
    archive = place[0]
    ids = [str(uuid.uuid4()) for _ in range(3)]
    folders = [fresh_path(spark, "landing") for _ in range(2)]
    for folder, request in zip(folders, ids):
        land(spark, folder, "1", body(request_id=request))
        run(spark, archive, folder, fresh_path(spark, "checkpoint"))
    land(spark, folders[0], "2", body(request_id=ids[2]))
    run(spark, archive, folders[0], fresh_path(spark, "checkpoint"))  # starts at batch 0 again
    assert {r.request_id for r in archive.hot.raw().collect()} == set(ids)
    assert {r.request_id for r in archive.cold.metadata().collect()} == set(ids)
    assert archive.rollup.merged().agg(F.sum("total")).first()[0] == 4
    with pytest.raises(ValueError, match="source"):
        archive.ingest(frame(spark, body()), 0, source="a/b")


def test_newer_versions_are_skipped_before_types_are_judged(spark):
    assert reasons(
        spark, body(schema_version=2, latency_ms="fast"), body(latency_ms="fast")
    ) == ["unsupported_version", "bad_field"]


def test_archived_events_get_their_own_payloads(spark, place):
    archive = place[0]
    archive.ingest(frame(
        spark, body(user_id="u1", request_payload='{"k":1}', latency_ms=3_000_000_000),
        body(user_id="u2", request_payload='{"k":2}')), 0, source="test")
    rows = {r.user_id: r for r in archive.cold.events().collect()}
    assert {u: r.request_payload for u, r in rows.items()} == {"u1": '{"k":1}', "u2": '{"k":2}'}
    assert rows["u1"].latency_ms == 3_000_000_000, "wide numbers do not lose the row"
    assert archive.cold.scan("karza").where("latency_ms IS NULL").count() == 1


def test_tables_set_the_zone_they_depend_on(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        Archive.at(spark, fresh_path(spark, "archive"))
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_small_files_have_small_filters(spark, place):
    archive = place[0]
    archive.ingest(frame(spark, body()), 0, source="test")
    files = archive.hot.raw().select("_metadata.file_size").collect()
    assert all(f.file_size < 200_000 for f in files)


def test_audit_lines_that_do_not_parse_are_kept(spark):
    from callstrata.sources.audit import parse_audit, rejected_audit

    lines = spark.createDataFrame(
        [('{"eventName":"GetObject"}',), ("{ broken",), ("{ broken",)], "value string")
    assert parse_audit(lines).count() == 1
    assert [tuple(r) for r in rejected_audit(lines).collect()] == [("{ broken", 2)]


def test_readers_of_audit_records_count_what_they_leave_out(spark, tmp_path):
    from callstrata.sources.audit import read_audit, stream_audit, stream_audit_rejects

    folder = str(tmp_path / "audit")
    land(spark, folder, "1", '{"eventName":"GetObject"}', "{ broken", '{"eventName":null}')
    land(spark, folder, "2", "{ broken", '{"eventName":"HeadObject"}')
    records, rejects = read_audit(spark, folder)
    assert records.count() == 2
    expected = {("{ broken", 2), ('{"eventName":null}', 1)}
    assert {tuple(r) for r in rejects.collect()} == expected
    found = []
    stream_audit_rejects(spark, folder).writeStream.outputMode("complete").foreachBatch(
        lambda batch, _: found.append({tuple(r) for r in batch.collect()})).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(
        ).awaitTermination()
    assert found[-1] == expected
    assert stream_audit(spark, folder).isStreaming
