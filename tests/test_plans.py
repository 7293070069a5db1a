"""Shapes of the plans: no pairing of all rows, narrow scans, bounded broadcasts."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entrypoint  # noqa: E402
from callstrata.plans.panels import PANELS, run_panel  # noqa: E402
from callstrata.verification.sample import hot_events  # noqa: E402

QUERIES = entrypoint.queries()
# Plans are looked at for queries that do not write files first.
READERS = sorted(
    name for name in QUERIES
    if name.startswith(("ops_", "fun_", "lat_", "fail_", "alert_", "p1_", "backlog", "find_by",
                        "latest", "fresh", "held", "hot_final", "rollup_1m", "cold_hot_recon"))
    and "stream" not in name
)
# The side broadcast is a top 100.
MAY_BROADCAST = ("ops_dup_deliveries",)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_automatic_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", READERS)
def test_no_pairing_and_no_unbounded_broadcast(spark, sf_dir, no_automatic_broadcast, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if not name.startswith(MAY_BROADCAST):
        assert "BroadcastHashJoin" not in plan


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    hot_events(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


PAYLOAD_PANELS = {"ops_possible_pii", "ops_watchlist"}


@pytest.mark.parametrize("name", sorted(PANELS))
def test_panels_read_payloads_only_where_they_show_them(stored, name):
    schema = plan_of(run_panel(name, stored, start="2024-01-01", end="2024-01-02")).split(
        "ReadSchema: ")[1]
    assert ("request_payload" in schema) == (name in PAYLOAD_PANELS)


@pytest.mark.parametrize("name", sorted(PANELS))
def test_panel_filters_reach_the_scan(stored, name):
    plan = plan_of(run_panel(name, stored, vendor="k%", start="2024-01-01", end="2024-01-02"))
    pushed = plan.split("PushedFilters: [")[1]
    assert "StringStartsWith(vendor_id,k)" in pushed
    time_column = "ingested_at" if name == "ops_insert_rate" else "created_at"
    assert f"GreaterThanOrEqual({time_column}" in pushed


def test_top_lists_keep_a_bounded_heap_per_task(stored):
    for name in ("fun_recent_failed", "fail_recent", "ops_watchlist"):
        assert "TakeOrderedAndProject" in plan_of(run_panel(name, stored))


def test_quantiles_aggregate_before_the_shuffle(stored):
    plan = plan_of(run_panel("lat_p95_by_vendor", stored))
    last = plan.rindex("partial_count(1)")
    assert "Exchange" not in plan[last:], "the first shuffle carries counts, not rows"


def test_library_never_uses_local_checkpoints_or_collects_tables():
    for path in (ROOT / "callstrata").rglob("*.py"):
        text = path.read_text()
        assert "localCheckpoint" not in text and ".toPandas(" not in text, path
        assert ".crossJoin(" not in text, path


def test_rollup_refuses_what_it_cannot_answer(spark, sf_dir):
    rollup = QUERIES["rollup_1m"](spark, sf_dir)
    with pytest.raises(ValueError):
        run_panel("lat_p95", rollup, from_rollup=True)
    with pytest.raises(ValueError):
        run_panel("ops_events", rollup, from_rollup=True, environment="prod")
    with pytest.raises(ValueError):
        run_panel("fail_rate", rollup, from_rollup=True, stage="KYC")


def test_panel_modes(stored):
    exact = run_panel("lat_p95", stored).first().p95_ms
    approximate = run_panel("lat_p95", stored, mode="approx").first().p95_ms
    assert approximate == pytest.approx(exact, rel=0.05)
    with pytest.raises(ValueError):
        run_panel("lat_p95", stored, mode="guess")
    empty = run_panel("fail_rate", stored.where(F.lit(False)))
    assert empty.first().failure_rate == 0.0


def test_backlog_reads_the_events_once(spark, tmp_path):
    from callstrata.plans.alerts import alert_backlog

    rows = spark.range(500).selectExpr(
        "timestamp_seconds(1704067200 + id * 37) AS created_at",
        "timestamp_seconds(1704067200 + id * 37 + (id % 7) * 50) AS ingested_at")
    rows.write.parquet(str(tmp_path / "events"))
    alerts = alert_backlog(spark.read.parquet(str(tmp_path / "events")), depth=3)
    alerts.collect()
    plan = alerts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1
    # minutes, days, and the runs of each rule; one row per day goes to one task
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 4
    assert plan.count("Exchange SinglePartition") == 1
