"""Time headline queries at $BENCH_SF_DIR and print one JSON line.

The hot table and the rollup are first written to disk, as ingest would leave
them; panels and alerts then read those files. Every query runs to its end.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from callstrata import contract  # noqa: E402
from callstrata.functions.redaction import redact_payload  # noqa: E402
from callstrata.operators.dedup import hot_final  # noqa: E402
from callstrata.operators.lookups import find_event, freshness  # noqa: E402
from callstrata.plans import alerts  # noqa: E402
from callstrata.plans.panels import PANELS, run_panel  # noqa: E402
from callstrata.session import fresh_path, local_session  # noqa: E402
from callstrata.sources.hot import HotTable  # noqa: E402
from callstrata.sources.rollups import RollupTable  # noqa: E402
from callstrata.streaming.ingest import Archive  # noqa: E402
from callstrata.verification.messages import messages  # noqa: E402
from callstrata.verification.sample import call_events, hot_events  # noqa: E402


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "callstrata-bench")
    times: dict[str, float] = {}

    def timed(name, action):
        started = time.perf_counter()
        result = action()
        times[name] = round(time.perf_counter() - started, 3)
        return result

    landed = fresh_path(spark, "bench-messages")
    messages(spark, sf_dir).repartition(8).write.parquet(landed)
    payloads = fresh_path(spark, "bench-payloads")
    call_events(spark, sf_dir).select("request_payload", "response_payload").repartition(
        8).write.parquet(payloads)
    hot = HotTable(spark, fresh_path(spark, "bench-hot"), distinct_per_group=100_000)
    rows = hot_events(spark, sf_dir)
    run(rows.limit(1000))  # start the session's threads before timing

    timed("hot_write", lambda: hot.write(rows, "batch-0"))
    rollup = RollupTable(spark, fresh_path(spark, "bench-rollup"))
    timed("rollup_write", lambda: rollup.add(hot.raw(), "batch-0"))
    archive = Archive.at(spark, fresh_path(spark, "bench-archive"))
    timed("ingest_batch", lambda: archive.ingest(spark.read.parquet(landed), 0, source="bench"))
    timed("redact_payloads", lambda: run(spark.read.parquet(payloads).select(
        redact_payload(F.col("request_payload")).alias("a"),
        redact_payload(F.col("response_payload")).alias("b"))))
    timed("hot_final", lambda: run(hot.final().select(*contract.HOT_COLUMNS)))
    for name, panel in PANELS.items():
        timed(name, lambda: run(run_panel(name, hot.raw())))
        if panel.additive:
            timed(f"{name}_rollup",
                  lambda: run(run_panel(name, rollup.partials(), from_rollup=True)))
    for name in ("fun_vendor_ranking", "fail_rate_by_vendor", "lat_quantiles"):
        timed(f"{name}_final", lambda: run(run_panel(name, hot_final(hot.raw()))))
    for name in alerts.FAILURE_RATE_RULES:
        timed(f"alert_{name}", lambda: run(alerts.alert_failure_rate(hot.raw(), name)))
    timed("alert_p1_latency", lambda: run(alerts.alert_latency(hot.raw())))
    timed("alert_backlog", lambda: run(alerts.alert_backlog(hot.raw())))
    timed("freshness", lambda: run(freshness(hot.raw())))
    timed("find_event", lambda: run(
        find_event(hot.raw(), "00000000-0000-4000-8000-000000000194")))

    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "rows": {"events": hot.raw().count()},
    }))


if __name__ == "__main__":
    main()
