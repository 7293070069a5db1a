"""Alerts of a stream that hold for a time: state and timers per vendor.

Events are first counted per minute, vendor and latency by Spark's own window aggregate,
which combines before the shuffle; a minute's counts leave it once the watermark has
passed. The state of a vendor then holds the minutes of its open windows and since when
each rule has been true. A timer for the end of every window judges it in order, so a run
goes on through micro-batches, however files came, and ends with the first window that is
false or has no calls.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from callstrata.contract import VENDOR_TIERS
from callstrata.plans import alerts

MINUTE_MS = 60_000
_OUTPUT = ("vendor_id string, rule string, window_end timestamp, value double, "
           "active_since timestamp, firing boolean")
_COLUMNS = [field.split()[0] for field in _OUTPUT.split(", ")]

#: By tier: rule, the value it looks at, and the rule's numbers.
WATCHED = {
    "P1": [("p1_rate_high", "rate", alerts.FAILURE_RATE_RULES["p1_rate_high"]),
           ("p1_rate_critical", "rate", alerts.FAILURE_RATE_RULES["p1_rate_critical"]),
           ("p1_all_failing", "none_ok", alerts.P1_ALL_FAILING),
           ("p1_latency", "p95", alerts.P1_LATENCY),
           ("p1_timeouts", "timeouts", alerts.P1_TIMEOUTS)],
    "P2": [("p2_rate_high", "rate", alerts.FAILURE_RATE_RULES["p2_rate_high"])],
}


def _percentile(counts: dict[int, int], q: float) -> float:
    """Interpolated quantile of values with their counts."""
    total = sum(counts.values())
    place = q * (total - 1)
    low, share = int(place), place - int(place)
    found, seen = [], 0
    for value in sorted(counts):
        seen += counts[value]
        while len(found) < 2 and seen > low + len(found):
            found.append(value)
    last = found[1] if len(found) > 1 else found[0]
    return round(found[0] * (1 - share) + last * share, 6)


def judged(window: list[dict], minutes: int, kind: str, threshold: float) -> tuple[float, bool]:
    """Value of a rule over the minutes of a window, and whether it is true."""
    calls, successes, failures, timeouts = (
        sum(minute["counts"][place] for minute in window) for place in range(4))
    if kind == "none_ok":
        return float(calls), successes == 0
    if kind == "rate":
        value = failures * 100.0 / calls
    elif kind == "timeouts":
        value = timeouts / (minutes * 60)
    else:
        latencies: dict[int, int] = {}
        for minute in window:
            for value, n in minute["latencies"].items():
                latencies[int(value)] = latencies.get(int(value), 0) + n
        value = _percentile(latencies, 0.95)
    return value, value > threshold


class HeldAlerts(StatefulProcessor):
    """Rules as plain tuples: name, kind, window in minutes, threshold, hold in minutes."""

    def __init__(self, rules_of_vendor: dict[str, list[tuple]]):
        self.rules_of_vendor = rules_of_vendor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("vendor", "json string")

    def _load(self) -> dict:
        held = self.state.get() if self.state.exists() else None
        return json.loads(held[0]) if held else {"minutes": {}, "since": {}}

    def _rules(self, key) -> list[tuple]:
        return self.rules_of_vendor.get(key[0], [])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                        ) -> Iterator[pd.DataFrame]:
        state = self._load()
        size = max(rule[2] for rule in self._rules(key))
        ends = set()
        for frame in rows:
            for row in frame.itertuples(index=False):
                at = str(row.minute_ms)
                minute = state["minutes"].setdefault(
                    at, {"counts": [0, 0, 0, 0], "latencies": {}})
                for place, name in enumerate(("calls", "successes", "failures", "timeouts")):
                    minute["counts"][place] += int(getattr(row, name))
                latency = str(row.latency_ms)
                minute["latencies"][latency] = minute["latencies"].get(latency, 0) + int(row.calls)
                ends.update(row.minute_ms + n * MINUTE_MS for n in range(1, size + 1))
        for end in ends:
            self.handle.registerTimer(int(end))
        self.state.update((json.dumps(state),))
        yield pd.DataFrame(columns=_COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = int(expiredTimerInfo.getExpiryTimeInMs())
        state = self._load()
        found, oldest = [], end
        for name, kind, size, threshold, hold in self._rules(key):
            oldest = min(oldest, end - size * MINUTE_MS)
            window = [state["minutes"][str(at)]
                      for at in range(end - size * MINUTE_MS, end, MINUTE_MS)
                      if str(at) in state["minutes"]]
            value, true = judged(window, size, kind, threshold) if window else (0.0, False)
            # a run goes on only from the window one minute before
            since, last = state["since"].get(name, (None, None))
            if not true:
                state["since"].pop(name, None)
                continue
            if last != end - MINUTE_MS:
                since = end
            state["since"][name] = (since, end)
            found.append((key[0], name, pd.Timestamp(end, unit="ms"), value,
                          pd.Timestamp(since, unit="ms"), end - since >= hold * MINUTE_MS))
        # minutes that no later window holds
        for at in [at for at in state["minutes"] if int(at) <= oldest]:
            del state["minutes"][at]
        if state["minutes"] or state["since"]:
            self.state.update((json.dumps(state),))
        else:
            self.state.clear()
        yield pd.DataFrame(found, columns=_COLUMNS)

    def close(self) -> None:
        pass


def rules_by_vendor() -> dict[str, list[tuple]]:
    return {vendor: [(name, kind, rule.window_minutes, rule.threshold, rule.hold_minutes)
                     for name, kind, rule in WATCHED[tier]]
            for vendor, tier in VENDOR_TIERS if tier in WATCHED}


def held_alert_stream(events: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """A stream of vendor_id, rule, window_end, value, active_since, firing: every window
    in which a rule is true, once the watermark has passed its end. Append mode; needs the
    RocksDB state store (`session.keep_large_state`)."""
    rules = rules_by_vendor()
    counts = alerts.outcome_counts()
    minutes = (
        events.where(F.col("vendor_id").isin(sorted(rules)))
        .withWatermark("created_at", lateness)
        .groupBy(F.window("created_at", "1 minute").alias("w"), "vendor_id", "latency_ms")
        .agg(*[column.alias(name) for name, column in counts.items()])
        .select("vendor_id", F.unix_millis("w.start").alias("minute_ms"), "latency_ms", *counts)
    )
    return minutes.groupBy("vendor_id").transformWithStateInPandas(
        statefulProcessor=HeldAlerts(rules), outputStructType=_OUTPUT, outputMode="Append",
        timeMode="EventTime")


# Ship this module with the processor, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
