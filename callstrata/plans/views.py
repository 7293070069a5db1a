"""SQL names for the tables of an archive, for ad-hoc queries with spark.sql."""

from __future__ import annotations

from callstrata.operators.rollup import vendor_view, vendor_view_names
from callstrata.streaming.ingest import Archive


def register_views(archive: Archive) -> list[str]:
    """Make temporary views; they are plans, not copies, and read when queried.

    `call_events` holds every delivery, `call_events_final` one row per request.
    A view knows the files of its moment: register again to see later writes.
    """
    hot = archive.hot.raw()
    frames = {
        "call_events": hot,
        "call_events_final": archive.hot.final(),
        "minute_rollup": archive.rollup.merged(),
        "cold_metadata": archive.cold.metadata(),
        "quarantine": archive.quarantine.rows(),
        **{name: vendor_view(hot, vendor) for name, vendor in vendor_view_names().items()},
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return sorted(frames)
