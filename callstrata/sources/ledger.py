"""Which replay runs are under way, so that one that died is taken up again."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from callstrata.sources.files import drop_files, read_text, write_text


class Ledger:
    """One open run per kind. A run is claimed with what it works on, then written, then
    done. Every step may run again: writes are named after the run and replace themselves.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _open_path(self, kind: str) -> str:
        return f"{self.path}/open-{kind}.json"

    def under_way(self, kind: str) -> dict | None:
        text = read_text(self.spark, self._open_path(kind))
        return None if text is None else json.loads(text)

    def claim(self, kind: str, **work) -> dict:
        """Open a run; if another process was first, its run is the one to take up."""
        run = {"run": uuid.uuid4().hex, "kind": kind, "state": "claimed", **work}
        if not write_text(self.spark, self._open_path(kind), json.dumps(run)):
            return self.under_way(kind) or self.claim(kind, **work)
        return run

    def advance(self, run: dict, state: str, **result) -> None:
        run.update(state=state, **result)
        write_text(self.spark, self._open_path(run["kind"]), json.dumps(run), replace=True)

    def finish(self, run: dict) -> None:
        """Keep the run's entry under its own name, and make room for the next."""
        run["state"] = "done"
        write_text(self.spark, f"{self.path}/done/{run['kind']}-{run['run']}.json",
                   json.dumps(run), replace=True)
        drop_files(self.spark, [self._open_path(run["kind"])])
