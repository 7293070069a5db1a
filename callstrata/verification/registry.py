"""Collects queries and their SQL twins under the query's function name."""

from __future__ import annotations


class Registry:
    def __init__(self):
        self.queries = {}
        self.sql = {}

    def query(self, sql: str | None = None, name: str | None = None):
        """Register a query; without `sql` it has no SQL form."""

        def wrap(build):
            key = name or build.__name__
            if key in self.queries:
                raise ValueError(f"registered twice: {key}")
            self.queries[key] = build
            if sql is not None:
                self.sql[key] = sql
            return build

        return wrap
