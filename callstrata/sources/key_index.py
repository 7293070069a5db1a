"""Which archive objects exist: sorted runs of keys by day, merged as they grow.

Every batch adds one run per day it touches. Runs of like size are merged once there are
more than `FAN` of them, so a day of any number of batches has few runs, and a key is
rewritten once per tier.

A batch asks for its own keys in two steps. The first reads only the column of key hashes,
8 bytes a key, and keeps the hashes that both sides have. Few batches have any. Only then
whole keys are read, and only where runs, which are sorted by hash, can hold those hashes;
equality of the keys decides, so hashes that collide do no harm.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callstrata import contract
from callstrata.sources.committed import CommittedTable, Conflict, DataFile

FAN = 8
#: Hashes that the second step names in its filter; beyond, it joins.
NAMED_HASHES = 1000
#: A batch of at most this many keys sends its hashes to all tasks: 8 bytes a key.
BROADCAST_HASHES = 2_000_000


def key_hash(key: Column) -> Column:
    return F.xxhash64(key)


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = CommittedTable(
            spark, path, contract.COLD_INDEX_SCHEMA, ("cold_day",), sort_by=("key_hash",),
            ranges=("key_hash",), options={"compression": "zstd"})

    def add(self, keys: DataFrame, write_id: str) -> None:
        """Add s3_request_key and cold_day (`yyyy/MM/dd`) of archived events, then merge
        runs of the days that have grown many."""
        before = self.table.log.version
        self.table.write(keys.select(
            key_hash(F.col("s3_request_key")).alias("key_hash"), "s3_request_key",
            F.lit(write_id).alias("write_id"), "cold_day"), write_id)
        if self.table.log.version > before:
            touched = {f.partition("cold_day") for f in self.table.files(
                lambda file: file.write_id == write_id)}
            self.merge(touched)

    def files(self, days: list[str]) -> list[DataFile]:
        wanted = set(days)
        return self.table.files(lambda file: file.partition("cold_day") in wanted)

    def rows(self, days: list[str]) -> int:
        """How many keys there are on the given days, from the list of files alone."""
        return sum(max(file.rows, 0) for file in self.files(days))

    def keys(self, days: list[str], except_write: str | None = None) -> DataFrame:
        """All keys archived on the given days."""
        rows = self.table.read(self.files(days))
        if except_write is not None:
            rows = rows.where(F.col("write_id") != except_write)
        return rows.select("s3_request_key")

    def known(self, keys: DataFrame, days: list[str], except_write: str | None = None,
              size: int | None = None) -> DataFrame:
        """Those of `keys` (s3_request_key) that are archived on these days by other
        writes. `size` is the number of keys, where it is known."""
        files = self.files(days)
        own = [f for f in files if f.write_id != except_write]
        wanted = keys.select(
            "s3_request_key", key_hash(F.col("s3_request_key")).alias("key_hash")).distinct()
        if not own:
            return wanted.select("s3_request_key").limit(0)
        hashes = wanted.select("key_hash").distinct()
        if size is not None and size <= BROADCAST_HASHES:
            hashes = F.broadcast(hashes)
        met = self.table.read(own).select("key_hash").join(
            hashes, "key_hash", "left_semi").distinct()
        # one row more than is named tells whether all of them were seen
        first = [row.key_hash for row in met.limit(NAMED_HASHES + 1).collect()]
        if not first:
            return wanted.select("s3_request_key").limit(0)
        if len(first) <= NAMED_HASHES:
            near = [f for f in own if any(f.meets("key_hash", h, h) for h in first)]
            found = self.table.read(near).where(F.col("key_hash").isin(first))
        else:
            found = self.table.read(own).join(met, "key_hash", "left_semi")
        if except_write is not None:
            # merged runs hold keys of several writes
            found = found.where(F.col("write_id") != except_write)
        return found.select("s3_request_key").join(
            wanted.select("s3_request_key"), "s3_request_key", "left_semi").distinct()

    def merge(self, days: set[str] | None = None, fan: int = FAN) -> int:
        """Merge runs of like size. Returns the number of files replaced."""
        replaced = 0
        files = self.table.files(lambda f: days is None or f.partition("cold_day") in days)
        for group in self.table.groups(files).values():
            tiers: dict[int, list[DataFile]] = {}
            for file in group:
                tier, bound = 0, 1000
                while file.rows > bound:
                    tier, bound = tier + 1, bound * fan
                tiers.setdefault(tier, []).append(file)
            for runs in tiers.values():
                if len(runs) > fan:
                    try:
                        # a retried batch may have added a key twice
                        self.table.replace(runs, self.table.read(runs).distinct(),
                                           f"merged-{uuid.uuid4().hex}")
                        replaced += len(runs)
                    except Conflict:
                        # another writer merged them, or a batch came again
                        continue
        return replaced
