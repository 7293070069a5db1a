"""One row per request: on read, in batch compaction, and before cold writes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window, functions as F

from callstrata.functions.scalars import hot_month

# Which copy wins: the last one ingested. One batch shares one ingest time, so
# the batch and the delivery break ties, where the frame has them.
TIE_BREAKERS = ("ingested_at", "batch_id", "delivery")


def latest_copy(rows: DataFrame, keys, order) -> DataFrame:
    """The first row per key in the given order.

    Spark turns `rank = 1` into a limit per group before the shuffle, so a key
    with very many copies sends one row per map task, not all of them.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def hot_final(hot: DataFrame) -> DataFrame:
    """The hot table after deduplication: per month, one row per request_id.

    Columns that the reader does not ask for are pruned below the shuffle.
    """
    order = [F.desc(name) for name in TIE_BREAKERS if name in hot.columns]
    month = F.col("ist_month") if "ist_month" in hot.columns else hot_month(F.col("created_at"))
    return latest_copy(
        hot.withColumn("_month", month), ["_month", "request_id"], order).drop("_month")


def duplicate_ids(hot: DataFrame) -> DataFrame:
    return hot.groupBy("request_id").agg(F.count("*").alias("copies")).where("copies > 1")


def one_per_batch(messages: DataFrame) -> DataFrame:
    """First delivery per archive object within a batch, for the cold write."""
    order = [F.asc(name) for name in ("received_at", "delivery") if name in messages.columns]
    return latest_copy(messages, ["s3_request_key"], order)


# A key takes about 150 bytes, so this many stay far below an executor's memory.
MAX_BROADCAST_KEYS = 500_000


def not_yet_cold(messages: DataFrame, cold_keys: DataFrame,
                 message_count: int | None = None) -> DataFrame:
    """Messages whose request object is not in the archive yet.

    `cold_keys` should hold only the days the messages touch, and is usually far
    larger than a batch. When the batch is known to be small its keys are
    broadcast and the archive's keys are only streamed past them. Otherwise both
    sides are shuffled on the key, whatever Spark takes their size to be: keys are a
    tenth as large in a file as they are in memory.
    """
    wanted = messages.select("s3_request_key").distinct()
    few = message_count is not None and message_count <= MAX_BROADCAST_KEYS
    wanted = F.broadcast(wanted) if few else wanted.hint("merge")
    found = cold_keys.select("s3_request_key").join(wanted, "s3_request_key", "left_semi")
    if not few:
        found = found.hint("merge")
    return one_per_batch(messages).join(found, "s3_request_key", "left_anti")


@contextmanager
def new_objects(messages: DataFrame, cold_keys: DataFrame,
                message_count: int | None = None) -> Iterator[DataFrame]:
    """The same rows as `not_yet_cold`, of messages that are cached or stored, for writes
    within the block.

    Most objects come once and are new. Hashes of keys tell which ones may not be: those
    are counted, and if they are few they are sent to all tasks, so that only their rows
    are dealt out by key. All others stay in the tasks that hold them. Keys with equal
    hashes are compared whole, so hashes that collide do no harm.
    """
    key_hash = F.xxhash64("s3_request_key").alias("_hash")
    # on disk: a batch that comes again has as many known keys as rows
    known = cold_keys.select("s3_request_key").persist(StorageLevel.DISK_ONLY)
    repeated = messages.groupBy(key_hash).count().where("count > 1").select("_hash")
    special = repeated.unionByName(known.select(key_hash)).distinct().persist(
        StorageLevel.DISK_ONLY)
    try:
        if special.count() > MAX_BROADCAST_KEYS:
            yield not_yet_cold(messages, known, message_count)
            return
        marked = messages.withColumn("_hash", F.xxhash64("s3_request_key"))
        alone, rest = (
            marked.join(F.broadcast(special), "_hash", how).drop("_hash")
            for how in ("left_anti", "left_semi"))
        yield alone.unionByName(not_yet_cold(rest, known))
    finally:
        special.unpersist()
        known.unpersist()
