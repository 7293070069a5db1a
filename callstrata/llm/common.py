"""Small helpers that the operators share."""

from __future__ import annotations

import sys
import threading
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callstrata.session import fresh_path

#: A side of at most this many rows of a few longs may be broadcast (some 30 MB).
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of texts that go to a Python worker, or come back, at once: it holds them several
#: times, and so does the executor. A batch by rows alone would be ten times larger.
BATCH_BYTES = 2 << 20
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Sessions with small batches: how many users, and the setting they had before.
_SMALL: dict[int, tuple[int, str]] = {}
_SMALL_LOCK = threading.Lock()


@contextmanager
def small_batches(spark: SparkSession):
    """Within, Arrow batches have about BATCH_BYTES at most; a lower setting stays. Users
    may overlap: the last one to leave brings back what was set before."""
    key = spark._jsparkSession.hashCode()
    to_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    with _SMALL_LOCK:
        users, before = _SMALL.get(key) or (0, spark.conf.get(_BATCHES))
        _SMALL[key] = users + 1, before
        if not 0 < to_bytes(spark.conf.get(_BATCHES)) <= BATCH_BYTES:
            spark.conf.set(_BATCHES, str(BATCH_BYTES))
    try:
        yield
    finally:
        with _SMALL_LOCK:
            users, before = _SMALL[key]
            if users > 1:
                _SMALL[key] = users - 1, before
            else:
                del _SMALL[key]
                spark.conf.set(_BATCHES, before)


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame, stored in the shared folder and read again: it survives lost
    executors, and values such as row numbers stay as they are."""
    path = fresh_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def checked_broadcast(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if it is small, else as it is, for a shuffle join.

    Pass a stored frame of narrow rows: it is counted first."""
    return F.broadcast(frame) if frame.count() <= rows else frame


def share(spark: SparkSession, value):
    """Broadcasts an object of any class of ours; `opened` gives it to a task. It goes as
    bytes with its class, since workers need not have this package."""
    return spark.sparkContext.broadcast({"pickled": cloudpickle.dumps(value)})


def opened(shared):
    """The shared object: one for all tasks of a worker."""
    state = shared.value
    if "value" not in state:
        state["value"] = cloudpickle.loads(state.pop("pickled"))
    return state["value"]


def crc32_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def unit_hash(*columns: Column) -> Column:
    """A repeatable number in [0, 1) that depends on the columns' values alone."""
    return (F.xxhash64(*columns).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53)))


def bounded_sample(frame: DataFrame, key: Column, limit: int, salt: int = 0,
                   strata: str | None = None) -> DataFrame:
    """About `limit` rows (for each value of `strata`, if named), the same ones each time.

    Rows are taken by a hash of `key`, at the rate limit / rows; so the bound holds
    up to the spread of that draw. For fitting models only."""
    draw = unit_hash(key, F.lit(salt))
    if strata is None:
        n = frame.count()
        return frame.filter(draw < F.lit(min(1.0, limit / max(n, 1))))
    rates = frame.groupBy(strata).agg(
        F.least(F.lit(1.0), F.lit(float(limit)) / F.count(F.lit(1))).alias("_rate"))
    return (frame.join(F.broadcast(rates), strata).filter(draw < F.col("_rate"))
            .drop("_rate"))


def unused(columns: list[str], name: str) -> str:
    """The name, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
