"""Session defaults and the shared folder for tables that cut lineage."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Results depend on these: days and minutes are cut in UTC.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Defaults for sessions we create ourselves. A cluster brings its own.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

# State of long horizons belongs on disk, not on the heap: deduplication over
# eighteen days keeps every id of that time. Set before a stream first starts.
LARGE_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Messages and their rows are many times larger in memory than as files or shuffled, so
# tasks that take the usual number of bytes would sort and keep gigabytes, and spill.
BOUNDED_BYTES = {
    "spark.sql.files.maxPartitionBytes": 8 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 << 20,
}
#: Wide rows that a task of a shuffle may have before others share them.
BOUNDED_ROWS = 50_000

# Temporary folders of local sessions without a shared folder, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def local_session(cores: str = "8", app_name: str = "callstrata") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cores) if cores.isdigit() else "8")
        .config("spark.driver.memory", os.environ.get("CALLSTRATA_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**LOCAL_CONF, **REQUIRED_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results depend on, leave everything else as it is."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def keep_large_state(spark: SparkSession) -> SparkSession:
    """Keep the state of streams started from now on in RocksDB."""
    for key, value in LARGE_STATE_CONF.items():
        spark.conf.set(key, value)
    return spark


# Sessions with bounded tasks: how many users, and the settings they had before.
_BOUNDED: dict[int, tuple[int, dict[str, str | None]]] = {}
_BOUNDED_LOCK = threading.Lock()


@contextmanager
def bounded_tasks(spark: SparkSession, rows: int | None = None):
    """Within, tasks take few bytes of files and of shuffles, and shuffles of `rows` wide
    rows start with enough partitions; settings that are lower already stay. Users may
    nest or overlap: the last one to leave brings back what was set before."""
    key = spark._jsparkSession.hashCode()
    to_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with _BOUNDED_LOCK:
        users, before = _BOUNDED.get(key) or (0, {
            name: spark.conf.get(name, None) for name in (*BOUNDED_BYTES, initial)})
        _BOUNDED[key] = users + 1, before
        for name, size in BOUNDED_BYTES.items():
            if spark.conf.get(name, None) is None or to_bytes(spark.conf.get(name)) > size:
                spark.conf.set(name, str(size))
        parts = int(spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions"))
        if rows is not None and rows > parts * BOUNDED_ROWS:
            spark.conf.set(initial, str(-(-rows // BOUNDED_ROWS)))
    try:
        yield
    finally:
        with _BOUNDED_LOCK:
            users, before = _BOUNDED[key]
            if users > 1:
                _BOUNDED[key] = users - 1, before
            else:
                del _BOUNDED[key]
                for name, value in before.items():
                    spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by spark.checkpoint.dir.

    Where it is unset (tests on one machine) a temporary folder is made. On a
    cluster an unset folder is an error: a machine-local path would be lost
    with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="callstrata-")
    return _LOCAL_FOLDERS[application]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never one that exists."""
    return f"{shared_folder(spark).rstrip('/')}/callstrata/{name}-{uuid.uuid4().hex}"
