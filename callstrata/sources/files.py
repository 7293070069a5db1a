"""Idempotent partitioned writes, and removal of whole partitions."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from callstrata.session import fresh_path

#: A task that stores rows keeps about as many bytes of them.
STAGED_GROUP_BYTES = 32 << 20


def together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run independent writes at the same time, so that their small stages overlap.

    All have ended when this returns; the first error is raised then.
    """
    if len(writes) == 1:
        return writes[0]()
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for one in running:
        one.result()


def write_partitions(rows: DataFrame, path: str, partition_by: Sequence[str], *,
                     sort_by: Sequence[str] = (), file_format: str = "parquet",
                     options: dict[str, str] | None = None, rebalance: bool = True) -> None:
    """Write rows, replacing the partitions they fall into and no others.

    Writing the same rows again gives the same table, so a repeated batch is
    safe. Rebalancing by partition makes few files per partition, and adaptive
    execution splits a partition that is much larger than the rest. The sort
    starts with the partition columns, as the writer needs it, and then puts
    rows in order so that row groups have narrow ranges. Where each task has
    many rows of few partitions, `rebalance` can be left out.
    """
    if rebalance:
        rows = rows.hint("rebalance", *[F.col(name) for name in partition_by])
    (
        rows.sortWithinPartitions(*partition_by, *sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**(options or {}))
        .partitionBy(*partition_by)
        .format(file_format)
        .save(path)
    )


@contextmanager
def staged(rows: DataFrame, name: str) -> Iterator[DataFrame]:
    """Rows that several jobs read, computed once and stored below the shared folder for the
    time of the block. A cache would hold them on the heap, many times larger and with all
    columns, next to the tasks that read them."""
    spark = rows.sparkSession
    path = fresh_path(spark, name)
    try:
        rows.write.options(**{
            "compression": "zstd", "parquet.block.size": str(STAGED_GROUP_BYTES)}).parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        drop_folder(spark, path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _file_system(spark, path)
    return file_system.exists(hadoop_path)


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a glob: partition names, never rows."""
    file_system, hadoop_path = _file_system(spark, pattern)
    found = file_system.globStatus(hadoop_path) or []
    return sorted(str(status.getPath()) for status in found if status.isDirectory())


def drop_folder(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _file_system(spark, path)
    file_system.delete(hadoop_path, True)


def partition_value(folder: str, name: str) -> str:
    for part in folder.split("/"):
        if part.startswith(f"{name}="):
            return part[len(name) + 1:]
    raise ValueError(f"no partition {name} in {folder}")


def list_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Data files below a folder, relative to it, with their sizes in bytes."""
    file_system, hadoop_path = _file_system(spark, folder)
    if not file_system.exists(hadoop_path):
        return []
    root = file_system.makeQualified(hadoop_path).toString().rstrip("/") + "/"
    found, walk = [], file_system.listFiles(hadoop_path, True)
    while walk.hasNext():
        status = walk.next()
        path = status.getPath().toString()[len(root):]
        if not any(part.startswith(("_", ".")) for part in path.split("/")):
            found.append((path, status.getLen()))
    return sorted(found)


def move_files(spark: SparkSession, moves: Sequence[tuple[str, str]]) -> None:
    """Rename files; folders are made as needed."""
    if not moves:
        return
    file_system, _ = _file_system(spark, moves[0][1])
    path = spark._jvm.org.apache.hadoop.fs.Path
    for folder in {target.rsplit("/", 1)[0] for _, target in moves}:
        file_system.mkdirs(path(folder))
    for source, target in moves:
        if not file_system.rename(path(source), path(target)):
            raise OSError(f"could not rename {source} to {target}")


def drop_files(spark: SparkSession, paths: Sequence[str]) -> None:
    for path in paths:
        file_system, hadoop_path = _file_system(spark, path)
        file_system.delete(hadoop_path, False)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Text of a small file; None where there is none."""
    file_system, hadoop_path = _file_system(spark, path)
    if not file_system.exists(hadoop_path):
        return None
    stream = file_system.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, *, replace: bool = False) -> bool:
    """Write a small file as a whole: readers see all of it or nothing. False if it
    exists and must not be replaced."""
    file_system, hadoop_path = _file_system(spark, path)
    jvm = spark._jvm
    folder, name = path.rsplit("/", 1)
    draft = jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = file_system.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE if replace else rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        file_system.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, hadoop_path, how)
    except Py4JJavaError as error:
        file_system.delete(draft, False)
        if "FileAlreadyExistsException" in str(error.java_exception.getClass()):
            return False
        raise
    return True
