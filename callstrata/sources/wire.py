"""Message bodies as they land: JSON lines, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def with_receipt(bodies: DataFrame, received_at=None) -> DataFrame:
    """Adds the ingest time: one for the whole batch, as of the query start."""
    at = F.current_timestamp() if received_at is None else received_at
    return bodies.withColumn("received_at", at)


def read_messages(spark: SparkSession, path: str, received_at=None) -> DataFrame:
    return with_receipt(spark.read.text(path).withColumnRenamed("value", "body"), received_at)


def stream_messages(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Bodies of newly landed files. `max_files` bounds a micro-batch."""
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files)
        .text(path)
        .withColumnRenamed("value", "body")
    )


def kafka_messages(spark: SparkSession, servers: str, topic: str,
                   max_offsets: int = 1_000_000) -> DataFrame:
    """The same from a Kafka topic, where its connector is on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
        .select(F.col("value").cast("string").alias("body"))
    )
