"""Audit records of reads and writes in the archive's object store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callstrata.contract import AUDIT_SCHEMA


def parse_audit(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON audit records to columns; what does not parse is left to `rejected_audit`."""
    record = F.from_json(column, AUDIT_SCHEMA, {"mode": "PERMISSIVE"})
    return (
        lines.select(record.alias("r"))
        .where("r.eventName IS NOT NULL")
        .select(
            F.try_to_timestamp("r.eventTime").alias("event_time"),
            F.col("r.eventName").alias("event_name"),
            F.col("r.requestParameters.bucketName").alias("bucket"),
            F.col("r.requestParameters.key").alias("object_key"),
            F.col("r.requestParameters.LegalHold.Status").alias("hold_status"),
            F.col("r.userIdentity.userName").alias("user_name"),
        )
    )


def rejected_audit(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines that `parse_audit` leaves out, with the number of times they occur."""
    record = F.from_json(column, AUDIT_SCHEMA, {"mode": "PERMISSIVE"})
    return (
        lines.where(record["eventName"].isNull())
        .groupBy(F.col(column).alias("line")).agg(F.count("*").alias("records"))
    )


def read_audit(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Audit records below a path, and the lines that are none with their numbers."""
    lines = spark.read.text(path)
    return parse_audit(lines), rejected_audit(lines)


def stream_audit(spark: SparkSession, path: str) -> DataFrame:
    """Audit records of newly landed files. `stream_audit_rejects` has the other lines."""
    return parse_audit(spark.readStream.text(path))


def stream_audit_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Lines of newly landed files that are no audit records, with their numbers so far;
    for update or complete mode."""
    return rejected_audit(spark.readStream.text(path))
