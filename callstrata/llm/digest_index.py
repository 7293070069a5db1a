"""Exact dedup against a persistent index of text digests.

The index is a table bucketed and sorted by digest. A batch is reduced to one row
per digest, the digests that the index lacks are found by a sort-merge anti-join
on the buckets, and these are appended with the batch's number. The batch's rows then
learn from the index which row stays.

A batch that failed may run again under its number, with its rows in any order and any
number of tasks: digests that its first try appended are there, bear its number, and so
count as its own. Which of several equal rows stays is chosen anew within the try.

Defined results: a NULL text counts as empty. Of equal texts the row with the
largest doc_id stays (NULL ids count as smallest; of rows equal in id and text one
stays). An empty batch gives no rows and leaves the index as it is. Other columns are
not read. A text of any length is one digest.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callstrata.llm.common import checked_broadcast, unused, written
from callstrata.session import fresh_path
from callstrata.sources.files import read_text, write_text

DEFAULT_BUCKETS = 64


def digest(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class DigestIndex:
    """Digests seen so far, with the row that stays for each."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = DEFAULT_BUCKETS):
        """Opens the index at `path`, or starts one. An existing index must be
        opened with the number of buckets it was made with, which is kept beside it."""
        self.spark, self.path, self.buckets = spark, path, buckets
        if not write_text(spark, f"{path}/_buckets", str(buckets)):
            made_with = int(read_text(spark, f"{path}/_buckets"))
            if made_with != buckets:
                raise ValueError(f"the index at {path} has {made_with} buckets, not {buckets}")
        self.name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} "
            "(digest BINARY, keep_id BIGINT, batch BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
            f"LOCATION '{path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def files(self) -> DataFrame:
        """The same rows read without bucket information, so that a join with a
        very frequent digest can be split."""
        return self.spark.read.schema(self.rows().schema).parquet(self.path)

    def append(self, fresh: DataFrame) -> None:
        (fresh.select("digest", "keep_id", "batch")
         .repartition(self.buckets, "digest")
         .write.insertInto(self.name))
        self.spark.catalog.refreshTable(self.name)

    def deduplicate(self, docs: DataFrame, batch: int) -> DataFrame:
        """One row per row of `docs` (doc_id, text): keep_id, group_size in this
        batch, kept, and `known`: an earlier batch has the text, so none of these stay.

        `batch` numbers the calls on one index: give each batch its own, and the same
        one to a batch that runs again."""
        rows = written(
            docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        digest(F.col("text")).alias("digest"))
            .withColumn("row", F.monotonically_increasing_id()),
            "digests")
        groups = written(
            rows.groupBy("digest").agg(
                F.max(F.struct("doc_id", "row")).alias("keep"),
                F.count(F.lit(1)).alias("group_size"))
            .select("digest", F.col("keep.doc_id").alias("keep_id"),
                    F.col("keep.row").alias("keep_row"), "group_size",
                    F.lit(batch).cast("long").alias("batch")),
            "digest-groups")
        fresh = groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        self.append(written(fresh, "digest-fresh"))
        kept = self.files().join(groups.select("digest", "group_size", "keep_row"), "digest")
        return (rows.hint("merge").join(kept, "digest")
                .withColumn("known", F.col("batch") != F.lit(batch))
                .withColumn("kept", ~F.col("known") & (F.col("row") == F.col("keep_row")))
                .select("doc_id", "keep_id", "group_size", "kept", "known",
                        F.lower(F.hex("digest")).alias("text_sha256")))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """The report of `DigestIndex.deduplicate` for a table on its own."""
    spark = docs.sparkSession
    return DigestIndex(spark, fresh_path(spark, "digest-index")).deduplicate(docs, 0)


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns.

    Only rows of groups are looked up; a text that occurs once is not shuffled
    when the list of groups is small."""
    id_, digest_ = unused(docs.columns, "_id"), unused(docs.columns, "_digest")
    report = written(
        exact_duplicates(docs).filter("group_size > 1")
        .select(F.col("doc_id").alias(id_), "kept",
                F.unhex("text_sha256").alias(digest_)).distinct(), "digest-report")
    keyed = docs.withColumns({digest_: digest(F.col("text")),
                              id_: F.col("doc_id").cast("long")})
    on = (keyed[digest_] == report[digest_]) & keyed[id_].eqNullSafe(report[id_])
    single = keyed.join(checked_broadcast(report), on, "left_anti")
    stay = report.filter("kept")
    chosen = keyed.join(
        checked_broadcast(stay),
        (keyed[digest_] == stay[digest_]) & keyed[id_].eqNullSafe(stay[id_]),
        "left_semi").dropDuplicates([id_, digest_])
    return single.drop(digest_, id_).unionByName(chosen.drop(digest_, id_))
