"""From raw documents to token ids, in five stages.

Every stage takes (spark, docs, sf_dir) and returns all rows that stay; all but the last
with the columns of documents. `run` stores each stage's rows in the shared folder and
reads them again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callstrata.llm import digest_index, group_prefix_join, language_id, piece_codec, winnowing
from callstrata.llm.common import table, written


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier knows. Those without a letter, and
    those it is not sure of (less than even odds), go."""
    return language_id.accepted(docs)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return digest_index.without_duplicates(docs)


def distinct_contents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the one with the smallest doc_id."""
    return group_prefix_join.one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    return winnowing.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids instead of the text, and whether they decode to it."""
    codec = piece_codec.PieceCodec.from_model(public_tokenizers.path("piece_bpe_32k.model"))
    return piece_codec.encode(docs, codec, check=True).withColumn(
        "n_ids", F.coalesce(F.size("ids"), F.lit(0)))


STAGES = [
    ("language_id", recognised),
    ("exact_dedup", distinct_texts),
    ("near_dedup", distinct_contents),
    ("decontamination", uncontaminated),
    ("piece_encoding", encoded),
]

#: The classifier and the encoder have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return written(STAGES[-1][1](spark, docs, sf_dir), f"pipeline-{STAGES[-1][0]}")
