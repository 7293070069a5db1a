"""Ranked lexical search of a set of queries (items) over all documents, by bag deduplication.

For a ranking, a document is the counts of the items' terms in it and its length norm m.
Documents for which these are equal form one class and have equal scores:

1. One pass over whole texts counts terms, restricted to the vocabulary of the items. It
   keeps, for each document, its number of terms and the vector (term numbers, counts).
2. Number and total length of documents, and document frequencies, come from that table.
3. Vectors are grouped by a hash, and by m and the vector itself, which verifies that the
   members are equal. A class knows its smallest doc_id.
4. Each class is scored once against all items: every task adds up, for a batch of
   classes, the products of class terms and the items that hold them, and keeps the
   `top` best classes of each item, by score, then smallest doc_id.
5. The best classes of each item over all tasks are expanded to their members by ascending
   doc_id, `top` of each class at most, and the first `top` rows stay. No other class can
   hold one of them: each class before it has a row before its first.

Nothing is paired but classes with items that share a term, in numpy, and only `top` rows
per item leave a task. Items are worked through in blocks of about `BLOCK` distinct
(item, term) pairs, so what tasks hold of them is bounded at any number of items.

Defined results: a NULL or empty text has no terms and counts nowhere. Terms are runs of
letters a-z, digits and characters beyond ASCII; only A-Z are lower-cased. Every row of
documents is a document of its own, repeated ids too; of equal scores, rows without doc_id
come last. Every row of items is an item of its own; one without terms, or without a
document of a score above 0, has no rows. Empty tables give no rows. Other columns are not
read. A text is held whole by its task, with its counts.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callstrata.llm.common import written

TOP = 20
#: Distinct (item, term) pairs worked on at once: some 100 MB in each task.
BLOCK = 1_000_000
#: A side of at most this many bytes is broadcast.
BROADCAST_BYTES = 16 << 20
#: Cells of (class, item) scores, and products, that a task adds up at once.
CELLS = 1 << 20

# Runs of bytes of letters, digits and of characters beyond ASCII.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
# Fixed values of the score: thousandths, k1 = 1.2, b = 0.25.
_SCALE, _K, _LEAST, _SLOPE = 1000, 12, 75, 25

_RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"


def terms_of(text: str | None) -> list[bytes]:
    return _TERM.findall((text or "").encode("utf-8", "surrogatepass").lower())


def _small(frame: DataFrame, row_bytes) -> DataFrame:
    """Marked for broadcast if its rows take few bytes (a stored frame: it is scanned)."""
    total = frame.agg(F.sum(row_bytes).alias("n")).first()["n"] or 0
    return F.broadcast(frame) if total <= BROADCAST_BYTES else frame


class _Block:
    """Terms of some items: numbers of the terms, and for each the items that hold it.
    Only its plain arrays go to tasks."""

    def __init__(self, texts: list[str | None]):
        self.counts = [Counter(terms_of(t)) for t in texts]
        self.vocabulary = {t: i for i, t in enumerate(sorted(set().union(*self.counts)))}
        held = sorted((self.vocabulary[t], item, n)
                      for item, found in enumerate(self.counts) for t, n in found.items())
        self.terms, self.items, self.times = (
            np.array(x, np.int64) for x in (zip(*held) if held else ((), (), ())))
        self.first = np.searchsorted(self.terms, np.arange(len(self.vocabulary) + 1))


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """row, doc_id, n (terms of the whole text) and, in order of terms, `terms` and `tfs`
    (NULL where the text holds none of the vocabulary)."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        numbers = known.value
        held = numbers.keys()
        for batch in batches:
            lengths, terms, tfs = [], [], []
            for text in batch.column("text").to_pylist():
                found = terms_of(text)
                lengths.append(len(found))
                times = Counter(found)
                kept = sorted((numbers[t], times[t]) for t in times.keys() & held)
                terms.append([t for t, _ in kept] or None)
                tfs.append([n for _, n in kept] or None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()),
                 pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"])

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("text").cast("string").alias("text")).mapInArrow(
        count, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")
    return written(counted.filter("n > 0").withColumn("row", F.monotonically_increasing_id()),
                   "bag-vectors")


def _classes(vectors: DataFrame, documents: int, length: int) -> DataFrame:
    """Rows with a vector, with m and the hash of both."""
    # whole numbers of 38 digits: 25 * n * documents may pass 64 bits
    product = (F.col("n").cast("decimal(38,0)") * F.lit(_SLOPE)
               * F.lit(documents).cast("decimal(20,0)"))
    return (vectors.filter("terms IS NOT NULL")
            .withColumn("product", product.cast("decimal(38,0)"))
            .withColumn("m", F.lit(_LEAST) + F.expr(f"product div {length}L"))
            .withColumn("hash", F.xxhash64("m", "terms", "tfs"))
            .select("row", "doc_id", "hash", "m", "terms", "tfs"))


def _scores(classes: DataFrame, block: _Block, weights: np.ndarray, top: int) -> DataFrame:
    """item, score, least, class: the `top` best classes of each item in each task."""
    n_items = len(block.counts)
    shared = classes.sparkSession.sparkContext.broadcast(
        (block.first, block.items, block.times, weights))

    def score(batches):
        first, items, times, weight = shared.value
        best = np.zeros((0, 4), np.int64)
        nobody = np.int64(np.iinfo(np.int64).max)

        def kept(rows):
            """The `top` first rows of each item."""
            # by score downwards, least doc_id, none last, then class
            order = np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))
            rows = rows[order]
            begins = np.searchsorted(rows[:, 0], rows[:, 0])
            return rows[np.arange(len(rows)) - begins < top]

        step = max(1, CELLS // max(n_items, 1))
        for batch in batches:
            every, offsets = batch.column("terms"), batch.column("terms").offsets.to_numpy()
            flat = every.values.to_numpy(zero_copy_only=False)
            products = np.concatenate([[0], np.cumsum(first[flat + 1] - first[flat])])[offsets]
            at = 0
            while at < batch.num_rows:
                full = int(np.searchsorted(products, products[at] + CELLS, "right")) - 1
                end = max(at + 1, min(at + step, full, batch.num_rows))
                part, at = batch.slice(at, end - at), end
                terms, tfs = part.column("terms"), part.column("tfs")
                sizes = np.diff(terms.offsets.to_numpy())
                t = terms.flatten().to_numpy(zero_copy_only=False)
                tf = tfs.flatten().to_numpy(zero_copy_only=False)
                m = np.repeat(part.column("m").to_numpy(zero_copy_only=False), sizes)
                of_class = np.repeat(np.arange(part.num_rows), sizes)
                gain = weight[t] * ((1_000_000_000 * tf) // (_SCALE * tf + _K * m))
                # every (class term, item that holds it)
                holders = first[t + 1] - first[t]
                pair = np.repeat(np.arange(len(t)), holders)
                place = (np.arange(len(pair)) - np.repeat(np.cumsum(holders) - holders, holders)
                         + first[t][pair])
                cells = np.zeros(part.num_rows * n_items, np.int64)
                np.add.at(cells, of_class[pair] * n_items + items[place],
                          gain[pair] * times[place])
                positive = np.flatnonzero(cells > 0)
                which, item = positive // n_items, positive % n_items
                least = part.column("least").fill_null(int(nobody)).to_numpy()
                number = part.column("class").to_numpy()
                best = kept(np.concatenate([best, np.stack(
                    [item, cells[positive], least[which], number[which]], axis=1)]))
        for at in range(0, len(best), 50_000):
            rows = best[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([
                pa.array(rows[:, 0].astype(np.int32)), pa.array(rows[:, 1]),
                pa.array(rows[:, 2], mask=rows[:, 2] == nobody), pa.array(rows[:, 3])],
                names=["item", "score", "least", "class"])

    return classes.mapInArrow(score, "item int, score bigint, least bigint, class bigint")


def _ranked(docs: DataFrame, block: _Block, top: int) -> DataFrame | None:
    """item (number in the block), rank, doc_id, score."""
    vectors = _vectors(docs, block.vocabulary)
    total = vectors.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("length")).first()
    if not total["n"]:
        return None
    frequency = np.zeros(len(block.vocabulary), np.int64)
    # one row for each term of the block
    for row in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        frequency[row["t"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * int(df) + 1)))
                        for df in frequency], np.int64)

    rows = _classes(vectors, total["n"], total["length"])
    classes = rows.groupBy("hash", "m", "terms", "tfs").agg(
        F.min("doc_id").alias("least"), F.min("row").alias("class"))
    best = _scores(classes, block, weights, top)
    first = W.partitionBy("item").orderBy(
        F.desc("score"), F.asc_nulls_last("least"), F.asc("class"))
    best = written(best.withColumn("place", F.row_number().over(first))
                   .filter(F.col("place") <= top).select("item", "score", "class"), "bag-best")

    # a class is named by its first row; its vector finds the other members
    wanted = written(
        rows.join(_small(best.select("class").distinct(), F.lit(16)),
                  F.col("row") == F.col("class"), "left_semi")
        .select("hash", "m", "terms", "tfs", F.col("row").alias("class")), "bag-wanted")
    members = rows.join(
        _small(wanted, 48 + 12 * F.size("terms")), ["hash", "m", "terms", "tfs"])
    of_class = W.partitionBy("class").orderBy(F.asc_nulls_last("doc_id"), F.asc("row"))
    members = (members.withColumn("nth", F.row_number().over(of_class))
               .filter(F.col("nth") <= top).select("class", "doc_id", "row"))
    of_item = W.partitionBy("item").orderBy(
        F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row"))
    return (members.join(best, "class").withColumn("rank", F.row_number().over(of_item))
            .filter(F.col("rank") <= top).select("item", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score of the `top` best documents of each item.

    `docs` has doc_id and text, `items` item_id and text. Of the items, one block at a time
    comes to the driver."""
    spark = docs.sparkSession
    sized = written(
        items.select(F.col("item_id").cast("long").alias("item_id"),
                     F.col("text").cast("string").alias("text"))
        # no text has more terms than every other byte
        .withColumn("most", F.floor((F.coalesce(F.octet_length("text"), F.lit(0)) + 1) / 2))
        .withColumn("number", F.monotonically_increasing_id()), "bag-items")
    bound = sized.agg(F.sum("most").alias("n")).first()["n"] or 0
    blocks = max(1, -(-bound // block))
    found = []
    for at in range(blocks):
        rows = sized.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == at) \
            .orderBy("number").select("item_id", "text").collect()
        work = _Block([r["text"] for r in rows])
        ranked = _ranked(docs, work, top) if work.vocabulary else None
        if ranked is not None:
            ids = spark.createDataFrame(
                [(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id bigint")
            found.append(ranked.join(F.broadcast(ids), "item")
                         .select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], _RESULT)
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
