"""Substring dedup with prefix-partitioned suffix trees.

A window is 50 consecutive words. Words of a window that also starts in a document with
a smaller doc_id are removed.

1. Rows with equal words are one document here, known by a fingerprint of its words, not
   by doc_id, which may be absent or repeated. Its id is the smallest of its rows.
2. Every window is put into a part by a prefix-independent mark of its words, the least
   hash of its 8-word grams. Windows in a row share a mark, so a part gets short
   stretches of text; equal windows always meet in one part. Marks that occur in one
   document only are dropped before any words are moved.
3. Parts are gathered into groups that fit a task's memory. In each group the suffixes
   that start at the windows form a tree, built by doubling the depth of its nodes (1,
   2, 4 ... words); a suffix alone in its node is a leaf and goes no further. Nodes at
   50 words are the repeats, and each keeps the smallest document id below it.
4. A part with more words than fit a group is divided by the longest prefix, the window
   itself: its nodes are rows of their own, and Spark takes the minimum for each.

Words are compared by 64-bit hashes.

Defined results: a NULL or empty text has no words. Words are runs of other bytes than
ASCII white space. A row without doc_id counts as one with the largest id there can be:
later than all others, and not earlier than another such row. Rows of equal ids do not
cut each other. Repeated rows each get the same result; the smallest id of equal texts
keeps its words. A text of fewer than 50 words loses none. An empty table gives no rows.
Texts are read whole. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.llm import word_hashes
from callstrata.llm.common import checked_broadcast, written

WINDOW = 50
GRAM = 8
LATEST = (1 << 63) - 1
#: Words in a group; a task needs about 100 bytes for each.
GROUP_WORDS = 600_000
#: A mark with more words than this is divided by whole windows.
LARGE_PART = 300_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def window_marks(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """mark, first window start and number of windows of each stretch."""
    least = word_hashes.runs(hashes, gram)
    width, span = window - gram + 1, 1
    if len(least) < width:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return least[first], first, np.diff(np.append(first, len(least)))


def deep_nodes(words: np.ndarray, ends: np.ndarray, depth: int = WINDOW
               ) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a concatenation of stretches that share their first `depth` words
    with another one: positions and nodes. `ends`: each position's end of stretch."""
    node = np.unique(words, return_inverse=True)[1].astype(np.int64)
    active = np.flatnonzero(ends - np.arange(len(words)) >= 1)
    at, known = 1, np.full(len(words), -1, np.int64)
    while True:
        counts = np.bincount(node) if len(node) else np.zeros(0, np.int64)
        shared = counts[node] > 1
        active, node = active[shared], node[shared]
        if at == depth or not len(active):
            return active, node
        step = min(at, depth - at)
        known.fill(-1)
        known[active] = node
        inside = active + step + at <= ends[active]
        active, node = active[inside], node[inside]
        second = known[active + step]
        both = second >= 0
        active, node, second = active[both], node[both], second[both]
        width = int(second.max()) + 1 if len(second) else 1
        node = np.unique(node * width + second, return_inverse=True)[1]
        at += step


def _fingerprint(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _scan(batches):
    """Of each document its words' fingerprint and number, the digest of all words,
    and its marks; those only once for equal documents in a task."""
    hashes, seen = word_hashes.WordHashes(), set()
    mark = pa.list_(pa.struct([("mark", pa.int64()), ("start", pa.int32()),
                               ("n", pa.int32())]))
    for batch in batches:
        prints, counts, digests, marks = [], [], [], []
        for text in batch.column("text").to_pylist():
            words = word_hashes.split(text)
            prints.append(_fingerprint(words))
            counts.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            if len(words) < WINDOW or prints[-1] in seen:
                marks.append(None)
                continue
            seen.add(prints[-1])
            m, s, n = window_marks(hashes.of(words))
            marks.append((m, s, n))
        ends = np.cumsum([0] + [len(x[0]) if x else 0 for x in marks])
        some = [x for x in marks if x] or [(np.zeros(0, np.uint64),) + (np.zeros(0),) * 2]
        fields = [np.concatenate([x[i] for x in some]) for i in range(3)]
        values = pa.StructArray.from_arrays(
            [pa.array(fields[0].view(np.int64)), pa.array(fields[1].astype(np.int32)),
             pa.array(fields[2].astype(np.int32))], fields=list(mark.value_type))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("id"), batch.column("h"),
             pa.array(prints, pa.binary()), pa.array(counts, pa.int64()),
             pa.array(digests, pa.string()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
            names=["doc_id", "id", "h", "print", "n_words", "all_sha256", "marks"])


_SCANNED = ("doc_id bigint, id bigint, h bigint, print binary, n_words bigint, "
            "all_sha256 string, marks array<struct<mark:bigint,start:int,n:int>>")


def _stretches(batches):
    """The words of each marked stretch; of large parts the windows' hashes instead."""
    hashes, seen = word_hashes.WordHashes(), set()
    for batch in batches:
        rows = []
        for doc, text, fingerprint, marks in zip(*(batch.column(c).to_pylist() for c in (
                "id", "text", "print", "found"))):
            if fingerprint in seen:
                continue  # a repeated row
            words = word_hashes.split(text)
            if _fingerprint(words) != fingerprint:
                continue  # another text with the same hash
            seen.add(fingerprint)
            known = hashes.of(words)
            whole = None
            for m in marks:
                start, n = m["start"], m["n"]
                if m["large"]:
                    if whole is None:
                        whole = word_hashes.runs(known, WINDOW)
                    rows.append((m["mark"], doc, fingerprint, start, n, True,
                                 whole[start:start + n].tobytes()))
                else:
                    rows.append((m["mark"], doc, fingerprint, start, n, False,
                                 known[start:start + n + WINDOW - 1].tobytes()))
            if len(rows) > 2000:
                yield _stretch_batch(rows)
                rows = []
        yield _stretch_batch(rows)


def _stretch_batch(rows):
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.bool_(),
             pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
        names=["mark", "id", "print", "start", "n", "large", "words"])


def _group_tree(table: pa.Table) -> pa.Table:
    """Runs of windows of a group that start in an earlier document, too."""
    ids = table.column("id").to_numpy()
    first = table.column("start").to_numpy().astype(np.int64)
    n = table.column("n").to_numpy().astype(np.int64)
    words = np.frombuffer(b"".join(table.column("words").to_pylist()), np.uint64)
    lengths = n + WINDOW - 1
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(n)), lengths)
    position, node = deep_nodes(words, ends[owner])
    least = np.full(int(node.max()) + 1 if len(node) else 0, LATEST, np.int64)
    owner = owner[position]
    np.minimum.at(least, node, ids[owner])
    late = least[node] < ids[owner]
    position, owner = position[late], owner[late]
    start = first[owner] + position - (ends - lengths)[owner]
    new = np.ones(len(start), bool)
    new[1:] = (position[1:] != position[:-1] + 1) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(start)) - 1 if len(at) else at
    return pa.table({"print": table.column("print").take(pa.array(owner[at])),
                     "first": pa.array(start[at], pa.int32()),
                     "last": pa.array(start[last], pa.int32())})


def _window_hashes(batches):
    for batch in batches:
        n = np.array(batch.column("n").to_pylist(), np.int64)
        hashes = np.frombuffer(b"".join(batch.column("words").to_pylist()), np.int64)
        starts = np.array(batch.column("start").to_pylist(), np.int64)
        offset = np.arange(len(hashes)) - np.repeat(np.cumsum(n) - n, n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes), pa.array(np.repeat(batch.column("id").to_numpy(), n)),
             batch.column("print").take(pa.array(np.repeat(np.arange(len(n)), n))),
             pa.array((np.repeat(starts, n) + offset).astype(np.int32))],
            names=["window", "id", "print", "start"])


def repeats(docs: DataFrame, scanned: DataFrame, first: DataFrame) -> DataFrame:
    """print, first, last: runs of starts of windows that also start in an earlier
    document, for the documents in `first` (print, first_id, first_h)."""
    marks = scanned.select("print", F.explode("marks").alias("m")).select("print", "m.*")
    shared = written(
        marks.groupBy("mark").agg(F.min("print").alias("a"), F.max("print").alias("b"),
                                  F.sum(F.col("n") + (WINDOW - 1)).alias("n_words"))
        .filter("a != b")
        .select("mark", (F.col("n_words") > LARGE_PART).alias("large")), "shared-marks")
    found = (marks.join(shared, "mark")
             .groupBy("print").agg(F.collect_set(F.struct("mark", "start", "n", "large"))
                                   .alias("found")))
    wanted = written(found.join(first, "print"), "marked-documents")
    stretches = written(_texts_of(docs, wanted).mapInArrow(
        _stretches, "mark bigint, id bigint, print binary, start int, n int, large boolean, "
        "words binary"), "stretches")
    small, large = stretches.filter("NOT large"), stretches.filter("large")
    total = small.agg(F.sum(F.col("n") + (WINDOW - 1))).first()[0] or 0
    groups = int(total // GROUP_WORDS + 1)
    trees = (small.withColumn("group", F.pmod(F.xxhash64("mark"), F.lit(groups)))
             .groupBy("group").applyInArrow(_group_tree, "print binary, first int, last int"))
    windows = written(large.select("id", "print", "start", "n", "words").mapInArrow(
        _window_hashes, "window bigint, id bigint, print binary, start int"), "large-windows")
    least = written(windows.groupBy("window").agg(F.min("id").alias("least"),
                                                  F.max("id").alias("most"))
                    .filter("least < most").select("window", "least"), "large-nodes")
    divided = (windows.join(least, "window").filter("id > least")
               .select("print", F.col("start").alias("first"), F.col("start").alias("last")))
    return trees.unionByName(divided)


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Documents of `wanted` with the text of their first row, found by its id and the
    hash of its text; a row that is there several times comes as often."""
    keys = wanted.select(F.col("first_id").alias("id"), F.col("first_h").alias("h"))
    near = docs.join(checked_broadcast(keys), ["id", "h"], "left_semi")
    return near.select("id", "h", "text").join(
        wanted.withColumnsRenamed({"first_id": "id", "first_h": "h"}), ["id", "h"])


def _remove(batches):
    for batch in batches:
        prints, removed, digests = [], [], []
        for text, fingerprint, runs in zip(*(batch.column(c).to_pylist() for c in (
                "text", "print", "runs"))):
            words = word_hashes.split(text)
            if _fingerprint(words) != fingerprint:
                continue  # another text with the same hash
            prints.append(fingerprint)
            change = np.zeros(len(words) + 1, np.int64)
            for run in runs:
                change[run["first"]] += 1
                change[min(run["last"] + WINDOW, len(words))] -= 1
            kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join([words[i] for i in kept])).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(prints, pa.binary()), pa.array(removed, pa.int64()),
             pa.array(digests, pa.string())], names=["print", "n_cut", "cut_sha256"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of `docs` (doc_id, text)."""
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(LATEST)).alias("id"),
                       F.xxhash64(F.col("text")).alias("h"), "text")
    scanned = written(rows.mapInArrow(_scan, _SCANNED), "scanned")
    first = written(
        scanned.groupBy("print").agg(F.min(F.struct("id", "h")).alias("row"))
        .select("print", F.col("row.id").alias("first_id"), F.col("row.h").alias("first_h")),
        "first-copies")
    runs = written(
        repeats(rows, scanned, first).groupBy("print")
        .agg(F.collect_list(F.struct("first", "last")).alias("runs")).join(first, "print"),
        "repeats")
    cut = written(_texts_of(rows, runs).mapInArrow(
        _remove, "print binary, n_cut bigint, cut_sha256 string").distinct(), "cut")
    placed = (scanned.select("doc_id", "id", "print", "n_words", "all_sha256")
              .join(first, "print")
              .withColumn("copy", (F.col("id") > F.col("first_id")) & (F.col("n_words") >= WINDOW)))
    return (placed.join(cut, "print", "left")
            .select("doc_id", "n_words",
                    F.when(F.col("copy"), F.col("n_words"))
                    .otherwise(F.coalesce("n_cut", F.lit(0).cast("long"))).alias("n_removed"),
                    F.when(F.col("copy"), F.lit(EMPTY_SHA))
                    .otherwise(F.coalesce("cut_sha256", "all_sha256")).alias("kept_sha256")))


# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
