"""N-gram Jaccard join with grouped prefixes.

A document's set holds the hashes of its distinct 5-word shingles. Two sets of n and m
members with Jaccard similarity of 0.75 or more share at least 0.75 of the larger, so
they share a member of their prefixes: the first n - ceil(0.75 n) + 1 members in any
order that is the same for all sets. The order here puts rare members first:

* members below a fixed share of the hash range, by the number of their occurrences
  (counted over all documents), then by hash;
* the other members, by hash;
* last a list of very frequent members. What is in that list changes the order, and so
  the work, but never the result; it is short, so that it can be broadcast.

Members that occur in one set only link nothing. They fill most prefixes, so most
documents leave here, before anything is paired.

Sets with an identical prefix and size form a group. In the list of groups that share a
member, each is paired with one only, the one with the fewest members of its own; pairs
are verified on the whole sets, and links are merged into components. What is then
still apart within a list is expanded to the pairs of sets between different
components, as far as their sizes, the number of their members that other such sets
have, and their sketches allow a link; these are verified as well. So no link between
different components is missed, while groups of copies cost one pair per member.
Identical sets are one node from the start.

A sketch holds, for each of 1,024 hash values, whether an odd number of members has it.
Where two sketches differ, the sets differ in at least one member, so the number of
places is a lower bound of the members that only one set has, and a pair beyond what
the threshold allows needs no look at the sets.

Sets and members are 64-bit hashes.

Defined results: words are runs of other bytes than ASCII white space, A-Z in lower
case. A text of one to four words has one shingle, all its words. NULL texts and texts
without words have an empty set and are linked with nothing: each is its own component.
Rows without doc_id get component NULL, unless a row with id is reachable. Repeated rows
and ties are linked like other copies. An empty table gives no rows. Very long texts are
read whole.
"""

from __future__ import annotations

import sys
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from callstrata.llm import word_hashes
from callstrata.llm.common import checked_broadcast, small_batches, written
from callstrata.llm.components import components

SHINGLE = 5
#: The threshold as a fraction.
OVER, UNDER = 75, 100
#: Share of the hash range in which occurrences are counted.
COUNTED = 0.4
#: Members that the list of very frequent ones holds, and how often one must occur within
#: a task's stretch of about CHUNK members to be proposed.
FREQUENT, CHUNK, OFTEN = 50_000, 2_000_000, 8

#: Bits of a sketch.
SKETCH = 1024

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(words: list[bytes], hashes: word_hashes.WordHashes) -> np.ndarray:
    """Sorted distinct hashes."""
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(word_hashes.runs(hashes.of(words), min(SHINGLE, len(words))))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def set_hash(members: np.ndarray) -> int:
    """One number for the whole set, its size included; 0 for the empty set."""
    if not len(members):
        return 0
    total = np.bitwise_xor.reduce(word_hashes.mixed(members * _SPREAD), keepdims=True)
    more = word_hashes.mixed(members).sum(dtype=np.uint64, keepdims=True)
    value = int(word_hashes.mixed(total * _SPREAD + more + np.uint64(len(members)))[0])
    return (value if value != 0 else 1) - (1 << 64 if value >= 1 << 63 else 0)


def sketch(members: np.ndarray) -> np.ndarray:
    """Parity of the members with each low hash value, as 64-bit words."""
    seen = np.bincount((members % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
    return np.packbits(seen & 1).view(np.int64)


def prefix_length(n: int) -> int:
    return n - -(-OVER * n // UNDER) + 1


def often(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those that occur OFTEN or more, with their numbers. Sorts `members` in place, so
    that no second array of their size is made."""
    members.sort()
    last = max(len(members) - OFTEN + 1, 0)
    found = np.unique(members[:last][members[:last] == members[len(members) - last:]])
    return found, (np.searchsorted(members, found, "right")
                   - np.searchsorted(members, found, "left"))


def _describe(batches):
    """Set and size of each document; at the end, members often seen."""
    hashes = word_hashes.WordHashes()
    waiting, size, proposed = [], 0, []

    def count():
        members = np.concatenate(waiting)
        waiting.clear()
        proposed.append(often(members))

    seen: set[int] = set()
    for batch in batches:
        nodes, sizes = [], []
        for text in batch.column("text").to_pylist():
            members = shingle_set(_words(text), hashes)
            nodes.append(set_hash(members))
            sizes.append(len(members))
            if nodes[-1] not in seen:
                seen.add(nodes[-1])
                waiting.append(members)
                size += len(members)
            if size >= CHUNK:
                count()
                size = 0
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(nodes, pa.int64()),
             pa.array(sizes, pa.int64()),
             pa.nulls(len(nodes), pa.int64()), pa.nulls(len(nodes), pa.int64())],
            names=["doc_id", "text_hash", "node", "n", "member", "times"])
    if waiting:
        count()
    for members, times in proposed:
        k = len(members)
        yield pa.RecordBatch.from_arrays(
            [*(pa.nulls(k, pa.int64()) for _ in range(4)),
             pa.array(members.view(np.int64)), pa.array(times.astype(np.int64))],
            names=["doc_id", "text_hash", "node", "n", "member", "times"])


def _entries(frequent):
    """Makes the mapper that lists, for each set, the members its prefix may hold."""
    below = np.uint64(int(COUNTED * 2.0 ** 64))

    def run(batches):
        hashes, seen = word_hashes.WordHashes(), set()
        last = np.array(frequent.value, np.int64).view(np.uint64)
        last.sort()
        for batch in batches:
            nodes, facts, lists = [], [], []
            for text in batch.column("text").to_pylist():
                members = shingle_set(_words(text), hashes)
                node = set_hash(members)
                if node == 0 or node in seen:
                    continue
                seen.add(node)
                n = len(members)
                at = np.minimum(np.searchsorted(last, members), max(len(last) - 1, 0))
                late = (last[at] == members) if len(last) else np.zeros(n, bool)
                counted = members[~late & (members < below)]
                length, more = prefix_length(n), 0
                if len(counted) < length:
                    rest = np.concatenate([members[~late & (members >= below)], members[late]])
                    counted = np.concatenate([counted, rest[:length - len(counted)]])
                    more = 1
                nodes.append(node)
                facts.append((n, len(counted), more))
                lists.append(counted)
            ends = np.cumsum([0] + [len(x) for x in lists])
            values = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()),
                 pa.array([n << 33 | k << 1 | m for n, k, m in facts], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                          pa.array(values.view(np.int64)))],
                names=["node", "facts", "members"])

    return run


def _sets(batches):
    hashes = word_hashes.WordHashes()
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for at in range(0, len(texts), 500):
            sets = [shingle_set(_words(t), hashes) for t in texts[at:at + 500]]
            ends = np.cumsum([0] + [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_hash(s) for s in sets], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
                     np.concatenate(sets).view(np.int64))),
                 pa.array([sketch(s) for s in sets], pa.list_(pa.int64()))],
                names=["node", "members", "sketch"])


def _prefixes(docs: DataFrame, frequent: list[int]) -> DataFrame:
    """node, n, prefix: the members of each set's prefix that another set has, too;
    alone: how many of its counted members no other set has. Sets without any are left
    out."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    entries = (docs.select("text").mapInArrow(
        _entries(shared), "node bigint, facts bigint, members array<bigint>")
        .select("node", "facts", F.explode("members").alias("member")))
    same = W.partitionBy("member")
    counted = (entries
               .withColumn("times", F.count(F.lit(1)).over(same))
               .withColumn("first", F.min("node").over(same))
               .withColumn("last", F.max("node").over(same))
               .filter("first != last"))
    by_set = counted.groupBy("node", "facts").agg(
        F.sort_array(F.collect_set(F.struct("times", "member"))).alias("found"))
    n = F.shiftright("facts", 33)
    listed = F.shiftright("facts", 1).bitwiseAND(F.lit((1 << 32) - 1))
    everything = F.col("facts").bitwiseAND(F.lit(1)) == 1
    length = n - F.ceil(n * OVER / UNDER) + 1
    alone = listed - F.size("found")
    take = F.when(everything, F.size("found").cast("long")).otherwise(length - alone)
    return (by_set
            .select("node", n.alias("n"), alone.cast("int").alias("alone"),
                    F.slice("found", F.lit(1), F.greatest(take, F.lit(0)).cast("int"))
                    .alias("found"))
            .filter(F.size("found") > 0)
            .select("node", "n", "alone", F.transform("found", lambda x: x.member)
                    .alias("prefix")))


def _sizes_fit(a, b):
    return UNDER * F.least(a, b) >= OVER * F.greatest(a, b)


def _sketch_words(side: str) -> list:
    """The words of a sketch as columns: a join compares these far faster than arrays."""
    return [F.col("sketch")[i].alias(f"{side}{i}") for i in range(SKETCH // 64)]


def _sketches_fit(n_a, n_b):
    """Whether sets of n_a and n_b members may link, as far as their sketches tell."""
    differ = reduce(add, (F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}")))
                          for i in range(SKETCH // 64)))
    return UNDER * (n_a + n_b - differ) >= OVER * (n_a + n_b + differ)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - F.col("common")
    return (pairs.join(left, "a").join(right, "b").withColumn("common", common)
            .filter(UNDER * F.col("common") >= OVER * union).select("a", "b"))


def _firsts(lists: DataFrame) -> DataFrame:
    """Each list's entries with the entry of least rank, if their sizes fit and they are
    in different components. Entries: list, node, n, component, rank."""
    lead = lists.groupBy("list").agg(F.min(F.struct("rank", "node", "n", "component")).alias("l"))
    return (lists.join(lead, "list")
            .filter((F.col("component") != F.col("l.component"))
                    & _sizes_fit(F.col("n"), F.col("l.n")))
            .select(F.least("node", "l.node").alias("a"), F.greatest("node", "l.node").alias("b"))
            .distinct())


def linked_sets(docs: DataFrame, frequent: list[int], first_doc: DataFrame) -> DataFrame:
    """node, component of all sets that link with another one. `first_doc`: node,
    and doc_id (may be NULL) and text_hash of one row with the set."""
    prefixes = written(_prefixes(docs, frequent), "prefixes")
    groups = written(
        prefixes.filter("alone = 0").groupBy("n", "prefix").agg(
            F.min("node").alias("group"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1").drop("size"), "prefix-groups")
    members = written(
        prefixes.filter("alone = 0").join(groups, ["n", "prefix"])
        .select("node", "n", "group"), "group-members")
    wanted = written(prefixes.select("node").join(first_doc, "node").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "wanted")
    sets = written(
        docs.join(checked_broadcast(wanted), docs["doc_id"].eqNullSafe(wanted["_id"])
                  & (docs["text_hash"] == wanted["_hash"]), "left_semi").select("text")
        .mapInArrow(_sets, "node bigint, members array<bigint>, sketch array<bigint>")
        .join(prefixes.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")

    # member lists: first of groups, then of all sets
    postings = written(prefixes.select("node", "n", "alone", F.explode("prefix").alias("list")),
                       "postings")
    others = members.filter("node != group").select("node")
    grouped = postings.join(others, "node", "left_anti")
    start = grouped.select("list", "node", "n", F.col("node").alias("component"),
                           F.struct("alone", "node").alias("rank"))
    inside = members.filter("node != group").select(
        F.least("node", "group").alias("a"), F.greatest("node", "group").alias("b"))
    tried = written(_firsts(start).unionByName(inside).distinct(), "pairs")
    links = written(_verified(tried, sets), "links")
    found = components(links)

    lists = written(_apart(postings, found), "lists")
    lists = written(lists.join(_common_members(lists, sets), "node")
                    .join(sets.select("node", "sketch"), "node"), "lists")
    left = lists.select("list", F.col("node").alias("a"), F.col("n").alias("n_a"),
                        F.col("component").alias("c_a"), F.col("common").alias("k_a"),
                        *_sketch_words("a"))
    right = lists.select("list", F.col("node").alias("b"), F.col("n").alias("n_b"),
                         F.col("component").alias("c_b"), F.col("common").alias("k_b"),
                         *_sketch_words("b"))
    most = F.least("k_a", "k_b")
    rest = (left.join(right, "list")
            .filter((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b"))
                    & _sizes_fit(F.col("n_a"), F.col("n_b"))
                    & (UNDER * most >= OVER * (F.col("n_a") + F.col("n_b") - most))
                    & _sketches_fit(F.col("n_a"), F.col("n_b")))
            .select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"))
    more = written(_verified(written(rest, "pairs"), sets), "links")
    if more.isEmpty():
        return found
    return components(links.unionByName(more))


def _apart(postings: DataFrame, found: DataFrame) -> DataFrame:
    """The lists whose sets are in more than one component."""
    known = postings.join(found.select("node", F.col("component").alias("_c")), "node", "left")
    labelled = written(known.select("list", "node", "n",
                                    F.coalesce("_c", "node").alias("component")), "labelled")
    mixed = (labelled.groupBy("list").agg(
        F.min("component").alias("x"), F.max("component").alias("y"))
        .filter("x != y").select("list"))
    return labelled.join(written(mixed, "mixed-lists"), "list")


def _common_members(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """node, common: how many of its members another set in these lists has, too. No
    two of the sets share more than the smaller of their numbers."""
    members = (sets.join(written(lists.select("node").distinct(), "apart"), "node", "left_semi")
               .select("node", F.explode("members").alias("member")))
    same = W.partitionBy("member")
    return (members.withColumn("x", F.min("node").over(same))
            .withColumn("y", F.max("node").over(same)).filter("x != y")
            .groupBy("node").agg(F.count(F.lit(1)).alias("common")))


def _first_row() -> Column:
    """The least (doc_id, text_hash), rows with a doc_id before those without."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))


def _report(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n, component_id of every row of `docs` (doc_id, text), and
    keep: doc_id and text_hash of the first row of its component, NULL if the set is
    empty."""
    with small_batches(docs.sparkSession):
        return _stored_report(docs)


def _stored_report(docs: DataFrame) -> DataFrame:
    """As _report; every step that takes texts is stored when this returns."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("text").alias("text_hash"))
    described = written(docs.mapInArrow(
        _describe, "doc_id bigint, text_hash bigint, node bigint, n bigint, member bigint, "
        "times bigint"), "described")
    rows = described.filter("node IS NOT NULL").select("doc_id", "text_hash", "node", "n")
    frequent = [r.member for r in described.filter("member IS NOT NULL")
                .groupBy("member").agg(F.sum("times").alias("times"))
                .orderBy(F.desc("times"), "member").limit(FREQUENT).select("member").collect()]
    first = written(rows.filter("n > 0").groupBy("node").agg(_first_row().alias("f"))
                    .select("node", "f.doc_id", "f.text_hash"), "first-documents")
    linked = linked_sets(docs, frequent, first)
    least = (first.join(linked, "node").groupBy("component").agg(_first_row().alias("least")))
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    of_node = written(
        first.join(linked, "node", "left").join(least, "component", "left")
        .select("node", F.coalesce("least", own).alias("keep")), "set-components")
    return (rows.join(of_node, "node", "left")
            .select("doc_id", "text_hash", "n",
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("keep.doc_id"))
                    .alias("component_id"), "keep"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs` (doc_id, text)."""
    return _report(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component, that with the smallest doc_id, all its columns kept;
    of rows equal in doc_id and text one stays, rows without doc_id all do. Other texts
    under the same doc_id are rows of their own."""
    report = _report(docs)
    gone = written(
        report.filter("doc_id IS NOT NULL AND n > 0 AND "
                      "(doc_id != keep.doc_id OR text_hash != keep.text_hash)")
        .select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_gone_text"))
        .distinct(), "near-duplicates")
    text_hash = F.xxhash64(docs["text"])
    kept = docs.join(checked_broadcast(gone), (docs["doc_id"] == gone["_gone"])
                     & (text_hash == gone["_gone_text"]), "left_anti")
    twice = written(
        docs.select(F.col("doc_id").alias("_twice"), text_hash.alias("_twice_text"))
        .filter("_twice IS NOT NULL").groupBy("_twice", "_twice_text").count()
        .filter("count > 1").drop("count"), "repeated-rows")
    on = (kept["doc_id"] == twice["_twice"]) & (
        F.xxhash64(kept["text"]) == twice["_twice_text"])
    narrow = checked_broadcast(twice)
    return kept.join(narrow, on, "left_anti").unionByName(
        kept.join(narrow, on, "left_semi").dropDuplicates(["doc_id", "text"]))


# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
