"""The prefix trie of rebuilt conversations, by truncation peeling.

A conversation becomes one key: for each turn 16 bytes of a digest of (role, text) and 8
of the text's length. Keys sorted as bytes are in trie order, and a node is a prefix of
whole turns. Keys are dealt out by range, with conv_id as second part of the range, so
that neither a first turn nor a whole conversation that a third of all rows share lies in
one task.

A task peels its sorted run in segments of at most `SEGMENT` turns and conversations. It
descends from the greatest depth: at each depth the conversations that end there join the
nodes that survived from below, both are grouped by node, each node's counts are then
complete, and stripping the last turn makes it part of its parent. So nodes are found and
aggregated in one pass, with work in proportion to their number, however deep they are.

Only prefixes of a segment's first and last key can also occur in other segments. What a
segment holds of them leaves as two paths with partial counts; groups of `FAN` partitions'
paths are peeled in the same way, again and again, until one group is left. Children of
such a node wait for its smallest member and get it by a join on a digest of the prefix;
conv_ids of conversations that end at one leave in short chunks, which one task reads in
order, chunk by chunk.

Defined results: rows without conv_id are in no conversation. Of a conversation, turns are
in order of `turn`, NULL first, equal ones in order of their digests; a repeated row is a
turn of its own. NULL role or text is empty. Every conv_id is a member of the root, without
turns too; an empty table has no root and gives no rows. Digests are 128 bits of SHA-256.
Other columns are not read. A conversation's key, 24 bytes a turn, is held in one row.
"""

from __future__ import annotations

import hashlib
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callstrata.llm.common import written

#: The longest start that a conversation takes over, and how many share one.
LONGEST_START, FAMILY = 8, 5
#: Turns and conversations that are peeled at once.
SEGMENT = 200_000
#: Partitions whose paths are peeled together.
FAN = 32
#: conv_ids in one chunk of a list that is hashed in order.
CHUNK = 512
BROADCAST_BYTES = 16 << 20

DIGEST, TOKEN = 16, 24

NODE, WAITING, PATH, ENDS = 0, 1, 2, 3
_FOUND = ("kind int, id binary, parent_id binary, conv_id bigint, depth bigint, "
          "parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
          "saved_tokens bigint, ends_sha256 string, part int, nth bigint, key binary, "
          "counts binary, chunk string")
_NAMES = [field.split()[0] for field in _FOUND.split(", ")]
_ARROW = pa.schema([
    ("kind", pa.int32()), ("id", pa.binary()), ("parent_id", pa.binary()),
    *[(n, pa.int64()) for n in _NAMES[3:10]], ("ends_sha256", pa.string()),
    ("part", pa.int32()), ("nth", pa.int64()), ("key", pa.binary()), ("counts", pa.binary()),
    ("chunk", pa.string())])
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
          "saved_tokens", "ends_sha256"]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- conversations as keys ------------------------------------------------------------

def _token(role: Column, text: Column) -> Column:
    """48 hexadecimal digits of one turn."""
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(digest, 1, 2 * DIGEST),
                    F.lpad(F.lower(F.hex(F.octet_length(text).cast("long"))), 16, "0"))


def start_length(conv_id: Column) -> Column:
    """How many first turns a conversation takes from its family's first one."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % (LONGEST_START + 1)).cast("int")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, key: the first turns of conversation c - c % 5, then c's own after these."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        _token(role, text).alias("token")).filter("conv_id IS NOT NULL")
    # dealt out by family once, for both the grouping and the window
    turns = turns.withColumn("family", F.expr(f"conv_id - conv_id % {FAMILY}")) \
        .repartition("family")
    own = turns.groupBy("family", "conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "token"))).alias("turns")) \
        .select("family", "conv_id", F.col("turns.token").alias("own"))
    start = F.first(F.when(F.col("conv_id") == F.col("family"),
                           F.slice("own", 1, LONGEST_START)), ignorenulls=True)
    h = start_length(F.col("conv_id"))
    none = F.expr("CAST(array() AS array<string>)")
    tokens = F.concat(
        F.slice(F.coalesce(F.col("start"), none), F.lit(1), h),
        F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0))))
    return (own.withColumn("start", start.over(W.partitionBy("family")))
            .select("conv_id", F.unhex(F.array_join(tokens, "")).alias("key")))


# --- peeling ---------------------------------------------------------------------------

def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common from their start."""
    n = min(len(a), len(b)) // TOKEN
    if a[:n * TOKEN] == b[:n * TOKEN]:
        return n
    words = TOKEN // 8
    differ = np.frombuffer(a, "<u8", n * words) != np.frombuffer(b, "<u8", n * words)
    return int(differ.argmax()) // words


def prefix_ids(key: bytes) -> list[bytes]:
    """The id of each prefix of a key, by depth."""
    running, ids = hashlib.sha256(), []
    for at in range(0, len(key) + 1, TOKEN):
        if at:
            running.update(key[at - TOKEN:at])
        ids.append(running.digest()[:DIGEST])
    return ids


class _Peeled:
    """Rows for the table of findings."""

    def __init__(self):
        self.columns = {name: [] for name in _NAMES}
        self.rows = 0

    def add(self, **values) -> None:
        for name, column in self.columns.items():
            column.append(values.get(name))
        self.rows += 1

    def taken(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pydict(self.columns, schema=_ARROW)
        self.__init__()
        return batch


def peel(keys: list[bytes], arriving: dict[int, list], ended: list | None, place: tuple | None,
         out: _Peeled) -> None:
    """Peels distinct keys in ascending order.

    `arriving` lists by depth what joins there: (path number, members, smallest member,
    children, leaves, saved). `ended` has each key's conv_ids; without it, nodes get their
    ids, and what ends at them is joined later. `place` (part, nth) names this run among
    others, whose nodes may be the prefixes of the first and last key as well; None if
    there are no others.
    """
    shared, up = [-1], [-1]
    for j in range(1, len(keys)):
        shared.append(shared_turns(keys[j - 1], keys[j]))
        # the key that owns the node where this one branches off
        owner = j - 1
        while shared[owner] >= shared[j]:
            owner = up[owner]
        up.append(owner)

    # nodes of key j down to open_until[j] may continue in other runs
    open_until: dict[int, int] = {}
    if place is not None:
        owner, limit = len(keys) - 1, len(keys[-1]) // TOKEN
        while owner >= 0:
            open_until[owner] = limit
            limit, owner = shared[owner], up[owner]
        open_until[0] = len(keys[0]) // TOKEN
    id_lists: dict[int, list[bytes]] = {}

    def node_id(j: int, depth: int) -> bytes:
        if j not in id_lists:
            id_lists[j] = prefix_ids(keys[j])
        return id_lists[j][depth]

    paths: dict[int, list] = {}

    def leave(node: list, parent: list | None, parent_id: bytes | None) -> None:
        owner, depth, members, least, children, leaves, saved, _ = node
        ends, own_id = None, None
        if ended is None:
            own_id = node_id(owner, depth)
        elif len(keys[owner]) == depth * TOKEN:
            ends = hashlib.sha256(",".join(map(str, ended[owner])).encode()).hexdigest()
        else:
            ends = _NO_ENDS
        out.add(kind=NODE if parent_id is None else WAITING, id=own_id, parent_id=parent_id,
                conv_id=least, depth=depth, parent_conv_id=parent and parent[3],
                n_convs=members, n_children=children, n_leaves=leaves, saved_tokens=saved,
                ends_sha256=ends)

    survivors: dict[int, list] = {}
    at = list(range(len(keys)))
    for depth in range(max(arriving), -1, -1):
        for j, members, least, children, leaves, saved in arriving.get(depth, ()):
            owner = at[j]
            while shared[owner] >= depth:
                owner = up[owner]
            at[j] = owner
            node = survivors.get(owner)
            if node is None:
                survivors[owner] = [owner, depth, members, least, children, leaves, saved, []]
            else:
                node[2] += members
                node[3] = min(node[3], least)
                node[4] += children
                node[5] += leaves
                node[6] += saved
        stripped: dict[int, list] = {}
        for owner, node in survivors.items():
            if depth <= open_until.get(owner, -1):
                paths.setdefault(owner, []).append((depth, *node[2:7]))
                if node[7]:
                    waiting_for = node_id(owner, depth)
                    for child in node[7]:
                        leave(child, None, waiting_for)
                continue
            for child in node[7]:
                leave(child, node, None)
            node[7] = ()
            if not node[4]:
                node[5] = 1
            if not depth:
                leave(node, None, None)
                continue
            end = depth * TOKEN
            node[6] += (node[2] - 1) * int.from_bytes(keys[owner][end - 8:end], "big")
            parent = owner if shared[owner] < depth - 1 else up[owner]
            above = stripped.get(parent)
            if above is None:
                stripped[parent] = [parent, depth - 1, node[2], node[3], 1, node[5], node[6],
                                    [node]]
            else:
                above[2] += node[2]
                above[3] = min(above[3], node[3])
                above[4] += 1
                above[5] += node[5]
                above[6] += node[6]
                above[7].append(node)
        survivors = stripped

    if place is None:
        return
    part, nth = place
    # open nodes that the first key does not own are prefixes of the last one
    first = paths.pop(0, [])
    for side, key, counts in ((0, keys[0], first),
                              (1, keys[-1], [c for own in paths.values() for c in own])):
        if counts:
            out.add(kind=PATH, part=part, nth=nth + side, key=key,
                    counts=np.array(counts, np.int64).tobytes())
    if ended is None:
        return
    # conversations that end at an open node
    for owner in sorted(open_until):
        depth = len(keys[owner]) // TOKEN
        if depth <= open_until[owner]:
            ids = ended[owner]
            for first in range(0, len(ids), CHUNK):
                out.add(kind=ENDS, id=node_id(owner, depth), part=part,
                        nth=nth + first // CHUNK,
                        chunk=",".join(map(str, ids[first:first + CHUNK])))


def _peel_sorted(segment: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        out = _Peeled()
        keys: list[bytes] = []
        ended: list[array] = []
        held = done = 0

        def finish():
            arriving: dict[int, list] = {}
            for j, ids in enumerate(ended):
                arriving.setdefault(len(keys[j]) // TOKEN, []).append(
                    (j, len(ids), ids[0], 0, 0, 0))
            peel(keys, arriving, ended, (part, done), out)

        for batch in batches:
            for key, conv_id in zip(batch.column("key").to_pylist(),
                                    batch.column("conv_id").to_pylist()):
                if held >= segment:
                    finish()
                    yield out.taken()
                    done += held
                    keys, ended, held = [], [], 0
                if not keys or keys[-1] != key:
                    keys.append(key)
                    ended.append(array("q"))
                    held += len(key) // TOKEN
                ended[-1].append(conv_id)
                held += 1
        if keys:
            finish()
            yield out.taken()

    return run


def _peel_paths(last: bool):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("part").to_pylist(), table.column("nth").to_pylist(),
                          table.column("key").to_pylist(), table.column("counts").to_pylist()))
        keys: list[bytes] = []
        arriving: dict[int, list] = {}
        for _, _, key, counts in sorted(rows, key=lambda row: row[2]):
            if not keys or keys[-1] != key:
                keys.append(key)
            for depth, *rest in np.frombuffer(counts, np.int64).reshape(-1, 6).tolist():
                arriving.setdefault(depth, []).append((len(keys) - 1, *rest))
        out = _Peeled()
        peel(keys, arriving, None, None if last else rows[0][:2], out)
        return pa.Table.from_batches([out.taken()])

    return run


def _hashed_in_order(chunks: DataFrame) -> DataFrame:
    """id, ends_sha256 of the chunks of each id, joined by commas."""

    def run(batches):
        current, running, ids, hashes = None, None, [], []
        for batch in batches:
            for number, chunk in zip(batch.column("id").to_pylist(),
                                     batch.column("chunk").to_pylist()):
                if number != current:
                    if running is not None:
                        ids.append(current)
                        hashes.append(running.hexdigest())
                    current, running = number, hashlib.sha256(chunk.encode())
                else:
                    running.update(b"," + chunk.encode())
        if running is not None:
            ids.append(current)
            hashes.append(running.hexdigest())
        yield pa.RecordBatch.from_pydict(
            {"id": pa.array(ids, pa.binary()), "ends_sha256": pa.array(hashes, pa.string())})

    return (chunks.select("id", "part", "nth", "chunk").repartition("id")
            .sortWithinPartitions("id", "part", "nth").select("id", "chunk")
            .mapInArrow(run, "id binary, ends_sha256 string"))


def trie(conversations: DataFrame, segment: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    keys = written(rebuilt(conversations), "trie-keys")
    found = [written(
        keys.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
        .mapInArrow(_peel_sorted(segment), _FOUND), "trie-nodes")]
    width = fan
    while True:
        paths = found[-1].filter(F.col("kind") == PATH)
        groups = paths.select(F.floor(F.col("part") / width).alias("g")).distinct().count()
        if not groups:
            break
        found.append(written(
            paths.withColumn("g", F.floor(F.col("part") / width))
            .select("g", "part", "nth", "key", "counts").groupBy("g")
            .applyInArrow(_peel_paths(groups == 1), _FOUND), "trie-paths"))
        width *= fan
        if groups == 1:
            break

    own = found[0].filter(F.col("kind") <= WAITING)
    merged = [f.filter(F.col("kind") <= WAITING) for f in found[1:]]
    nodes = own
    if merged:
        upper = merged[0]
        for more in merged[1:]:
            upper = upper.unionByName(more)
        ends = _hashed_in_order(found[0].filter(F.col("kind") == ENDS))
        upper = upper.drop("ends_sha256").join(ends, "id", "left").withColumn(
            "ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
        upper = written(upper.select(own.columns), "trie-upper")
        parents = upper.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("_parent"))
        size = parents.count() * (DIGEST + 24)
        parents = F.broadcast(parents) if size <= BROADCAST_BYTES else parents
        every = own.unionByName(upper)
        nodes = every.filter(F.col("kind") == NODE).select(*RESULT).unionByName(
            every.filter(F.col("kind") == WAITING).join(parents, "parent_id")
            .withColumn("parent_conv_id", F.col("_parent")).select(*RESULT))
    return nodes.select(*RESULT)


# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
