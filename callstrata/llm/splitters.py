"""Sharding by sampled splitters.

1. Every record gets the key (hash of its text, doc_id, row number): equal texts are
   neighbours, and no key repeats. The keyed rows are stored once.
2. A sample of keys is drawn, a record's chance growing with its size, and its
   quantiles become splitters of many narrow ranges.
3. Each range is measured over all its records. Shard limits are even cuts of the
   total size; a range with a limit inside is overfull and is subdivided at the exact
   record by running sums. Nothing is estimated in the result.

Key, sample and search are SQL expressions. What reaches the driver is bounded by
the number of ranges (65,536 at most), whatever the input.

Equal texts stay in one shard if their group (within one range) is at most
`whole_group` of a shard's share; larger groups are divided, so a hot group cannot
overfill a shard. The shards' sizes then differ by `whole_group` of a share plus
the largest record at most.

Defined results: a NULL text has no bytes, so size 8. Repeated rows are separate
records. NULL ids sort first. An empty table gives no rows; with fewer records than
shards some shards are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callstrata.llm.common import unit_hash, unused, written

MIN_RANGES, MAX_RANGES = 1024, 65_536
ROWS_PER_RANGE = 500_000
SAMPLES_PER_RANGE = 16
LOWEST = -(1 << 63)


def _search(key: Column, splitters: list[tuple[int, int, int]]) -> Column:
    """Number of splitters at or below the key, by binary search."""
    bits = len(splitters).bit_length()
    highest = (1 << 63) - 1
    padded = splitters + [(highest, highest, highest)] * ((1 << bits) - 1 - len(splitters))
    text = ",".join(f"struct({_long(h)} AS h,{_long(d)} AS d,{_long(r)} AS r)"
                    for h, d, r in padded) if padded else ""
    if not padded:
        return F.lit(0)
    array = F.expr(f"array({text})")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when(F.get(array, at + step - 1) <= key, at + step).otherwise(at))


def _long(value: int) -> str:
    return "(-9223372036854775807L - 1L)" if value == LOWEST else f"{value}L"


def _splitters(sample: list, ranges: int) -> list[tuple[int, int, int]]:
    """Even steps through the sorted sample. A group's first splitter is its start,
    so that a group is cut only where more than one splitter falls into it."""
    keys = sorted((r.h, r.d, r.r) for r in sample)
    found: list[tuple[int, int, int]] = []
    last = None
    for i in range(1, ranges):
        at = len(keys) * i // ranges
        if not keys or (found and keys[at] <= found[-1]):
            continue
        key = keys[at]
        cut = key if last == key[0] else (key[0], LOWEST, LOWEST)
        last = key[0]
        if not found or cut > found[-1]:
            found.append(cut)
    return found


def shard(docs: DataFrame, shards: int, whole_group: float = 0.01,
          carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of `docs` (doc_id, text),
    and the columns named in `carry`, whatever their names; those that clash with the
    result's are lengthened by underscores."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(F.col("text")).alias("h"), _carried(carry).alias("carried"))
        .withColumn("key", F.struct(
            "h", F.coalesce("doc_id", F.lit(LOWEST)).alias("d"),
            F.monotonically_increasing_id().alias("r"))).drop("h"),
        "shard-keys")
    total = keyed.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    if not total.n:
        return keyed.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"),
                            F.lit(0).cast("long").alias("slot"), *_released(carry))
    ranges = min(MAX_RANGES, max(MIN_RANGES, total.n // ROWS_PER_RANGE))
    # half by size, half by number: a range then bounds both its bytes and its rows
    chance = (F.col("size") / (2.0 * total.bytes) + 0.5 / total.n) * (
        ranges * SAMPLES_PER_RANGE)
    sample = keyed.filter(unit_hash(F.col("key.r")) < chance).select("key.*").collect()
    at = _search(F.col("key"), _splitters(sample, ranges))
    placed = written(keyed.withColumn("range", at), "shard-ranges")
    # one row per range; the window over them is bounded by MAX_RANGES rows
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (placed.groupBy("range").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
               .select("range", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bytes_before"),
                       F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before")))
    ordered = W.partitionBy("range").orderBy("key")
    group = W.partitionBy("range", "key.h")
    share = total.bytes / shards
    running = (placed
               .withColumn("ends", F.sum("size").over(ordered.rowsBetween(
                   W.unboundedPreceding, W.currentRow)))
               .withColumn("nth", F.row_number().over(ordered))
               .withColumn("group_bytes", F.sum("size").over(group))
               .withColumn("group_ends", F.max("ends").over(group))
               .join(F.broadcast(offsets), "range"))
    whole = F.col("group_bytes") <= F.lit(whole_group * share)
    middle = F.col("bytes_before") + F.when(
        whole, F.col("group_ends") - F.col("group_bytes") / 2).otherwise(
        F.col("ends") - F.col("size") / 2)
    assigned = written(
        running.select(
            "doc_id", "size", "text_crc32",
            F.least(F.floor(middle / F.lit(share)), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("nth") - 1).alias("nth"), "carried"), "shard-rows")
    first = assigned.groupBy("shard").agg(F.min("nth").alias("first"))
    return assigned.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("nth") - F.col("first")).cast("long").alias("slot"), *_released(carry))


RESULT = ("doc_id", "size", "text_crc32", "shard", "slot")


def _carried(carry: tuple[str, ...]):
    """Other columns as one, so that their names meet no others on the way."""
    return F.struct(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(carry)]) \
        if carry else F.lit(None).cast("int")


def _released(carry: tuple[str, ...]) -> list:
    """The same columns again; a name that the result has is lengthened."""
    names, found = list(RESULT), []
    for i, name in enumerate(carry):
        names.append(unused(names, name))
        found.append(F.col(f"carried.c{i}").alias(names[-1]))
    return found


def write_shards(docs: DataFrame, shards: int, path: str, rows_per_file: int = 100_000) -> None:
    """All columns of `docs` as Parquet, a folder per shard, files in slot order. Columns
    named as one of shard's results get a longer name."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    placed = shard(docs, shards, carry=("text", *others))
    part = unused(placed.columns, "part")
    (placed.withColumn(part, F.floor(F.col("slot") / rows_per_file))
     .repartition("shard", part).sortWithinPartitions("shard", "slot").drop(part)
     .write.partitionBy("shard").parquet(path))
