"""Benchmark decontamination by winnowing, in SQL expressions only.

Of every 8 consecutive 6-word grams the least hash is kept as a fingerprint, for
documents and for benchmark items. Two texts that share 13 words share 8 grams in a
row, so they share a fingerprint: no shared window is missed. Documents with a shared
fingerprint are looked at again: each hit is extended to the windows around it, which
are joined with the items' windows word by word, so hash collisions cannot add any.

An item of fewer than 13 words is one window of its own length. If there are such
items, grams of their lengths (12 lengths at most) are looked up in all documents.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in
lower case. A document word is hit if it lies in an occurrence of an item's window.

Defined results: a NULL or empty text has no words and is clean; an item without words
has no windows; an empty table of items leaves all clean. Items count by their distinct
item_id; windows of an item without id hit, but are not listed. Rows equal in doc_id
and text get the same result each. Documents of any length are handled whole: what is
gathered for one document is bounded by its number of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstrata.llm.common import checked_broadcast, written

WINDOW = 13
GRAM = 6
RUN = WINDOW - GRAM + 1
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    # lower() is right, and much faster, where there is nothing beyond ASCII
    plain = F.octet_length(text) == F.char_length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(low, SEPARATORS), ""),
                      F.array().cast("array<string>"))


def _places(n: Column) -> Column:
    """0 .. n - 1, empty if n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def grams(hashes: Column, size: int) -> Column:
    """Hash of each run of `size` words, from the words' hashes."""
    starts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - size + 1, F.lit(0)))
    return F.transform(starts, lambda first, i: F.xxhash64(
        first, *(F.get(hashes, i + k) for k in range(1, size))))


def fingerprints(text_words: Column) -> Column:
    """The least gram hash of each run of grams, without repetitions."""
    def least(found):
        return F.array_distinct(F.transform(
            _places(F.size(found) - RUN + 1),
            lambda i: F.array_min(F.slice(found, i + 1, F.lit(RUN)))))

    return _let(F.transform(text_words, lambda w: F.xxhash64(w)),
                lambda hashes: _let(grams(hashes, GRAM), least))


def _windows(text_words: Column, starts: Column, size: int) -> Column:
    return F.transform(starts, lambda s: F.struct(
        s.cast("int").alias("start"), F.lit(size).alias("length"),
        F.array_join(F.slice(text_words, s + 1, F.lit(size)), " ").alias("window")))


def _item_windows(items: DataFrame) -> DataFrame:
    """item_id, length, window: each distinct window of each item."""
    split = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    full = _windows(F.col("w"), _places(F.size("w") - WINDOW + 1), WINDOW)
    short = F.array(F.struct(F.lit(0).alias("start"), F.size("w").alias("length"),
                             F.array_join("w", " ").alias("window")))
    return (split.select("item_id", F.explode(
        F.when(F.size("w") >= WINDOW, full).otherwise(short)).alias("x"))
        .select("item_id", "x.length", "x.window").distinct())


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of
    `docs` (doc_id, text), against `items` (item_id, text)."""
    return _judged(docs, items).drop("text_hash")


def _judged(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The same, and text_hash, which tells rows of one doc_id, or without any, apart."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    key = ["doc_id", "text_hash"]
    windows = written(_item_windows(items), "item-windows")
    tests = written(
        items.select(F.explode(fingerprints(words(F.col("text")))).alias("mark")).distinct(),
        "item-fingerprints")
    short = [r.length for r in windows.filter(F.col("length") < WINDOW)
             .select("length").distinct().collect()]

    first = written(
        docs.select(*key, words(F.col("text")).alias("w"))
        .select(*key, F.size("w").cast("long").alias("n_words"),
                fingerprints(F.col("w")).alias("marks")), "document-fingerprints")
    hits = (first.select(*key, F.explode("marks").alias("mark"))
            .join(checked_broadcast(tests), "mark")
            .select(*key, "mark").distinct()
            .groupBy(*key).agg(F.collect_set("mark").alias("hits")))
    hits = written(hits, "fingerprint-hits")

    extended = (_rejoined(docs, hits, key)
                .select(*key, "hits", words(F.col("text")).alias("w"))
                .withColumn("starts", _starts(F.col("w"), F.col("hits")))
                .select(*key, F.explode(_windows(F.col("w"), F.col("starts"), WINDOW)).alias("x")))
    for length in sorted(short):
        extended = extended.unionByName(_short_candidates(docs, windows, length, key))
    found = (extended.select(*key, "x.start", "x.length", "x.window")
             .join(checked_broadcast(windows.select("length", "window").distinct()),
                   ["length", "window"]))
    found = written(found.distinct(), "window-hits")

    spans = found.groupBy(*key).agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"))
    n_hit = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda seen, s: F.struct(
            F.greatest(seen.end, s.start + s.length).alias("end"),
            (seen.n + F.greatest(
                s.start + s.length - F.greatest(seen.end, s.start), F.lit(0))).alias("n")),
        lambda seen: seen.n.cast("long"))
    hit = spans.select(*key, n_hit.alias("n_hit"))
    listed = (found.select(*key, "length", "window").distinct()
              .join(checked_broadcast(windows.filter("item_id IS NOT NULL")),
                    ["length", "window"])
              .groupBy(*key).agg(F.sort_array(F.collect_set(
                  F.col("item_id").cast("string"))).alias("items")))
    result = hit.join(listed, _same(hit, listed, key), "left").select(
        *(hit[c] for c in key), "n_hit", "items")
    rows = first.select(*key, "n_words")
    return (rows.join(result, _same(rows, result, key), "left")
            .select(*(rows[c] for c in key), "n_words",
                    F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256)
                    .alias("items_sha256"))
            .withColumn("contaminated",
                        (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def _same(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    """Equal keys; a NULL doc_id equals itself."""
    return left[key[0]].eqNullSafe(right[key[0]]) & (left[key[1]] == right[key[1]])


def _rejoined(docs: DataFrame, hits: DataFrame, key: list[str]) -> DataFrame:
    """Texts of the rows in `hits`, with the columns of `hits`."""
    narrow = checked_broadcast(hits, 100_000)
    return docs.join(narrow, _same(docs, hits, key)).select(
        *(docs[c] for c in key), "text", *(hits[c] for c in hits.columns if c not in key))


def _starts(text_words: Column, hits: Column) -> Column:
    """Starts of the full windows that contain a gram among `hits`."""
    last = F.size(text_words) - WINDOW

    def around(found):
        at = F.filter(_places(F.size(found)),
                      lambda i: F.array_contains(hits, F.get(found, i)))
        near = F.transform(at, lambda p: F.sequence(
            F.greatest(F.least(p, last) - RUN + 1, F.lit(0)), F.least(p, last)))
        return F.array_distinct(F.flatten(near))

    return _let(F.transform(text_words, lambda w: F.xxhash64(w)),
                lambda hashes: _let(grams(hashes, GRAM), around))


def _short_candidates(docs: DataFrame, windows: DataFrame, length: int,
                      key: list[str]) -> DataFrame:
    """Occurrences, by hash, of short items of one length."""
    spread = lambda w: grams(F.transform(w, lambda x: F.xxhash64(x)), length)
    wanted = (windows.filter(F.col("length") == length)
              .select(F.get(spread(F.split("window", " ")), F.lit(0)).alias("mark")).distinct())
    gram = docs.select(*key, words(F.col("text")).alias("w")).select(
        *key, F.posexplode(_let(F.col("w"), spread)).alias("start", "mark"))
    near = written(gram.join(checked_broadcast(wanted), "mark")
                   .groupBy(*key).agg(F.collect_set("start").alias("starts")), "short-hits")
    return (_rejoined(docs, near, key)
            .select(*key, "starts", words(F.col("text")).alias("w"))
            .select(*key, F.explode(_windows(F.col("w"), F.col("starts"), length)).alias("x")))


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows that are not contaminated, with all their columns. Rows that share a
    doc_id, or have none, are judged each by its own text."""
    bad = written(
        _judged(docs.select("doc_id", "text"), items).filter("contaminated")
        .select(F.col("doc_id").alias("_bad"), F.col("text_hash").alias("_bad_text"))
        .distinct(), "contaminated")
    return docs.join(checked_broadcast(bad),
                     docs["doc_id"].eqNullSafe(bad["_bad"])
                     & (F.xxhash64(docs["text"]) == bad["_bad_text"]), "left_anti")
