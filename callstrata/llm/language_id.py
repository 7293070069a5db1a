"""Language ID: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams per language are summed by Spark over a bounded sample of labelled
rows; the matrix of log probabilities (languages x 32,768) is broadcast to the
workers, which score batches of whole texts with numpy gathers and segment sums.

Text is lower-cased; each run of other characters than letters becomes one space.

Defined results: a NULL text, or one without a letter, is `und` with score 0. With no
labelled rows every text is `und`. Ties go to the first language in sorted order.
Repeated rows each get a result. Very long texts are scored whole, in one pass.
Languages are those of the sample: their number, not that of documents, bounds the
matrix.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstrata.llm.common import bounded_sample, crc32_remainder, unused

#: Labelled rows to learn from, for each language.
SAMPLE_PER_LANGUAGE = 3000
BUCKETS = 1 << 15
SIZES = (2, 3)
#: n-grams' worth of evidence that a score rests on at most; longer texts are scaled down
EVIDENCE = 60.0
BATCH_CHARS = 1 << 20
PART_ROWS = 1000
_FACTORS = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, text by text, and where each text's buckets end."""
    joined = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
              for t in texts]
    lengths = np.array([len(x) for x in joined])
    chars = np.concatenate(joined) if joined else np.zeros(0, np.uint32)
    owner = np.repeat(np.arange(len(texts)), lengths)
    letter = _letter_table()[chars]
    chars = np.where(letter, chars, np.uint32(32))
    keep = np.ones(len(chars), bool)
    keep[1:] = letter[1:] | letter[:-1] | (owner[1:] != owner[:-1])
    chars, owner = chars[keep], owner[keep]
    found, owners = [], []
    for size in SIZES:
        n = max(len(chars) - size + 1, 0)
        mixed = np.full(n, size, np.uint32)
        for i in range(size):
            mixed = mixed * np.uint32(31) + chars[i:i + n] * _FACTORS[i]
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(2246822519)
        inside = owner[:n] == owner[size - 1:size - 1 + n]
        found.append((mixed >> np.uint32(17))[inside])
        owners.append(owner[:n][inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
    return np.concatenate(found)[order], ends


def _slices(texts: list[str | None]):
    """(first, texts) in pieces of about BATCH_CHARS; a NULL is an empty text."""
    start, size, part = 0, 0, []
    for text in texts:
        part.append(text or "")
        size += len(part[-1])
        if size >= BATCH_CHARS:
            yield start, part
            start, size, part = start + len(part), 0, []
    if part:
        yield start, part


def in_parts(batches, rows: int = PART_ROWS):
    """Record batches of few rows: whole texts of one part only are copied."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def _count(batches):
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, texts in _slices(batch.column("text").to_pylist()):
            buckets, ends = _features(texts)
            starts = np.concatenate([[0], ends[:-1]])
            for i, (a, b) in enumerate(zip(starts, ends)):
                seen = counts.setdefault(langs[first + i], np.zeros(BUCKETS, np.int64))
                seen += np.bincount(buckets[a:b], minlength=BUCKETS)
    for lang, seen in counts.items():
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([lang] * len(some), pa.string()),
            "bucket": pa.array(some, pa.int64()), "n": pa.array(seen[some], pa.int64())})


def fit(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE
        ) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities, from rows (doc_id, text, lang)."""
    sample = bounded_sample(
        labelled.filter("lang IS NOT NULL AND text IS NOT NULL"),
        F.coalesce(F.col("doc_id"), F.lit(0)), per_language, salt=9, strata="lang")
    counted = (sample.select("text", "lang").repartition(24)
               .mapInArrow(_count, "lang string, bucket bigint, n bigint")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))).toArrow()
    langs = sorted(set(counted.column("lang").to_pylist()))
    matrix = np.zeros((len(langs), BUCKETS))
    at = {lang: i for i, lang in enumerate(langs)}
    rows = np.array([at[x] for x in counted.column("lang").to_pylist()], np.int64)
    matrix[rows, counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    matrix = (matrix + 0.5) / (matrix.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
    return langs, np.log(matrix).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], language: str = "lang_pred",
            sure: str = "score") -> DataFrame:
    """All columns of `docs`, and the two named ones; from `text` alone."""
    langs, matrix = model
    names = [*docs.columns, language, sure]
    if len({n.lower() for n in names}) != len(names):
        raise ValueError(f"docs must not have columns {language} or {sure}")
    shared = docs.sparkSession.sparkContext.broadcast(matrix)

    def score(batches):
        logp = shared.value
        for batch in in_parts(batches):
            texts = batch.column("text").to_pylist()
            best, scores = [], []
            for _, part in _slices(texts):
                buckets, ends = _features(part)
                counts = np.diff(ends, prepend=0)
                has_letter = np.array([any(map(str.isalpha, t)) for t in part], bool)
                sums = np.zeros((len(langs), len(part)))
                for i in range(len(langs)):
                    total = np.concatenate(
                        [[0.0], np.cumsum(logp[i][buckets], dtype=np.float64)])
                    sums[i] = total[ends] - total[ends - counts]
                if langs:
                    scaled = sums * np.minimum(1.0, EVIDENCE / np.maximum(counts, 1))
                    odds = np.exp(scaled - scaled.max(axis=0))
                    odds /= odds.sum(axis=0)
                    top = odds.argmax(axis=0)
                    best += [langs[k] if ok else "und" for k, ok in zip(top, has_letter)]
                    scores += list(np.where(has_letter, odds.max(axis=0), 0.0))
                else:
                    best += ["und"] * len(part)
                    scores += [0.0] * len(part)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, pa.string()), pa.array(scores, pa.float64())],
                names=names)

    schema = T.StructType([*docs.schema.fields, T.StructField(language, T.StringType()),
                           T.StructField(sure, T.DoubleType())])
    return docs.mapInArrow(score, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score. Learns from rows whose crc32(doc_id) mod 3
    is not 1; a row without doc_id counts as not held out but is not learned from."""
    remainder = crc32_remainder(F.col("doc_id"), 3)
    model = fit(docs.select("doc_id", "text", "lang").filter(remainder != 1))
    return predict(docs.select(
        "doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "text"),
        model).drop("text")


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows with a recognised language; `und` and unsure ones go."""
    remainder = crc32_remainder(F.col("doc_id"), 3)
    model = fit(docs.select("doc_id", "text", "lang").filter(remainder != 1))
    language, sure = unused(docs.columns, "lang_pred"), unused(docs.columns, "score")
    return (predict(docs, model, language, sure)
            .filter((F.col(language) != "und") & (F.col(sure) >= least))
            .drop(language, sure))


# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
