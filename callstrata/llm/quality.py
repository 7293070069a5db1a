"""Quality classifier: averaged embeddings of words and their character n-grams.

Every word (a run of other characters than white space, case and signs kept) has a
hashed vector, and so have each character n-gram of it and a word's repetition. A document is the mean of all
these vectors; a softmax over two classes follows. Vectors and output weights are
learned together by stochastic gradient descent in numpy.

Learning uses a bounded sample of labelled rows: Spark turns their whole texts into
(feature, weight) lists, the driver runs the descent on those. Scoring runs over all
rows: softmax over two classes needs one number per feature, and a word's numbers are
kept in a bounded cache in each worker.

Defined results: a NULL or empty text, or one of white space only, has the mean of no
vectors, so its score is that of the bias alone. Without labels of both classes the
score is the share of label 1 seen (0.5 if none). Repeated rows each get a result.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstrata.llm.common import bounded_sample, crc32_remainder, opened, share

#: Labelled rows to learn from.
SAMPLE = 4000
BUCKETS = 1 << 16
#: a word equal to the one before it adds this feature
AGAIN = BUCKETS - 1
DIMENSIONS = 12
NGRAMS = (1, 2, 3, 4)
EPOCHS, RATE, BATCH, SEED = 12, 60.0, 32, 10
CACHE = 600_000
THRESHOLD = 0.3


def word_features(word: str) -> list[int]:
    """Bucket of the word and of each n-gram of it, its ends marked."""
    framed = f"<{word}>"
    if framed.isascii():  # bytes are characters
        pieces = [data := framed.encode()]
        for n in NGRAMS:
            pieces += [data[i:i + n] for i in range(len(data) - n + 1)]
    else:
        pieces = [framed.encode("utf-8", "surrogatepass")]
        for n in NGRAMS:
            pieces += [framed[i:i + n].encode("utf-8", "surrogatepass")
                       for i in range(len(framed) - n + 1)]
    return [h % AGAIN for h in map(zlib.crc32, pieces)]


def _sparse(batches):
    """The documents' features with their shares."""
    cache: dict[str, np.ndarray] = {}
    again = np.array([AGAIN], np.int64)
    for batch in batches:
        labels = batch.column("quality").to_pylist()
        out = []
        for text in batch.column("text").to_pylist():
            found, before = [np.zeros(0, np.int64)], None
            for word in (text or "").split():
                features = cache.get(word)
                if features is None:
                    if len(cache) >= CACHE:
                        cache.clear()
                    features = cache[word] = np.array(word_features(word), np.int64)
                found.append(features)
                if word == before:
                    found.append(again)
                before = word
            counts = np.bincount(np.concatenate(found), minlength=BUCKETS)
            some = np.flatnonzero(counts)
            out.append((some.astype("<u4").tobytes(),
                        (counts[some] / max(counts.sum(), 1.0)).astype("<f4").tobytes()))
        yield pa.RecordBatch.from_pydict({
            "quality": pa.array(labels, pa.int32()),
            "ids": pa.array([a for a, _ in out], pa.binary()),
            "shares": pa.array([b for _, b in out], pa.binary())})


def fit(labelled: DataFrame, limit: int = SAMPLE) -> tuple[np.ndarray, float]:
    """A number per feature and a bias: the difference of the classes' outputs.

    `labelled`: rows (doc_id, text, quality). The sample is put in an order that
    depends on its rows alone, so the same rows give the same model."""
    known = labelled.filter("quality IN (0, 1)")
    sample = bounded_sample(known, F.coalesce(F.col("doc_id"), F.lit(0)), limit, salt=10)
    rows = (sample.select("text", F.col("quality").cast("int").alias("quality")).repartition(24)
            .mapInArrow(_sparse, "quality int, ids binary, shares binary")).toArrow()
    y = rows.column("quality").to_numpy().astype(np.int64)
    ids = [np.frombuffer(x, "<u4").astype(np.int64) for x in rows.column("ids").to_pylist()]
    shares = [np.frombuffer(x, "<f4") for x in rows.column("shares").to_pylist()]
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    first = sorted(range(len(y)), key=lambda i: (y[i], ids[i].tobytes(), shares[i].tobytes()))
    random = np.random.default_rng(SEED)
    vectors = random.normal(0, 1.0 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.log(np.bincount(y, minlength=2) / len(y)).astype(np.float32)
    steps, done = EPOCHS * (-(-len(y) // BATCH)), 0
    for _ in range(EPOCHS):
        order = np.array(first)[random.permutation(len(first))]
        for at in range(0, len(order), BATCH):
            members = order[at:at + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            means = np.stack([shares[i] @ vectors[ids[i]] for i in members])
            logits = means @ output + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            odds /= odds.sum(axis=1, keepdims=True)
            odds[np.arange(len(members)), y[members]] -= 1.0
            back = odds @ output.T
            output -= rate / 60 / len(members) * (means.T @ odds)
            bias -= rate / 600 / len(members) * odds.sum(axis=0)
            for row, i in enumerate(members):
                vectors[ids[i]] -= np.outer(shares[i] * (rate / len(members)), back[row])
    weights = vectors @ (output[:, 1] - output[:, 0])
    return weights.astype(np.float32), float(bias[1] - bias[0])


class WordScores(dict):
    """Sum and number of a word's features. It is broadcast: what it keeps serves all
    tasks of a worker."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __reduce__(self):
        return WordScores, (self.weights,)

    def __missing__(self, word: str) -> tuple[float, int]:
        if not self:
            self.each = self.weights.tolist()
        elif len(self) >= CACHE:
            self.clear()
        features = word_features(word)
        found = self[word] = (sum(map(self.each.__getitem__, features)), len(features))
        return found


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """All columns of `docs` but `text`, and score."""
    weights, bias = model
    shared = share(docs.sparkSession, WordScores(weights))
    kept = [c for c in docs.columns if c != "text"]

    def run(batches):
        known = opened(shared)
        weight_again = float(known.weights[AGAIN])
        for batch in batches:
            scores = []
            for text in batch.column("text").to_pylist():
                total, n, before = 0.0, 0, None
                for word in (text or "").split():
                    add, more = known[word]
                    total += add
                    n += more
                    if word == before:
                        total += weight_again
                        n += 1
                    before = word
                logit = bias + (total / n if n else 0.0)
                scores.append(1.0 / (1.0 + np.exp(-logit)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(scores, pa.float64())],
                names=[*kept, "score"])

    schema = T.StructType([*docs.select(*kept).schema.fields,
                           T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs` (doc_id, text).

    Labels of one id that differ are all learned from; NULL labels and labels without
    a document are not."""
    remainder = crc32_remainder(F.col("doc_id"), 5)
    labelled = (docs.select("doc_id", "text")
                .join(labels.filter("quality IN (0, 1)").select("doc_id", "quality"), "doc_id")
                .filter(remainder != 0))
    return score(
        docs.select("doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"),
                    "text"), fit(labelled)
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
