"""Secret scans: base patterns and a character convolutional network.

Base findings are those of three patterns over the whole text. Candidates are the runs
of 16 or more characters of keys and digests. What base findings leave of a candidate,
in stretches of 16 or more characters, is judged with the characters around it: a
network in numpy (character embedding, one convolution, pooling over the window, two
outputs). A stretch of more than 48 characters is judged in pieces of 48, every 16
characters, so all of it is seen, any 32 neighbours together.

The network learns from all labelled findings of all documents: pieces of candidates that
a base pattern finds, or not. They are dealt out to blocks by hash; in each round every
block takes one pass over its findings, and the blocks' weights are averaged by size. Base
patterns know few looks, so findings are varied: in each block `VARIED` of label 1 get a value drawn anew from
another alphabet and of another length, some with a prefix, and stand where findings of
label 0 stood; as many of label 0 become what is long but no secret: words run together,
paths, host names, numbers in groups, identifiers in five groups of digits (UUIDs), made
of words and digits around the findings. In half of the examples what stands left of the
piece is blanked, so that its look alone must do. On all findings of a quarter of
the documents, not learned from, and on varied findings of looks that are not learned from
either, its outputs are calibrated (temperature) and the threshold is set to the largest
one that keeps the wanted recall; the precision there is logged. For that they are counted
by label and log odds, in steps of a thousandth. Pieces at or above it are added as
`model` spans, overlapping ones as one.

Defined results: a NULL text counts as empty; it and texts without findings have empty
spans. Positions are code points, the end exclusive. Without labelled findings of both
sorts nothing is added, with a warning; if they are too few to hold some out, the
threshold is set on the ones learned from, with a warning. Texts are read whole. Repeated
rows each get a result.
"""

from __future__ import annotations

import logging
import re
import sys
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.llm.common import opened, share
from callstrata.session import fresh_path
from callstrata.sources.files import drop_folder

#: A block has about twice as many findings.
BLOCK_FINDINGS = 2_000
RECALL = 0.98
#: Varied examples of each label in a block.
VARIED = 3_000
#: Log odds are counted in steps of one part of these, up to a limit.
STEPS, LIMIT = 1_000, 100

# The base patterns, in the order of their kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ASSIGN_LENGTH = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 20
HEX = re.compile(r"[0-9a-f]+")
HEX_LENGTH = 24
KINDS = ("assign", "access", "hex", "model")

LEAST = 16
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_KEYWORDS = ("passw", "secret", "token", "key")
LEFT, HEAD, TAIL, RIGHT = 24, 32, 16, 8
WIDTH = LEFT + HEAD + TAIL + RIGHT
STEP = 16
#: Windows judged together.
TOGETHER = 4096
SYMBOLS, EMBEDDED, KERNEL, FILTERS = 128, 8, 5, 32
EPOCHS, BATCH, RATE, SEED = 8, 64, 0.01, 4


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int]]]:
    """Base findings (start, end, kind), sorted, and candidates (start, end)."""
    found, candidates = [], []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
                  if len(m[2]) >= ASSIGN_LENGTH]
    for run in _RUN.finditer(text):  # access keys and digests lie within such runs
        start, end = run.span()
        if "AKIA" in run[0]:
            found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text, start, end)
                      if m.end() - m.start() >= ACCESS_LENGTH]
        if end - start >= HEX_LENGTH:
            found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text, start, end)
                      if m.end() - m.start() >= HEX_LENGTH]
        candidates.append((start, end))
    found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return found, candidates


def merged(found: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Disjoint, sorted spans that cover what `found` (sorted) covers."""
    out: list[tuple[int, int]] = []
    for s, e, _ in found:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _within(part: tuple[int, int], spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What lies in `part` of disjoint, sorted spans."""
    out = []
    for s, e in spans[bisect_right(spans, part[0], key=lambda x: x[1]):]:
        if s >= part[1]:
            break
        out.append((max(s, part[0]), min(e, part[1])))
    return out


def free(candidate: tuple[int, int], spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The stretches of a candidate, long enough for one, outside of `spans`."""
    out, at = [], candidate[0]
    for s, e in [*_within(candidate, spans), (candidate[1], candidate[1])]:
        if s - at >= LEAST:
            out.append((at, s))
        at = e
    return out


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """Overlapping pieces, as long as a window holds, of all from start to end."""
    size = HEAD + TAIL
    if end - start <= size:
        return [(start, end)]
    return [(s, s + size) for s in (*range(start, end - size, STEP), end - size)]


def labelled(candidate: tuple[int, int], spans: list[tuple[int, int]]
             ) -> list[tuple[tuple[int, int], int]]:
    """Pieces of a candidate, and whether base findings meet them. Of a candidate in
    several pieces those are left out that hold less than half of, and only a part of, a
    finding."""
    parts, out = pieces(*candidate), []
    for part in parts:
        inside = _within(part, spans)
        if not inside:
            out.append((part, 0))
        elif (len(parts) == 1 or 2 * sum(e - s for s, e in inside) >= part[1] - part[0]
              or any(x in spans for x in inside)):
            out.append((part, 1))
    return out


def window(text: str, start: int, end: int, low: int = 0, high: int | None = None) -> bytes:
    """The characters a piece is judged by, none before `low` or from `high` on; 0 pads,
    1 is beyond ASCII."""
    left = text[max(start - LEFT, low):start].rjust(LEFT, "\0")
    body = text[start:end].ljust(HEAD + TAIL, "\0")
    right = text[end:end + RIGHT if high is None else min(end + RIGHT, high)].ljust(RIGHT, "\0")
    shown = left + body + right
    if shown.isascii():
        return shown.encode()
    return bytes(ord(c) if ord(c) < SYMBOLS else 1 for c in shown)


class Network:
    """Embedding, convolution, rectifier, largest value per filter, two outputs."""

    def __init__(self):
        random = np.random.default_rng(SEED)
        self.weights = {
            "embed": random.normal(0, 0.3, (SYMBOLS, EMBEDDED)),
            "place": random.normal(0, 0.1, (WIDTH, EMBEDDED)),
            "conv": random.normal(0, 0.2, (KERNEL * EMBEDDED, FILTERS)),
            "conv_bias": np.zeros(FILTERS),
            "out": random.normal(0, 0.2, (FILTERS, 2)),
            "out_bias": np.zeros(2)}
        self.temperature, self.threshold = 1.0, 2.0
        #: Share of label 1 among the calibrating findings at or above the threshold.
        self.precision = float("nan")

    def _forward(self, x: np.ndarray):
        w = self.weights
        seen = w["embed"][x] + w["place"]
        rows = np.lib.stride_tricks.sliding_window_view(seen, KERNEL, axis=1)
        rows = rows.transpose(0, 1, 3, 2).reshape(len(x), WIDTH - KERNEL + 1, -1)
        hidden = rows @ w["conv"] + w["conv_bias"]
        top = hidden.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(hidden, top[:, None, :], axis=1)[:, 0], 0)
        return rows, top, pooled, pooled @ w["out"] + w["out_bias"]

    def logits(self, windows: list[bytes]) -> np.ndarray:
        """Log odds of a secret, before calibration."""
        parts = [np.zeros(0)]
        for at in range(0, len(windows), 512):
            x = np.frombuffer(b"".join(windows[at:at + 512]), np.uint8).reshape(-1, WIDTH)
            out = self._forward(x)[3]
            parts.append(out[:, 1] - out[:, 0])
        return np.concatenate(parts)

    def probabilities(self, windows: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(windows) / self.temperature, -50, 50)))

    def state(self) -> np.ndarray:
        """What a round starts from: weights, two moments of each, number of steps."""
        return np.concatenate([*(w.ravel() for w in self.weights.values()),
                               np.zeros(2 * sum(w.size for w in self.weights.values()) + 1)])

    def take(self, state: np.ndarray) -> tuple[dict, dict, float]:
        """Weights from a state; returns the moments and the number of steps."""
        sets, at = [], 0
        for _ in range(3):
            part = {}
            for name, old in self.weights.items():
                part[name] = state[at:at + old.size].reshape(old.shape).copy()
                at += old.size
            sets.append(part)
        self.weights = sets[0]
        return sets[1], sets[2], float(state[at])

    def learn(self, windows: list[bytes], labels: np.ndarray) -> None:
        state = self.state()
        for epoch in range(EPOCHS):
            state = self.learn_once(windows, labels, state, epoch)

    def learn_once(self, windows: list[bytes], labels: np.ndarray, state: np.ndarray,
                   epoch: int) -> np.ndarray:
        """One pass of stochastic gradient descent with step sizes per weight (Adam)."""
        random = np.random.default_rng([SEED, epoch])
        data = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WIDTH)
        mean, square, step = self.take(state)
        order = random.permutation(len(data))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            x = data[pick].copy()
            x[random.random(len(pick)) < 0.5, :LEFT] = 0
            step += 1
            for name, slope in self._slopes(x, labels[pick]).items():
                mean[name] = 0.9 * mean[name] + 0.1 * slope
                square[name] = 0.99 * square[name] + 0.01 * slope ** 2
                self.weights[name] -= (RATE * mean[name] / (1 - 0.9 ** step) / (
                    np.sqrt(square[name] / (1 - 0.99 ** step)) + 1e-8))
        return np.concatenate([part[name].ravel() for part in (self.weights, mean, square)
                               for name in self.weights] + [[step]])

    def _slopes(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, n = self.weights, len(x)
        rows, top, pooled, logits = self._forward(x)
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        odds[np.arange(n), y] -= 1
        odds /= n
        back = (odds @ w["out"].T) * (pooled > 0)
        picked = rows[np.arange(n)[:, None], top]                    # n, filter, kernel row
        slopes = {"out": pooled.T @ odds, "out_bias": odds.sum(axis=0),
                  "conv": np.einsum("nfk,nf->kf", picked, back), "conv_bias": back.sum(axis=0)}
        per_row = np.einsum("nf,kf->nfk", back, w["conv"]).reshape(n, FILTERS, KERNEL, EMBEDDED)
        at = top[:, :, None] + np.arange(KERNEL)
        embed, place = np.zeros_like(w["embed"]), np.zeros_like(w["place"])
        np.add.at(embed, x[np.arange(n)[:, None, None], at], per_row)
        np.add.at(place, at, per_row)
        return slopes | {"embed": embed, "place": place}

    def calibrate(self, windows: list[bytes], labels: np.ndarray, recall: float) -> None:
        self.set_threshold(self.logits(windows), labels, np.ones(len(labels)), recall)

    def set_threshold(self, raw: np.ndarray, labels: np.ndarray, counts: np.ndarray,
                      recall: float) -> None:
        """Temperature and threshold from log odds, each with a number of findings."""
        def loss(t):
            return (counts * np.logaddexp(0, np.where(labels == 1, -raw, raw) / t)).sum()

        self.temperature = float(min(np.geomspace(0.25, 8, 41), key=loss))
        odds = 1 / (1 + np.exp(-np.clip(raw / self.temperature, -50, 50)))
        order = np.argsort(odds, kind="stable")
        sure = order[labels[order] == 1]
        if len(sure):
            up_to = counts[sure].cumsum()
            at = np.searchsorted(up_to, int((1 - recall) * up_to[-1]), side="right")
            self.threshold = float(odds[sure[at]])
            above = odds >= self.threshold
            self.precision = float(counts[above & (labels == 1)].sum() / counts[above].sum())


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: Alphabets of varied values; those with the name "held" only calibrate.
LOOKS = {
    "lower hex": _DIGITS + "abcdef", "upper hex": _DIGITS + "ABCDEF",
    "letters and digits": _DIGITS + _LOWER + _LOWER.upper(),
    "base64": _DIGITS + _LOWER + _LOWER.upper() + "+/",
    "lower letters and digits": _DIGITS + _LOWER,
    "held: base64 for addresses": _DIGITS + _LOWER + _LOWER.upper() + "-_",
    "held: upper letters and digits": _DIGITS + _LOWER.upper(),
}


def _body(value: str) -> bytes:
    return value[:HEAD + TAIL].ljust(HEAD + TAIL, "\0").encode()


def varied(windows: list[bytes], labels: np.ndarray, held: bool, n: int, seed: int
           ) -> tuple[list[bytes], np.ndarray]:
    """`n` examples of each label, made of the findings given: values of other looks in the
    places of findings of label 0, and long words, paths, names and numbers."""
    random = np.random.default_rng(seed)
    places = [w for w, y in zip(windows, labels) if y == 0] or [bytes(WIDTH)]
    words = sorted({m.decode() for w in windows for m in
                    re.findall(rb"[A-Za-z]{3,}", w[:LEFT] + b" " + w[-RIGHT:])}) or ["word"]
    looks = [a for name, a in LOOKS.items() if name.startswith("held") == held]

    def word() -> str:
        return words[random.integers(len(words))]

    def digits(k: int) -> str:
        return "".join(random.choice(list(_DIGITS), k))

    def secret() -> str:
        alphabet = list(looks[random.integers(len(looks))])
        value = "".join(random.choice(alphabet, random.integers(20, 49)))
        if random.random() < 0.25:
            value = word().lower()[:5] + "_-"[random.integers(2)] + value
        if alphabet[-1] == "/" and random.random() < 0.5:
            value += "="
        return value

    def plain() -> str:
        kind, some = random.integers(10), [word() for _ in range(random.integers(3, 8))]
        if kind == 0:
            return "".join(some)
        if kind == 1:
            return "".join(w.capitalize() for w in some)
        if kind in (2, 3, 4):
            joined = ("/", "_.-"[random.integers(3)], ".")[kind - 2].join(
                w.lower() if random.random() < 0.8 else w for w in some)
            return joined + (digits(random.integers(1, 5)) if random.random() < 0.4 else "")
        if kind == 5:
            return "".join(digits(4) + "-."[random.integers(2)] * (random.random() < 0.5)
                           for _ in range(random.integers(4, 6)))
        if kind == 6:
            parts = ["".join(random.choice(list(_DIGITS + "abcdef"), k)) for k in (8, 4, 4, 4, 12)]
            value = "-".join(parts)
            return value.upper() if random.random() < 0.2 else value
        if kind in (7, 8):
            return digits(random.integers(LEAST, 21))
        return f"{word().lower()}={digits(random.integers(1, 9))}.{word().lower()}/{word()}"

    made, answers = [], []
    for label, value in ((1, secret), (0, plain)):
        for _ in range(n):
            text, place = value(), places[random.integers(len(places))]
            while len(text) < LEAST:
                text += word()
            made.append(place[:LEFT] + _body(text) + (
                place[-RIGHT:] if len(text) < HEAD + TAIL else text[HEAD + TAIL:][:RIGHT].ljust(
                    RIGHT, "\0").encode()))
            answers.append(label)
    return made, np.array(answers, np.int64)


def _labelled_findings(docs: DataFrame) -> DataFrame:
    """key, label, seen: all distinct labelled findings, with repeats of equal rows."""
    def find(batches):
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column("key").to_pylist(),
                                 batch.column("text").to_pylist()):
                found, candidates = scan(text)
                spans = merged(found)
                rows += [(key, y, window(text, *part))
                         for c in candidates for part, y in labelled(c, spans)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.binary())], names=["key", "label", "seen"])

    return docs.filter("text IS NOT NULL").select(
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("key"), "text"
    ).mapInArrow(find, "key bigint, label int, seen binary")


def _examples(block: pa.Table, held: bool, n: int) -> tuple[list[bytes], np.ndarray]:
    """The findings of a block in order, and `n` varied ones of each label."""
    rows = sorted(zip(block.column("key").to_pylist(), block.column("seen").to_pylist(),
                      block.column("label").to_pylist()))
    windows, labels = [r[1] for r in rows], np.array([r[2] for r in rows], np.int64)
    more, known = varied(windows, labels, held, n, SEED + block.column("block")[0].as_py())
    return windows + more, np.concatenate([labels, known])


def fit(docs: DataFrame, findings: int = BLOCK_FINDINGS, recall: float = RECALL) -> Network:
    """A network from all labelled findings of `docs`, in blocks of about twice `findings`."""
    spark, schema = docs.sparkSession, "key bigint, label int, seen binary"
    path = fresh_path(spark, "labelled-findings")
    try:  # findings in clear text stay no longer than they are needed
        _labelled_findings(docs).distinct().write.parquet(path)
        return _fitted(spark.read.schema(schema).parquet(path), findings, recall)
    finally:
        drop_folder(spark, path)


def _fitted(known: DataFrame, findings: int, recall: float) -> Network:
    network, log = Network(), logging.getLogger(__name__)
    is_held = F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(4)) == 0
    counts = {(r.held, r.label): r["count"] for r in known.groupBy(
        is_held.alias("held"), "label").count().collect()}
    if len({label for _, label in counts}) < 2:
        log.warning("no labelled findings of both sorts: no model spans")
        return network
    if len(counts) == 4:
        parts = {held: (known.filter(is_held == held), counts[held, 0] + counts[held, 1])
                 for held in (False, True)}
    else:
        log.warning("too few labelled findings to hold some out")
        parts = dict.fromkeys((False, True), (known, sum(counts.values())))

    def blocks(held: bool) -> DataFrame:
        rows, size = parts[held]
        number = max(1, round(size / (2 * findings)))
        # as many partitions as blocks: few bytes, but much work
        return rows.withColumn("block", F.pmod(F.xxhash64("key", "seen"), F.lit(number)).cast(
            "int")).repartition(min(number, 10_000), "block").groupBy("block")

    learning, state = blocks(False), network.state()
    for epoch in range(EPOCHS):
        state = _averaged(learning, state, epoch)
    network.take(state)
    shared = share(known.sparkSession, network)

    def judge(block: pa.Table) -> pa.Table:
        windows, labels = _examples(block, True, VARIED // 3)
        raw = np.clip(opened(shared).logits(windows), -LIMIT, LIMIT)
        return pa.table({"label": pa.array(labels, pa.int32()),
                         "step": pa.array(np.floor(raw * STEPS).astype(np.int32))})

    rows = blocks(True).applyInArrow(judge, "label int, step int").groupBy(
        "label", "step").count().collect()
    rows.sort()
    network.set_threshold(*(np.array([r[i] for r in rows], kind) / by for i, kind, by in (
        (1, np.float64, STEPS), (0, np.int64, 1), (2, np.float64, 1))), recall)
    log.info("threshold %.4f, precision %.4f of %d findings", network.threshold,
             network.precision, parts[True][1])
    return network


def _averaged(blocks, state: np.ndarray, epoch: int) -> np.ndarray:
    """The state after each block took one pass from `state`: their mean by size. Sums are
    of decimals, so they are the same in any order."""
    def run(block: pa.Table) -> pa.Table:
        windows, labels = _examples(block, False, VARIED)
        after = Network().learn_once(windows, labels, state, epoch)
        return pa.table({"at": pa.array(np.arange(len(after) + 1), pa.int32()),
                         "total": pa.array(np.append(after, 1.0) * block.num_rows)})

    rows = blocks.applyInArrow(run, "at int, total double").groupBy("at").agg(
        F.sum(F.col("total").cast("decimal(38,20)")).cast("double").alias("total")).collect()
    totals = np.zeros(len(rows))
    for row in rows:
        totals[row.at] = row.total
    return totals[:-1] / totals[-1]


def _spans(owners, odds, threshold: float) -> list[tuple[int, int, int, float]]:
    """(document, start, end, score) of the pieces at or above the threshold; those of
    one stretch that overlap are joined. `owners`: document, stretch, piece."""
    out: list[list] = []
    last = None
    for (i, stretch, (s, e)), p in zip(owners, odds):
        if p < threshold:
            continue
        if last == (i, stretch) and s <= out[-1][2]:
            out[-1][2:] = e, max(out[-1][3], float(p))
        else:
            out.append([i, s, e, float(p)])
        last = (i, stretch)
    return [tuple(x) for x in out]


def find_secrets(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id, and spans: array of (kind, start, end, score) by start, then kind. Base
    findings have score 1."""
    shared = share(docs.sparkSession, network)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                               ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        network = opened(shared)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans, windows, owners = [], [], []
            for i, text in enumerate(texts):
                found, candidates = scan(text or "")
                spans.append([(s, KINDS.index(k), e, 1.0) for s, e, k in found])
                base = merged(found)
                for c in candidates:
                    for s, e in free(c, base):
                        # a neighbour that is a base finding says nothing of this one
                        low, high = s if s > c[0] else 0, e if e < c[1] else None
                        for part in pieces(s, e):
                            windows.append(window(text, *part, low, high))
                            owners.append((i, (s, e), part))
                if len(windows) >= TOGETHER or i == len(texts) - 1:
                    for k, s, e, p in _spans(owners, network.probabilities(windows),
                                             network.threshold):
                        spans[k].append((s, len(KINDS) - 1, e, p))
                    windows, owners = [], []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(
                [[{"kind": KINDS[k], "start": s, "end": e, "score": p}
                  for s, k, e, p in sorted(x)] for x in spans], kind)],
                names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, spans array<struct<kind:string,start:int,end:int,score:double>>")


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts by kind, digest of the base spans and all spans as text."""
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")

    base = F.filter("spans", lambda s: s.kind != "model")
    return find_secrets(docs, fit(docs)).select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
