"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces come from a SentencePiece model file, in its order of merit. The file has
ranks, not probabilities, so log scores are taken from Zipf's law: piece number r of n
has -log(r + 1) - log(sum of 1/k, k to n). A text gets the segmentation with the
largest sum; of equal ones the one whose last piece is longest. A character without a
piece costs the least score minus 10 and is written as the pieces of its UTF-8 bytes.

Spaces become the marker U+2581, and one marker goes in front. Decoding turns ids into
bytes, markers into spaces, and drops the first one. A marker in the text itself is
written as bytes, so decoding gives back every text exactly.

No piece holds a marker after another character, and none a line end (both checked on
the file), so words are segmented one by one, and a worker keeps the recent ones.

Defined results: a NULL text has NULL ids; an empty one none. Ids that are not bytes
or pieces (control ids) decode to nothing, broken UTF-8 to U+FFFD. Repeated rows each
get a result; texts of any length are handled whole.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.llm.common import opened, share
from pyspark.sql import types as T

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 300_000
CACHED_LENGTH = 64
_WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


class DoubleArrayTrie:
    """Keys are bytes. The child of state s by byte b is base[s] + b + 1, if check
    there is s; value[s] is a key's number or -1."""

    def __init__(self, keys: list[bytes]):
        order = sorted(range(len(keys)), key=keys.__getitem__)
        size = 1 << 16
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        free = 1
        waiting = [(0, 0, len(order), 0)]
        while waiting:
            state, low, high, depth = waiting.pop()
            if len(keys[order[low]]) == depth:
                value[state] = order[low]
                low += 1
            groups = []
            while low < high:
                byte, start = keys[order[low]][depth], low
                while low < high and keys[order[low]][depth] == byte:
                    low += 1
                groups.append((byte, start, low))
            if not groups:
                continue
            at = max(free - groups[0][0] - 1, 1)
            tried = 0
            while True:
                if at + 257 >= len(check):
                    grown = len(check)
                    base += [0] * grown
                    check += [-1] * grown
                    value += [-1] * grown
                if all(check[at + b + 1] == -1 for b, _, _ in groups):
                    break
                at += 1
                tried += 1
            if tried > 16:  # what lies before is nearly full
                free = at
            base[state] = at
            for byte, start, end in groups:
                check[at + byte + 1] = state
                waiting.append((at + byte + 1, start, end, depth + 1))
        self.base, self.check, self.value = base, check, value


class PieceCodec:
    """Encoder and decoder. It is broadcast; its cache serves all tasks of a worker."""

    def __init__(self, pieces: list[tuple[str, int]], byte_ids: list[int], n_ids: int):
        """`pieces`: (piece, id), best first; `byte_ids`: the id of each byte."""
        if any(MARK in p.lstrip(MARK) or "\n" in p for p, _ in pieces):
            raise ValueError("a piece spans words; they cannot be segmented one by one")
        ranks = np.arange(1, len(pieces) + 1)
        scores = -np.log(ranks) - np.log((1.0 / ranks).sum())
        keys = [p.encode() for p, _ in pieces]
        trie = DoubleArrayTrie(keys)
        self.arrays = [np.array(x, np.int32) for x in (trie.base, trie.check, trie.value)]
        self.ids = [i for _, i in pieces]
        self.scores = scores.tolist()
        self.byte_ids = byte_ids
        self.bytes_of = [b""] * n_ids
        for piece, i in pieces:
            self.bytes_of[i] = piece.replace(MARK, " ").encode()
        for byte, i in enumerate(byte_ids):
            self.bytes_of[i] = bytes([byte])
        self.lists = None
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def from_model(cls, path: str) -> PieceCodec:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        plain = [i for i in range(n) if not (
            model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        plain.sort(key=lambda i: (-model.get_score(i), i))
        return cls([(model.id_to_piece(i), i) for i in plain], byte_ids, n)

    def __getstate__(self):
        return self.__dict__ | {"recent": {}, "older": {}, "lists": None}

    def segment(self, word: str) -> list[int]:
        """Best ids of a string; markers in it are spaces."""
        if self.lists is None:
            self.lists = [x.tolist() for x in self.arrays]
        base, check, value = self.lists
        scores = self.scores
        unknown = scores[-1] - UNKNOWN_PENALTY if scores else -UNKNOWN_PENALTY
        data = word.encode("utf-8", "surrogatepass")
        n, size = len(data), len(check)
        best = [-1e300] * (n + 1)
        best[0] = 0.0
        came = [(-1, -1)] * (n + 1)
        start = 0
        while start < n:
            so_far = best[start]
            lead = data[start]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            covered, state, at = False, 0, start
            while at < n:
                after = base[state] + data[at] + 1
                if after >= size or check[after] != state or not base[state]:
                    break
                state = after
                at += 1
                key = value[state]
                if key >= 0:
                    total = so_far + scores[key]
                    if total > best[at]:
                        best[at] = total
                        came[at] = (start, key)
                    if at - start == width:
                        covered = True
            if not covered:
                total = so_far + unknown
                if total > best[start + width]:
                    best[start + width] = total
                    came[start + width] = (start, -1)
            start += width
        back, at = [], n
        while at > 0:
            start, key = came[at]
            if key >= 0:
                back.append(self.ids[key])
            else:
                back += [self.byte_ids[b] for b in reversed(data[start:at])]
            at = start
        back.reverse()
        return back

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if MARK in text:
            mark = np.array([self.byte_ids[b] for b in MARK.encode()], "<i4").tobytes()
            first, *rest = text.split(MARK)
            return self._encode(MARK + first) + b"".join(mark + self._encode(t) for t in rest)
        return self._encode(MARK + text)

    def _encode(self, text: str) -> bytes:
        recent = self.recent
        words = _WORD.findall(text.replace(" ", MARK))
        found = list(map(recent.get, words))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    word = words[i]
                    ids = recent.get(word) or self.older.get(word)
                    if ids is None:
                        ids = np.array(self.segment(word), "<i4").tobytes()
                    if len(word) <= CACHED_LENGTH:
                        recent[word] = ids
                    found[i] = ids
            if len(recent) > CACHE:
                self.older, self.recent = recent, {}
        return b"".join(found)

    def decode(self, ids) -> str:
        data = b"".join(map(self.bytes_of.__getitem__, ids))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def in_parts(column, size: int = 500):
    """The values of an Arrow column, a few at a time, with the place of the first: whole
    texts of one part only are in memory twice."""
    for first in range(0, len(column), size):
        yield first, column.slice(first, size).to_pylist()


def encode(docs: DataFrame, codec: PieceCodec, check: bool = False) -> DataFrame:
    """All columns of `docs` but `text`, and ids; with `check` also
    round_trip: whether decoding these ids gives the text. Columns of `docs` with these
    names give way."""
    added = ["ids", *(["round_trip"] if check else [])]
    kept = [c for c in docs.columns if c.lower() not in ("text", *added)]
    shared = share(docs.sparkSession, codec)

    def run(batches):
        codec = opened(shared)
        for batch in batches:
            for first, part in in_parts(batch.column("text")):
                runs = [b"" if t is None else codec.encode(t) for t in part]
                ends = np.cumsum([0] + [len(r) // 4 for r in runs])
                values = np.frombuffer(b"".join(runs), "<i4")
                columns = [pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(values),
                    mask=pa.array([t is None for t in part]))]
                if check:
                    columns.append(pa.array([
                        t is None or codec.decode(values[a:b].tolist()) == t
                        for t, a, b in zip(part, ends[:-1], ends[1:])]))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, len(part)) for c in kept), *columns],
                    names=[*kept, *added])

    schema = T.StructType([*docs.select(*kept).schema.fields,
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if check:
        schema = T.StructType([*schema.fields, T.StructField("round_trip", T.BooleanType())])
    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, codec: PieceCodec) -> DataFrame:
    """All columns of `encoded` but `ids`, and text."""
    kept = [c for c in encoded.columns if c not in ("ids", "text")]
    shared = share(encoded.sparkSession, codec)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept),
                 pa.array([None if i is None else opened(shared).decode(i)
                           for i in batch.column("ids").to_pylist()], pa.string())],
                names=[*kept, "text"])

    schema = T.StructType([*encoded.select(*kept).schema.fields,
                           T.StructField("text", T.StringType())])
    return encoded.select(*kept, "ids").mapInArrow(run, schema)


def encoded_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids, n_ids, round_trip of every row of `docs`."""
    return encode(docs.select("doc_id", "text"), PieceCodec.from_model(model_path),
                  check=True).select(
        "doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).alias("n_ids"), "round_trip")


# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
