"""Token ids in Arrow stream files of fixed-size-list batches.

A folder holds, for each task, `tokens-*.arrow`: an Arrow IPC stream with the columns
`ids` and `mask`, both fixed-size lists of `length` (2,048) entries, and
`documents-*.arrow`: doc_id, start and n_tokens of the documents in it, in order. Ids
are unsigned 16-bit where the vocabulary allows, else 32-bit; masks are one bit.
Documents follow each other without gaps over sequence limits; `mask` is false only
in the padding at the end of a file. All batches but the last hold equally many
sequences, so they take equally many bytes: sequence i is found by arithmetic in the
memory-mapped file and read without a copy.

`manifest` is a table with one row per file pair, committed by Spark. A task that runs
twice leaves files that no manifest row names; they are removed after the commit.

Ids come from the tokenizers library, for a byte-level BPE vocabulary with the usual
word pattern. A text is cut at single spaces and line ends between visible characters,
where that pattern always ends a word; the pieces' ids are kept in a bounded cache that
a worker uses again in later tasks. A text with other white space is encoded in one go.

Defined results: a NULL or empty text has the end id only. Documents are in ascending
doc_id order, NULL ids first, rows of one id by a hash of their text; repeated rows
each have their place. An empty table gives no documents. Strings of special tokens in
a text are ordinary text. Other columns are not read.
"""

from __future__ import annotations

import re
import sys
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callstrata.llm.common import written
from callstrata.session import fresh_path

LENGTH = 2048
BATCH_SEQUENCES = 64
END_ID = 0
CACHE = 800_000
#: a piece longer than this is encoded anew each time, so that the cache stays small
CACHED_LENGTH = 64

# Visible characters up to U+024F. Between two of them a single space or line end is
# always where the tokenizer's word pattern ends a word.
_VISIBLE = "!-~¡-¬®-ɏ"
_UNEVEN = re.compile(f"^[ \n]|[^{_VISIBLE}][ \n]|[ \n](?:[^{_VISIBLE}]|$)")
_NOT_VISIBLE = re.compile(f"[^ \n{_VISIBLE}]")
# Within these the pattern's classes of letters and digits are plain ranges.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[!-~{_LETTERS}]*")
_NOT_PLAIN = re.compile(f"[^ \n!-~{_LETTERS}]")
_WORD = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s{_LETTERS}0-9]+")


def _uneven(text: str, visible: bool) -> bool:
    """What `_UNEVEN` finds, without a look at every place of a `visible` text: one of
    visible characters, spaces and line ends alone. `text` is not empty."""
    if not visible:
        return _UNEVEN.search(text) is not None
    return (text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text
            or " \n" in text or "\n " in text)


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where
    it is visible, else the next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class CachedEncoder:
    """Encodes whole texts as bytes of ids. One object, and what it has cached, serves
    all tasks of a worker."""

    def __init__(self, definition: str, dtype: str):
        self.definition, self.dtype = definition, dtype
        self.code = "H" if dtype == "<u2" else "I"
        self.characters = _byte_characters()
        self._forget()

    def _forget(self):
        self.tokenizer = self.model = None
        #: ids of " " + piece, or of a line end and its piece; of single words
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def __getstate__(self):
        return {"definition": self.definition, "dtype": self.dtype,
                "code": self.code, "characters": self.characters}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def _start(self):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(self.definition)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model  # each look at that attribute makes an object
        self.line_end = self._library("\n")

    def _library(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of what the pattern takes as one word."""
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= CACHE:
                self.words.clear()
            # of ASCII, words have visible characters and a space at the start
            shown = (word.replace(" ", self.characters[32]) if word.isascii()
                     else word.encode().decode("latin-1").translate(self.characters))
            ids = self.words[word] = array(
                self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()
        return ids

    def _piece(self, piece: str, plain: bool) -> bytes:
        """Ids of a piece: what follows a space, or a line end with what follows it."""
        ids = self.pieces.get(piece)
        if ids is None:
            start, rest = (self.line_end, piece[1:]) if piece[0] == "\n" else (b"", " " + piece)
            if len(piece) > CACHED_LENGTH:
                return start + self._library(rest)
            if len(self.pieces) >= CACHE:
                self.pieces.clear()
            ids = self.pieces[piece] = start + (
                b"".join(map(self._word, _WORD.findall(rest)))
                if plain or _PLAIN.fullmatch(rest, 0 if start else 1) else self._library(rest))
        return ids

    def encode(self, text: str) -> bytes:
        if self.tokenizer is None:
            self._start()
        if not text:
            return b""
        plain = not _NOT_PLAIN.search(text)
        if _uneven(text, plain or not _NOT_VISIBLE.search(text)):
            return self._library(text)
        pieces = text.replace("\n", " \n").split(" ")
        found = list(map(self.pieces.get, pieces))
        # the first piece follows nothing: as after a line end, without that
        found[0] = self._piece("\n" + pieces[0], plain)[len(self.line_end):]
        if None in found:
            at = 0
            for _ in range(found.count(None)):
                at = found.index(None, at + 1)
                found[at] = self._piece(pieces[at], plain)
        return b"".join(found)


def sequence_schema(length: int, dtype: str) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(np.dtype(dtype)), length)),
                      ("mask", pa.list_(pa.bool_(), length))])


DOCUMENT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()),
                             ("n_tokens", pa.int64())])


class _Writer:
    """Cuts a run of ids into sequences and writes full batches as they fill."""

    def __init__(self, sink, length: int, dtype: str):
        self.schema, self.length, self.dtype = sequence_schema(length, dtype), length, dtype
        self.stream = pa.ipc.new_stream(sink, self.schema)
        self.waiting: list[bytes] = []
        self.bytes_waiting = 0
        self.batch_bytes = BATCH_SEQUENCES * length * np.dtype(dtype).itemsize
        self.tokens = 0

    def add(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.bytes_waiting += len(ids)
        self.tokens += len(ids) // np.dtype(self.dtype).itemsize
        if self.bytes_waiting >= self.batch_bytes:
            data = b"".join(self.waiting)
            whole = len(data) // self.batch_bytes * self.batch_bytes
            for at in range(0, whole, self.batch_bytes):
                self._write(np.frombuffer(data, self.dtype,
                                          self.batch_bytes // np.dtype(self.dtype).itemsize, at))
            self.waiting = [data[whole:]]
            self.bytes_waiting = len(data) - whole

    def _write(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        padded = np.full(rows * self.length, END_ID, self.dtype)
        padded[:len(ids)] = ids
        mask = np.arange(rows * self.length) < len(ids)
        self.stream.write_batch(pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(pa.array(padded), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)],
            schema=self.schema))

    def close(self) -> None:
        rest = np.frombuffer(b"".join(self.waiting), self.dtype)
        if len(rest):
            self._write(rest)
        self.stream.close()


class SequenceFile:
    """Random access to the sequences of one file, without copies where it is local."""

    def __init__(self, uri: str):
        files, path = pafs.FileSystem.from_uri(uri)
        local = isinstance(files, pafs.LocalFileSystem)
        self.buffer = (pa.memory_map(path).read_buffer() if local
                       else files.open_input_file(path).read_buffer())
        source = pa.BufferReader(self.buffer)
        self.schema = pa.ipc.open_stream(source).schema
        self.length = self.schema.field("ids").type.list_size
        source = pa.BufferReader(self.buffer)
        pa.ipc.read_message(source)
        self.first = source.tell()
        message = pa.ipc.read_message(source) if self.first < len(self.buffer) - 8 else None
        self.stride = source.tell() - self.first
        self.batches = -(-(len(self.buffer) - 8 - self.first) // self.stride) if message else 0
        self._last: tuple[int, pa.RecordBatch] | None = None

    def batch(self, number: int) -> pa.RecordBatch:
        if self._last is None or self._last[0] != number:
            at = self.first + number * self.stride
            message = pa.ipc.read_message(pa.BufferReader(self.buffer.slice(at)))
            self._last = number, pa.ipc.read_record_batch(message, self.schema)
        return self._last[1]

    def __len__(self) -> int:
        if not self.batches:
            return 0
        return (self.batches - 1) * BATCH_SEQUENCES + self.batch(self.batches - 1).num_rows

    def __getitem__(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """ids (a view of the file) and mask of one sequence."""
        batch, at = self.batch(row // BATCH_SEQUENCES), row % BATCH_SEQUENCES
        return (batch.column("ids")[at].values.to_numpy(),
                batch.column("mask")[at].values.to_numpy(zero_copy_only=False))

    def span(self, start: int, n: int):
        """Views of `n` ids from the file's id `start` on, batch by batch."""
        per_batch = BATCH_SEQUENCES * self.length
        while n > 0:
            ids = self.batch(start // per_batch).column("ids").flatten().to_numpy()
            part = ids[start % per_batch:start % per_batch + n]
            yield part
            start, n = start + len(part), n - len(part)


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, vocabulary: int,
                      length: int = LENGTH) -> DataFrame:
    """Writes `docs` (doc_id, text) to a new folder below `folder`; returns the stored
    manifest: part, tokens_file, documents_file (below `folder`), n_docs, n_tokens.
    Files of other calls stay."""
    spark = docs.sparkSession
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    with open(tokenizer_path, encoding="utf-8") as source:
        # plain values: workers need not have this package to read them
        shared = spark.sparkContext.broadcast({"definition": source.read(), "dtype": dtype})
    end = np.array([END_ID], dtype).tobytes()
    call = uuid.uuid4().hex
    files, path = pafs.FileSystem.from_uri(f"{folder}/{call}")
    files.create_dir(path, recursive=True)

    def write(batches):
        store, top = pafs.FileSystem.from_uri(f"{folder}/{call}")
        name = uuid.uuid4().hex
        tokens, documents = f"{top}/tokens-{name}.arrow", f"{top}/documents-{name}.arrow"
        # kept with the broadcast value, so that it serves all tasks of a worker
        encoder = shared.value.setdefault("encoder", None) or CachedEncoder(
            shared.value["definition"], shared.value["dtype"])
        shared.value["encoder"] = encoder
        writer = index = None
        n_docs = 0
        for batch in batches:
            if writer is None:
                sinks = [store.open_output_stream(tokens), store.open_output_stream(documents)]
                writer = _Writer(sinks[0], length, dtype)
                index = pa.ipc.new_stream(sinks[1], DOCUMENT_SCHEMA)
            starts, counts = [], []
            for text in batch.column("text").to_pylist():
                starts.append(writer.tokens)
                writer.add(encoder.encode(text or "") + end)
                counts.append(writer.tokens - starts[-1])
            n_docs += len(starts)
            index.write_batch(pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(starts, pa.int64()),
                 pa.array(counts, pa.int64())], schema=DOCUMENT_SCHEMA))
        if writer is not None:
            writer.close()
            index.close()
            for sink in sinks:
                sink.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                "tokens_file": [f"{call}/tokens-{name}.arrow"],
                "documents_file": [f"{call}/documents-{name}.arrow"],
                "n_docs": pa.array([n_docs], pa.int64()),
                "n_tokens": pa.array([writer.tokens], pa.int64())})

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .withColumn("tie", F.xxhash64("text"))
               .withColumn("place", F.monotonically_increasing_id())
               .repartitionByRange("doc_id", "tie", "place")
               .sortWithinPartitions("doc_id", "tie", "place").select("doc_id", "text"))
    manifest = written(ordered.mapInArrow(
        write, "part int, tokens_file string, documents_file string, n_docs bigint, "
        "n_tokens bigint"), "token-manifest")
    named = {name for row in manifest.select("tokens_file", "documents_file").collect()
             for name in row}
    for info in files.get_file_info(pafs.FileSelector(path)):
        if f"{call}/{info.base_name}" not in named:
            files.delete_file(info.path)
    return manifest


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read from the files."""

    def read(batches):
        store, top = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                sequences = SequenceFile(f"{folder}/{row['tokens_file']}")
                with store.open_input_stream(f"{top}/{row['documents_file']}") as source:
                    for index in pa.ipc.open_stream(source):
                        sums = []
                        for start, n in zip(index.column("start").to_pylist(),
                                            index.column("n_tokens").to_pylist()):
                            crc = 0
                            for ids in sequences.span(start, n):
                                crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                            sums.append(crc)
                        yield pa.RecordBatch.from_arrays([
                            index.column("doc_id"),
                            pa.array(index.column("start").to_numpy() + row["before"]),
                            index.column("n_tokens"), pa.array(sums, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # one row per file
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return placed.repartition(max(1, min(manifest.count(), 10_000))).mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_digests(docs: DataFrame, tokenizer_path: str, vocabulary: int) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    folder = fresh_path(spark, "token-files")
    return read_documents(write_token_files(docs, folder, tokenizer_path, vocabulary), folder)


# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
