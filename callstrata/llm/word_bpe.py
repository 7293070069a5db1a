"""Byte-pair encoding with word ends, and decoding, on whole texts.

A text is cut at white space, each piece is brought to normal form and lower case and
cut into words by the tokenizer's pattern, and each word is merged over a contiguous rank
array: `starts` holds where its parts begin, `ranks` the rank of the merge of each part
with the next. The least rank is looked up by scanning the array, its boundary deleted,
and the ranks of both neighbours looked up anew. A word of over `SHORT` bytes takes its
least rank from a heap instead, with the same result, so that one very long word does not
cost the square of its length.

The tokenizers library is used for what is no merge: outside of code points below U+0530,
where Python's tables of letters, digits and cases are known to agree with the library's,
its normaliser and its pre-tokenizer cut the words. Only a definition with exactly this
normaliser, pattern and word end is accepted.

Defined results: a NULL or empty text has no ids and decodes to an empty text. White space
is dropped. The strings of special tokens in a text are special tokens. Ids decode to their
tokens' characters, word ends shown, joined by one space. Repeated rows stay, other columns
stay as they are, an empty table gives an empty one. A text is held whole by its task, with
its ids; nothing else grows with it.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from array import array

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstrata.llm.common import unused

#: Words of more bytes use a heap.
SHORT = 256
#: Pieces kept with their ids, and the longest piece that is kept.
CACHE = 500_000
CACHED_LENGTH = 64

# Fixed values of the tokenizer: its pattern, what it calls white space, its word end.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
WORD_END = "</w>"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"},
                                 "content": " "}, {"type": "Lowercase"}]

_SPACES = re.compile(f"[{SPACES}]+")
# Python's split() also cuts at these.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_KNOWN = re.compile("[\x00-ԯ]*")
_ASCII = re.compile("[\x00-\x7f]*")
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+|[\x1c-\x1f]+")


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself where it is visible, else the
    next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordBpe:
    """Encoder and decoder for one definition (the JSON text of a tokenizer file)."""

    def __init__(self, definition: str):
        import regex
        from tokenizers import Tokenizer

        known = json.loads(definition)
        model, cut = known["model"], known["pre_tokenizer"]["pretokenizers"]
        if (known["normalizer"] != {"type": "Sequence", "normalizers": NORMALIZERS}
                or cut[0].get("pattern") != {"Regex": PATTERN} or not cut[0].get("invert")
                or cut[0].get("behavior") != "Removed" or len(cut) != 2
                or cut[1] != {"type": "ByteLevel", "add_prefix_space": False,
                              "trim_offsets": True, "use_regex": False}
                or known["decoder"] is not None or known["post_processor"] is not None
                or model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END
                or model["continuing_subword_prefix"] or model["dropout"]
                or model["unk_token"] is not None or model["byte_fallback"]
                or model.get("ignore_merges")):
            raise ValueError("not a word-end BPE definition of the kind this encoder knows")
        special = known["added_tokens"]
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]
               for t in special):
            raise ValueError("special tokens must be plain strings")
        self.vocabulary: dict[str, int] = model["vocab"]
        self.ranks = {tuple(pair) if isinstance(pair, list) else tuple(pair.split(" ")): rank
                      for rank, pair in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in special}
        self.tokens = [""] * (1 + max([*self.vocabulary.values(), *self.special.values()]))
        for token, number in [*self.vocabulary.items(), *self.special.items()]:
            self.tokens[number] = token
        self.characters = _byte_characters()
        self.library = Tokenizer.from_str(definition)
        self.words = regex.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|\\p{{L}}+|\\p{{N}}|[^{SPACES}\\p{{L}}\\p{{N}}]+")
        self.specials = re.compile("(" + "|".join(
            map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if special else None
        self.pieces: dict[str, bytes] = {}
        self.of_word: dict[str, bytes] = {}

    # --- merging -----------------------------------------------------------------

    def merged(self, word: str) -> list[str]:
        """Tokens of a word given in byte characters."""
        units = [*word[:-1], word[-1] + WORD_END]
        if len(units) > SHORT:
            return self._merged_long(units)
        marked = word + WORD_END
        starts = list(range(len(units)))
        ends = [*starts[1:], len(marked)]
        none = len(self.ranks)
        lookup = self.ranks.get
        ranks = [lookup((a, b), none) for a, b in zip(units, units[1:])]
        while ranks and (least := min(ranks)) < none:
            at = ranks.index(least)
            # the part at `at` takes in the next one
            del starts[at + 1], ranks[at]
            del ends[at]
            part = marked[starts[at]:ends[at]]
            if at:
                ranks[at - 1] = lookup((marked[starts[at - 1]:ends[at - 1]], part), none)
            if at < len(ranks):
                ranks[at] = lookup((part, marked[starts[at + 1]:ends[at + 1]]), none)
        return [marked[a:b] for a, b in zip(starts, ends)]

    def _merged_long(self, units: list[str]) -> list[str]:
        """The same with a heap of (rank, place) and links to neighbours."""
        n = len(units)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []

        def offer(left: int, right: int) -> None:
            rank = self.ranks.get((units[left], units[right]))
            if rank is not None:
                heap.append((rank, left, units[left], units[right]))

        for i in range(n - 1):
            offer(i, i + 1)
        heapq.heapify(heap)
        while heap:
            _, at, left, right = heapq.heappop(heap)
            following = after[at]
            if units[at] != left or following < 0 or units[following] != right:
                continue
            units[at] = left + right
            units[following] = ""
            after[at] = after[following]
            if after[at] >= 0:
                before[after[at]] = at
            for a, b in ((before[at], at), (at, after[at])):
                if a >= 0 and b >= 0 and units[a]:
                    rank = self.ranks.get((units[a], units[b]))
                    if rank is not None:
                        heapq.heappush(heap, (rank, a, units[a], units[b]))
        return [u for u in units if u]

    def _word(self, word: str) -> bytes:
        ids = self.of_word.get(word)
        if ids is None:
            tokens = self.merged(word)
            ids = array("I", [self.vocabulary[t] for t in tokens]).tobytes()
            if len(word) <= CACHED_LENGTH:
                if len(self.of_word) >= CACHE:
                    self.of_word.clear()
                self.of_word[word] = ids
        return ids

    # --- texts -------------------------------------------------------------------

    def _shown_words(self, piece: str) -> list[str]:
        """Words of a piece without white space, in byte characters."""
        if _ASCII.fullmatch(piece):
            words = _ASCII_WORDS.findall(piece.lower()) if not _SEPARATORS.search(piece) \
                else self.words.findall(piece.lower())
        elif _KNOWN.fullmatch(piece):
            # letter by letter: a final sigma is as any other
            lower = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
            words = self.words.findall(lower)
        else:
            normal = self.library.normalizer.normalize_str(piece)
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return [w.encode().decode("latin-1").translate(self.characters) for w in words]

    def _piece(self, piece: str) -> bytes:
        parts = self.specials.split(piece) if self.specials and "<" in piece else [piece]
        ids = b"".join(
            array("I", [self.special[part]]).tobytes() if part in self.special
            else b"".join(map(self._word, self._shown_words(part)))
            for part in parts if part)
        if len(piece) <= CACHED_LENGTH:
            if len(self.pieces) >= CACHE:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def encode(self, text: str | None) -> array:
        """Ids of a whole text, as unsigned 32-bit integers."""
        ids = array("I")
        if not text:
            return ids
        pieces = text.split() if not _SEPARATORS.search(text) else [
            p for p in _SPACES.split(text) if p]
        found = list(map(self.pieces.get, pieces))
        at = -1
        for _ in range(found.count(None)):
            at = found.index(None, at + 1)
            found[at] = self._piece(pieces[at])
        ids.frombytes(b"".join(found))
        return ids

    def decode(self, ids) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


# A broadcast of plain values only: workers need not have this package. What the codec has
# cached serves all tasks of a worker, as the broadcast value does.
def _shared(docs: DataFrame, tokenizer_path: str):
    with open(tokenizer_path, encoding="utf-8") as source:
        return docs.sparkSession.sparkContext.broadcast({"definition": source.read()})


def _codec(shared) -> WordBpe:
    state = shared.value
    if "codec" not in state:
        state["codec"] = WordBpe(state["definition"])
    return state["codec"]


def encode(docs: DataFrame, tokenizer_path: str, column: str = "text",
           output: str = "ids") -> DataFrame:
    """The rows with the ids of `column`, array<int>, as new column `output` (a clashing
    name is lengthened by underscores)."""
    return _mapped(docs, tokenizer_path, column, output, T.ArrayType(T.IntegerType()),
                   pa.list_(pa.int32()), lambda codec, text: codec.encode(text))


def decode(rows: DataFrame, tokenizer_path: str, column: str = "ids",
           output: str = "decoded") -> DataFrame:
    """The rows with the text that the ids in `column` stand for (NULL: empty)."""
    return _mapped(rows, tokenizer_path, column, output, T.StringType(), pa.string(),
                   lambda codec, ids: codec.decode(ids or ()))


def _mapped(rows, tokenizer_path, column, output, spark_type, arrow_type, value) -> DataFrame:
    shared = _shared(rows, tokenizer_path)
    output = unused(rows.columns, output)
    schema = T.StructType([*rows.schema.fields, T.StructField(output, spark_type)])
    place = rows.columns.index(column)

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            made = [value(codec, x) for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, arrow_type)],
                names=[*batch.schema.names, output])

    return rows.mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids as little-endian 32-bit integers, and of the
    text that they decode to."""
    shared = _shared(docs, tokenizer_path)

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch.column("text").to_pylist():
                ids = codec.encode(text)
                counts.append(len(ids))
                if sys.byteorder == "big":
                    ordered = array("I", ids)
                    ordered.byteswap()
                else:
                    ordered = ids
                of_ids.append(hashlib.sha256(ordered).hexdigest())
                of_text.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
