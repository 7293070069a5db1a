"""Bag search, word BPE and the prefix trie against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from callstrata.llm import bag_search, prefix_trie, word_bpe

from .conftest import awkward_rows, prose

ROWS = [(r[0], r[1]) for r in awkward_rows()]
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- bag search ---------------------------------------------------------------------

def plain_terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_search(docs, items, top):
    """Counter of (item_id, rank, doc_id, score)."""
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    total, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    result = Counter()
    for item_id, text in items:
        scored = []
        for doc_id, bag, n in bags:
            m = 75 + 25 * n * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
                for t in plain_terms(text) if t in bag)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(
                scored, key=lambda s: (s[0], s[1], s[2] or 0))[:top], 1):
            result[(item_id, rank, doc_id, -score)] += 1
    return result


def ranked(frame):
    return Counter(tuple(r) for r in
                   frame.select("item_id", "rank", "doc_id", "score").collect())


def test_search_equals_scores_of_all_pairs(awkward, items):
    wanted = [tuple(r) for r in items.collect()]
    assert ranked(bag_search.search(awkward, items)) == plain_search(ROWS, wanted, 20)


def hot_documents(n=400):
    """A third of all rows one bag, in other orders of words too, ties and long texts."""
    draw = random.Random(4)
    rows = []
    for i in range(n):
        words = prose(1, 12).split()
        if i % 3:
            words = prose(i % 40, 30 + i % 9).split()
        draw.shuffle(words)
        rows.append((n - i if i % 50 else None, " ".join(words)))
    rows += [(3, prose(1, 12)), (3, prose(1, 12)), (n + 5, " ".join([prose(2, 500)] * 20))]
    return rows


@pytest.mark.parametrize("top, block", [(20, 10**6), (3, 10**6), (7, 60)])
def test_search_expands_hot_classes_and_works_in_blocks(spark, monkeypatch, top, block):
    monkeypatch.setattr(bag_search, "BROADCAST_BYTES", 0 if top == 3 else 16 << 20)
    rows = hot_documents()
    wanted = [(1, prose(1, 12)), (2, prose(5, 20)), (2, prose(7, 8) + " " + prose(7, 8)),
              (None, prose(1, 4)), (9, "nowhere"), (10, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame(wanted, "item_id long, text string")
    assert ranked(bag_search.search(docs, items, top, block)) == plain_search(rows, wanted, top)


def test_search_adds_up_few_cells_at_once(spark, monkeypatch):
    monkeypatch.setattr(bag_search, "CELLS", 7)
    rows = hot_documents(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, prose(1, 12)), (2, prose(5, 20))],
                                  "item_id long, text string")
    assert ranked(bag_search.search(docs, items)) == plain_search(
        rows, [(1, prose(1, 12)), (2, prose(5, 20))], 20)


def test_search_of_nothing(awkward, none, items):
    assert bag_search.search(none, items).count() == 0
    assert bag_search.search(awkward, items.limit(0)).count() == 0
    assert bag_search.search(awkward.filter("text IS NULL"), items).count() == 0


# --- word BPE -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def codec():
    with open(WORD_BPE, encoding="utf-8") as source:
        return word_bpe.WordBpe(source.read())


def test_word_bpe_digests_equal_the_library(awkward, none, library):
    expected = Counter()
    for doc_id, text in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected[(doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  sha(library.decode(ids, skip_special_tokens=False)))] += 1
    got = word_bpe.round_trip_digests(awkward, WORD_BPE)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(map(tuple, got.collect())) == expected
    assert word_bpe.round_trip_digests(none, WORD_BPE).count() == 0


def test_word_bpe_keeps_rows_and_decodes(awkward, library):
    ids = word_bpe.encode(awkward, WORD_BPE)
    # the fixture has a column named ids
    assert ids.columns == [*awkward.columns, "ids_"]
    back = word_bpe.decode(ids, WORD_BPE, column="ids_")
    expected = Counter()
    for doc_id, text in ROWS:
        made = library.encode(text or "", add_special_tokens=False).ids
        expected[(doc_id, text, tuple(made), library.decode(made, skip_special_tokens=False))] += 1
    assert Counter((r.doc_id, r.text, tuple(r.ids_), r.decoded) for r in back.collect()) == expected


def test_word_bpe_of_odd_characters(codec, library):
    draw = random.Random(3)
    odd = ("abcxyzABC012 \n\t'’éÉß漢字Σσςİı\x1c\x1d\x85\xa0 　́̈\U0001F600!?.,<>|_-"
           "՘ᲉꟋ\U00010940")
    texts = ["".join(draw.choice(odd) for _ in range(draw.randrange(60))) for _ in range(4000)]
    texts += [t + "<|endoftext|>" + t[:4] for t in texts[:300]]
    texts += ["it's WE'RE 'S", "<|startoftext|><|endoftext|>", "<|STARTOFTEXT|>", "\x1c"]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(codec.encode(text)) == ids, repr(text)
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_words_merge_as_short_ones(codec, library, monkeypatch):
    draw = random.Random(5)
    for n in (2, 30, word_bpe.SHORT - 1, word_bpe.SHORT, word_bpe.SHORT + 1, 9000):
        for word in ("".join(draw.choice("abcdefinghthe") for _ in range(n)), "a" * n):
            assert list(codec.encode(word)) == library.encode(
                word, add_special_tokens=False).ids
    words = ["".join(draw.choice("abcdefinghthe") for _ in range(20)) for _ in range(300)]
    short = [codec.merged(w) for w in words]
    monkeypatch.setattr(word_bpe, "SHORT", 0)
    assert [codec.merged(w) for w in words] == short


def test_other_definitions_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as source:
        with pytest.raises((ValueError, KeyError)):
            word_bpe.WordBpe(source.read())


# --- prefix trie --------------------------------------------------------------------

def plain_trie(rows):
    """Counter of the contract's rows."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turn_key = hashlib.sha256(
                f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            own[conv_id].append(((turn is not None, turn or 0), turn_key,
                                 (role or "", text or "")))
    own = {c: [t for _, _, t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        saved[node] = sum(saved[b] for b in below) + (
            (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
        leaves[node] = sum(leaves[b] for b in below) or 1
    return Counter(
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m),
         len(children[node]), leaves[node], saved[node],
         sha(",".join(str(c) for c in sorted(m) if paths[c] == node)))
        for node, m in members.items())


def conversations(seed, n):
    """Shared first turns, whole copies, deep ones, NULLs, repeated rows, gaps in families."""
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-n, 2 * n), n):
        if c % 3 == 0:  # one conversation of a third
            turns = [("user", "hello"), ("assistant", "hé"), ("user", "again")]
        elif c % 7 == 0:
            turns = [("user", "hello")] + [("user", f"t{k % 5}") for k in range(c % 90)]
        else:
            turns = [(draw.choice(["user", "assistant", None]), draw.choice(["", None, "a", "bb"]))
                     for _ in range(draw.randrange(1, 12))]
        rows += [(c, k if k or draw.random() < 0.9 else None, *t) for k, t in enumerate(turns)]
        if draw.random() < 0.1:
            rows.append(rows[-1])
    rows += [(None, 0, "user", "nobody's"), (None, 1, None, None)]
    return rows


@pytest.mark.parametrize("n, segment, fan", [(300, 200_000, 32), (300, 15, 2), (120, 1, 2)])
def test_trie_equals_a_plain_one(spark, n, segment, fan):
    rows = conversations(n + segment, n)
    frame = spark.createDataFrame(
        [(*r, "x", 1) for r in rows],
        "conv_id long, turn long, role string, text string, key string, kind int").repartition(4)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefix_trie.trie(frame, segment, fan)
        assert got.columns == prefix_trie.RESULT
        assert Counter(map(tuple, got.collect())) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_trie_joins_with_shuffles_too(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BROADCAST_BYTES", 0)
    rows = conversations(9, 60)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert Counter(map(tuple, prefix_trie.trie(frame, 10, 2).collect())) == plain_trie(rows)


def test_trie_of_one_empty_or_no_conversation(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).count() == 0
    # crc32("2") % 9 first turns are taken from conversation 0, which is absent
    one = [(2, 0, "user", "a")]
    got = prefix_trie.trie(spark.createDataFrame(one, schema))
    assert Counter(map(tuple, got.collect())) == plain_trie(one)
