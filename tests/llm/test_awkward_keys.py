"""Rows without ids, ids with several texts, retries, clashing columns, unknown secrets."""

import random
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from callstrata.llm import digest_index, repeat_trees, secrets, splitters, token_files
from callstrata.session import fresh_path

from .conftest import prose
from .test_operators import BPE, multiset, plain_repeats

REPORT = ("doc_id", "n_words", "n_removed", "kept_sha256")


def repeats_of(spark, rows, partitions=4):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    return multiset(repeat_trees.without_repeats(docs), *REPORT)


@pytest.mark.parametrize("large", [300_000, 60])
def test_repeats_of_rows_without_ids_and_of_several_texts_of_an_id(spark, monkeypatch, large):
    monkeypatch.setattr(repeat_trees, "LARGE_PART", large)
    shared = prose(1, 70)
    rows = [(3, shared + " " + prose(2, 30)), (None, prose(3, 300)),
            (None, shared + " " + prose(4, 5)), (None, prose(5, 20) + " " + shared),
            (None, prose(6, 60)), (None, prose(6, 60)), (5, prose(7, 300)),
            (5, prose(8, 15) + " " + shared), (5, shared), (5, prose(9, 10)),
            (4, "  " + prose(10, 80)), (4, prose(10, 80) + "\n"), (9, prose(10, 80)),
            ((1 << 63) - 1, prose(11, 40)), ((1 << 63) - 1, prose(12, 9) + " " + shared)]
    _with_ids(rows, repeats_of(spark, rows))


def _with_ids(rows, got):
    """The plain result, NULL ids in place of the largest one they count as."""
    largest = (1 << 63) - 1
    expected = plain_repeats([(largest if i is None else i, t) for i, t in rows])
    # rows of the largest id and without an id have results of their own
    assert sum(got.values()) == len(rows)
    merged = Counter()
    for (doc_id, *rest), n in got.items():
        merged[(largest if doc_id is None else doc_id, *rest)] += n
    assert merged == expected
    assert sum(n for (doc_id, *_), n in got.items() if doc_id is None) == sum(
        i is None for i, _ in rows)
    assert sum(n for (doc_id, *_), n in got.items() if doc_id == largest) == sum(
        i == largest for i, _ in rows)
    return got


def test_many_long_repetitive_rows(spark):
    draw = random.Random(2)
    phrase = prose(20, 12)
    rows = [(i if i % 3 else None, " ".join([phrase] * draw.randrange(5, 30) + [prose(i, 4)]))
            for i in range(150)]
    _with_ids(rows, repeats_of(spark, rows))


def test_a_third_of_all_rows_without_id_and_alike(spark):
    rows = [(None, prose(30, 120))] * 60 + [(i, prose(i + 40, 80)) for i in range(60)] + [
        (7, prose(30, 120)[10:])]
    _with_ids(rows, repeats_of(spark, rows, 6))


# -- the digest index ------------------------------------------------------------------


BATCH = [(1, "a"), (2, "a"), (2, "a"), (3, "b"), (None, "c"), (None, "c"), (4, None), (5, "")]


def stays(report):
    """keep_id of the texts of which exactly one row stays, and all texts known before."""
    rows = report.collect()
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert set(kept.values()) <= {1}
    return ({r.text_sha256: r.keep_id for r in rows if r.kept},
            {r.text_sha256 for r in rows if r.known})


def documents(spark, rows, partitions):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)


@pytest.mark.parametrize("died_at", ["append", "files", "after"])
def test_index_batch_that_runs_again_keeps_its_texts(spark, monkeypatch, died_at):
    index = digest_index.DigestIndex(spark, fresh_path(spark, "index"), buckets=4)
    stays(index.deduplicate(documents(spark, [(9, "b"), (10, "z")], 2), 0))
    if died_at == "after":
        first = stays(index.deduplicate(documents(spark, BATCH, 3), 1))
    else:
        def die(*_):
            raise RuntimeError
        with monkeypatch.context() as patch:
            patch.setattr(index, died_at, die)
            with pytest.raises(RuntimeError):
                index.deduplicate(documents(spark, BATCH, 3), 1)
        first = None
    again = stays(index.deduplicate(documents(spark, BATCH[::-1], 7), 1))
    assert len(again[0]) == 3 and len(again[1]) == 1, "b was known, three texts are new"
    assert sorted(again[0].values(), key=str) == [2, 5, None]
    assert first is None or first == again
    assert index.files().count() == index.rows().count() == 5, "nothing is there twice"
    later = stays(index.deduplicate(documents(spark, BATCH, 2), 2))
    assert later[0] == {} and len(later[1]) == 4


def test_index_refuses_another_number_of_buckets(spark):
    path = fresh_path(spark, "index")
    digest_index.DigestIndex(spark, path, buckets=4)
    with pytest.raises(ValueError, match="4 buckets"):
        digest_index.DigestIndex(spark, path, buckets=7)
    with pytest.raises(TypeError):
        digest_index.DigestIndex(spark, path, buckets=4).deduplicate(
            documents(spark, BATCH, 2))


# -- columns of the user -------------------------------------------------------------------


CLASHING = ("key", "range", "h", "nth", "ends", "group_bytes", "rows_before", "size",
            "text_crc32", "shard", "slot", "carried", "c0", "part", "a.b")


def test_shards_keep_columns_of_any_name(spark, tmp_path):
    rows = [(i, prose(i, 9), *(f"{name}{i}" for name in CLASHING)) for i in range(60)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *CLASHING]).withColumn(
        "doc_id", F.col("doc_id").cast("long"))
    got = splitters.shard(docs, 3, carry=("text", *CLASHING))
    names = [f"{n}_" if n in splitters.RESULT else n for n in CLASHING]
    assert got.columns == [*splitters.RESULT, "text", *names]
    found = {r[0]: tuple(r)[5:] for r in got.collect()}
    assert found == {r[0]: r[1:] for r in rows}
    assert {r["size"] for r in got.collect()} == {len(r[1].encode()) + 8 for r in rows}
    splitters.write_shards(docs, 3, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert set(back.columns) == {*splitters.RESULT, "text", *names} and back.count() == 60
    empty = splitters.shard(docs.limit(0), 3, carry=("text", *CLASHING))
    assert empty.columns == got.columns and empty.count() == 0


def test_token_files_of_another_call_stay(spark, tmp_path):
    folder = str(tmp_path / "tokens")
    first = token_files.write_token_files(
        documents(spark, [(i, prose(i, 30)) for i in range(9)], 2), folder, BPE, 50_257)
    before = sorted(map(tuple, token_files.read_documents(first, folder).collect()))
    second = token_files.write_token_files(
        documents(spark, [(50, "other")], 1), folder, BPE, 50_257)
    assert token_files.read_documents(second, folder).count() == 1
    assert sorted(map(tuple, token_files.read_documents(first, folder).collect())) == before


# -- secrets of looks that no base pattern knows ---------------------------------------------


def test_network_finds_looks_that_no_base_pattern_knows(spark):
    draw = random.Random(8)
    rows = []
    for i in range(900):
        text = prose(i, 30)
        if i % 9 == 0:
            text += " token = " + "".join(draw.choice("0123456789abcdef") for _ in range(40))
        elif i % 9 == 1:
            text += " " + "".join(draw.choice("0123456789") for _ in range(16)) + " " + prose(i, 4)
        elif i % 9 == 2:
            text += " /" + "/".join(prose(i + 5000, 6).split()) + " " + prose(i, 4)
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    network = secrets.fit(docs)
    assert 0.3 < network.threshold < 1 and network.precision > 0.95

    digits, lower = "0123456789", "abcdefghijklmnopqrstuvwxyz"
    looks = {"upper hex": (digits + "ABCDEF", 40), "base64": (digits + lower + lower.upper() + "+/", 40),
             "mixed": (digits + lower + lower.upper(), 36), "lower": (digits + lower, 32)}
    planted = [(name, "".join(draw.choice(a) for _ in range(n)))
               for name, (a, n) in looks.items() for _ in range(60)]
    texts = [(k, f"{prose(k, 7)} {value} {prose(k + 1, 5)}") for k, (_, value) in enumerate(planted)]
    found = secrets.find_secrets(spark.createDataFrame(texts, "doc_id long, text string"), network)
    hits = Counter()
    for row in found.collect():
        name, value = planted[row.doc_id]
        text = dict(texts)[row.doc_id]
        if any(s.kind == "model" and value in text[s.start:s.end] for s in row.spans):
            hits[name] += 1
    assert all(hits[name] >= 54 for name in looks), hits

    harmless = [(k, f"{prose(k, 5)} {value} {prose(k, 5)}") for k, value in enumerate(
        [str(uuid.UUID(int=draw.getrandbits(128), version=4)) for _ in range(40)]
        + ["".join(draw.choice(digits) for _ in range(16)) for _ in range(40)]
        + [".".join(prose(9000 + k, 5).split()) + ".example.com" for k in range(40)]
        + ["".join(prose(8000 + k, 7).split()) for k in range(40)])]
    wrong = secrets.find_secrets(
        spark.createDataFrame(harmless, "doc_id long, text string"), network).filter(
        "exists(spans, s -> s.kind = 'model')").count()
    assert wrong <= 8
    again = secrets.fit(docs.limit(300))
    assert abs(again.threshold - network.threshold) < 0.5


def test_network_learns_from_every_finding(spark, monkeypatch):
    rows = [(i, f"{prose(i, 5)} {'token = ' if i % 3 == 0 else ''}{10 ** 19 + i} {prose(i, 2)}")
            for i in range(900)]
    known = secrets._labelled_findings(
        spark.createDataFrame(rows, "doc_id long, text string")).distinct()
    assert known.count() == 900
    monkeypatch.setattr(secrets, "VARIED", 30)
    monkeypatch.setattr(secrets, "EPOCHS", 2)
    seen = []
    monkeypatch.setattr(secrets, "_averaged", lambda blocks, state, epoch: seen.append(
        blocks.applyInArrow(lambda block: pa.table({"n": [block.num_rows]}), "n long").collect())
        or state)
    secrets._fitted(known, 50, 0.98)
    held = known.filter(f"pmod(xxhash64(key, {secrets.SEED}), 4) = 0").count()
    assert len(seen) == 2 and sum(r.n for r in seen[0]) == 900 - held
    assert len(seen[0]) > 3 and max(r.n for r in seen[0]) < 300


def test_blocks_are_averaged_by_size_and_the_same_each_time(spark, monkeypatch):
    monkeypatch.setattr(secrets, "VARIED", 20)
    rows = [(i, f"{prose(i, 5)} {'token = ' if i % 3 == 0 else ''}{10 ** 19 + i}")
            for i in range(200)]
    known = secrets._labelled_findings(spark.createDataFrame(
        rows, "doc_id long, text string")).selectExpr(
        "*", "CAST(IF(key < 40, 0, 1) AS INT) AS block")
    state = secrets.Network().state()
    tables = [known.filter(f"block = {b}").toArrow() for b in (0, 1)]
    ends = [secrets.Network().learn_once(*secrets._examples(t, False, 20), state, 0)
            for t in tables]
    for _ in range(2):
        got = secrets._averaged(known.repartition(2, "block").groupBy("block"), state, 0)
        assert np.allclose(got, (ends[0] * 40 + ends[1] * 160) / 200, atol=1e-12)


def test_varied_findings_are_made_of_what_is_there():
    text = "erste worte hier 04dbebab91ab85687d33eeaaf9ac699e dann 1234567890123456 noch"
    seen = [secrets.window(text, *c) for c in secrets.scan(text)[1]]
    windows, labels = secrets.varied(seen, np.array([1, 0]), False, 50, 1)
    assert labels.sum() == 50 and len(windows) == 100
    assert {len(w) for w in windows} == {secrets.WIDTH}
    assert (windows, labels.tolist()) == tuple(
        x if isinstance(x, list) else x.tolist()
        for x in secrets.varied(seen, np.array([1, 0]), False, 50, 1)), "the same each time"
    held = secrets.varied(seen, np.array([1, 0]), True, 50, 1)[0]
    assert any(c in w for w in held[:50] for c in (b"-", b"_"))
