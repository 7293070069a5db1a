"""Each operator against a plain version, on awkward rows and on an empty table."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from callstrata.llm import (common, components, digest_index, group_prefix_join,
                            language_id, piece_codec, quality, repeat_trees, secrets, splitters,
                            token_files, winnowing)
from callstrata.session import fresh_path

from .conftest import SCHEMA, awkward_rows, near, prose

ROWS = [(r[0], r[1]) for r in awkward_rows()]
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def multiset(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def test_token_files_equal_the_library(awkward, none, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    got = sorted(token_files.token_digests(awkward, BPE, 50_257).collect(),
                 key=lambda r: r.start)
    at = 0
    expected = Counter()
    for doc_id, text in ROWS:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        expected[(doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    for row in got:
        assert row.start == at
        at += row.n_tokens
    keys = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys)
    assert token_files.token_digests(none, BPE, 50_257).count() == 0


def test_sequences_are_of_equal_length_and_read_at_random(spark, tmp_path):
    docs = spark.createDataFrame([(i, prose(i, 900)) for i in range(40)],
                                 "doc_id long, text string").coalesce(1)
    folder = str(tmp_path / "tokens")
    manifest = token_files.write_token_files(docs, folder, BPE, 50_257, length=128).collect()
    total = 0
    for row in manifest:
        file = token_files.SequenceFile(f"{folder}/{row.tokens_file}")
        every = np.concatenate([file[i][0] for i in reversed(range(len(file)))][::-1])
        masks = np.concatenate([file[i][1] for i in range(len(file))])
        assert every.dtype == np.uint16 and len(every) == 128 * len(file)
        assert masks.sum() == row.n_tokens and masks[:row.n_tokens].all()
        middle = np.concatenate(list(file.span(100, 9000)))
        assert (middle == every[100:9100]).all()
        total += row.n_tokens
    assert total == sum(r.n_tokens for r in manifest) > 128 * 64


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_shards_are_even_and_slots_gapless(spark, shards):
    rows = [(i % 7 if i < 900 else i, prose(i, i % 40) if i % 3 else "hot " * 30)
            for i in range(3000)] + [(None, None)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = splitters.shard(docs, shards).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    share = sum(sizes.values()) / shards
    assert set(sizes) == set(range(shards))
    largest = max(r.size for r in got)
    assert all(abs(v - share) <= 0.02 * share + 2 * largest for v in sizes.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_of_few_or_no_rows(awkward, none):
    assert splitters.shard(awkward, 24).count() == len(ROWS)
    assert splitters.shard(none, 24).count() == 0


def test_shards_are_written_in_order(spark, tmp_path):
    docs = spark.createDataFrame([(i, prose(i, 20), "k") for i in range(200)],
                                 "doc_id long, text string, source string")
    splitters.write_shards(docs, 4, str(tmp_path / "shards"), rows_per_file=10)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert {"doc_id", "text", "source", "shard", "slot"} <= set(back.columns)
    assert back.count() == 200


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    size = min(5, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) \
        if words else frozenset()


def plain_components(rows):
    sets = [plain_shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[label[k]] = min(doc_id, least.get(label[k], doc_id))
    return Counter((doc_id, len(sets[k]), least.get(label[k]))
                   for k, (doc_id, _) in enumerate(rows))


def test_jaccard_join_finds_every_link(spark, awkward, none):
    names = ("doc_id", "n_shingles", "component_id")
    assert multiset(group_prefix_join.near_duplicates(awkward), *names) == plain_components(ROWS)
    rows = []
    for family in range(12):
        base = prose(100 + family, 20 + 12 * family)
        rows += [(len(rows) + k, near(base, 7 * family + k, k % 9)) for k in range(14)]
    shared = prose(999, 40)
    rows += [(len(rows) + k, shared + " " + prose(2000 + k, 30)) for k in range(60)]
    rows += [(len(rows) + k, prose(3, 6) if k % 2 else "tie tie tie tie tie tie") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert multiset(group_prefix_join.near_duplicates(docs), *names) == plain_components(rows)
    assert group_prefix_join.near_duplicates(none).count() == 0
    stay = group_prefix_join.one_of_each(awkward)
    assert stay.columns == awkward.columns
    assert sorted(r.doc_id for r in stay.collect() if r.doc_id) == sorted(
        {c for d, _, c in plain_components(ROWS) if d is not None})


def test_near_copy_without_id_links_two_documents(spark):
    words = prose(500, 60).split()
    edited = ["x%d" % i for i in range(6)]
    rows = [(1, " ".join(edited + words[6:])), (None, " ".join(words)),
            (2, " ".join(words[:-6] + edited)), (None, prose(501, 40)), (3, prose(502, 40))]
    assert plain_components(rows)[(2, 56, 1)] == 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = multiset(group_prefix_join.near_duplicates(docs), "doc_id", "n_shingles",
                   "component_id")
    assert got == plain_components(rows)


def test_only_copies_leave_under_one_id(spark):
    base = prose(510, 120)
    rows = [(1, base), (2, near(base, 1, 2)), (2, prose(511, 60)), (2, prose(512, 60)),
            (1, near(base, 2, 2)), (3, prose(513, 60)), (3, prose(513, 60)), (4, ""), (4, "  "),
            (4, None), (None, base), (None, prose(514, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = multiset(group_prefix_join.one_of_each(docs), "doc_id", "text")
    kept = [(i, t) for i, t in got if i == 1]
    assert len(kept) == 1 and kept[0] in rows
    assert got - Counter(kept) == Counter(
        [rows[2], rows[3], rows[5], *rows[7:12]])


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long"))
               .select("node", "component").collect())
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}}


def test_secret_scan_keeps_base_findings(awkward, none):
    for row in secrets.secret_report(awkward).collect():
        texts = {sha_of(t) for i, t in ROWS if i == row.doc_id}
        assert (row.n_assign, row.n_access, row.n_hex, row.base_sha256) in texts
    assert secrets.secret_report(none).count() == 0


def sha_of(text):
    text = text or ""
    found = []
    for kind, pattern, group, least in (
            ("assign", secrets.ASSIGN, 2, 6), ("access", secrets.ACCESS, 0, 20),
            ("hex", secrets.HEX, 0, 24)):
        found += [(m.start(), secrets.KINDS.index(kind), m.end())
                  for m in pattern.finditer(text) if len(m[group]) >= least]
    found.sort()
    n = Counter(k for _, k, _ in found)
    return n[0], n[1], n[2], sha(",".join(
        f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in found))


def test_network_learns_what_keys_look_like():
    draw = np.random.default_rng(1)
    keys = ["".join(draw.choice(list("0123456789abcdef"), 40)) for _ in range(300)]
    cards = ["".join(draw.choice(list("0123456789"), 16)) for _ in range(300)]
    texts = [f"{prose(i, 6)} {t} {prose(i, 3)}" for i, t in enumerate(keys + cards)]
    seen = [secrets.window(t, *secrets.scan(t)[1][0]) for t in texts]
    labels = np.array([1] * 300 + [0] * 300)
    network = secrets.Network()
    pick = draw.random(600) < 0.75
    network.learn([s for s, p in zip(seen, pick) if p], labels[pick])
    network.calibrate([s for s, p in zip(seen, pick) if not p], labels[~pick], 0.98)
    said = network.probabilities([s for s, p in zip(seen, pick) if not p]) >= network.threshold
    assert (said == (labels[~pick] == 1)).mean() > 0.95


def test_network_sees_all_of_a_long_run(spark):
    draw = np.random.default_rng(2)
    key = lambda: "".join(draw.choice(list("0123456789abcdef"), 40))
    rows = [(i, f"{prose(i, 6)} {key()} {prose(i, 3)} /{'/'.join(prose(i, 12).split())}")
            for i in range(300)]
    path = "/".join(prose(7, 30).split())
    network = secrets.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    assert 0 < network.threshold <= 1 and network.precision > 0.9
    # by hand: five Z in a row
    network.weights = {k: np.zeros_like(v) for k, v in network.weights.items()}
    network.weights["embed"][ord("Z"), 0] = 1
    network.weights["conv"][::secrets.EMBEDDED, 0] = 1
    network.weights["conv_bias"][0] = -4.5
    network.weights["out"][0, 1], network.weights["out_bias"][1] = 100, -20
    network.temperature, network.threshold = 1.0, 0.5
    secret = "Z" * 20
    texts = [f"{path}/{secret}/{path}", f"{path}/{secret}/{key()}/{path}/{secret}/{path}",
             f"{secret}", f"{key()}/{secret}"]
    for text, row in zip(texts, secrets.find_secrets(spark.createDataFrame(
            list(enumerate(texts)), "doc_id long, text string").coalesce(1), network).collect()):
        said = [text[s.start:s.end] for s in row.spans if s.kind == "model"]
        assert sum(x.count(secret) for x in said) == text.count(secret)


def test_rare_findings_teach_the_network(spark):
    rows = [(i, f"{prose(i, 3)} 12345678901234567{i}") for i in range(3000)]
    rows[1700] = (1700, "token = 04dbebab91ab85687d33eeaaf9ac699e1188f962")
    rows[40] = (40, "secret = 8d6f0aab91ab85687d33eeaaf9ac699e11aa0317")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    network = secrets.fit(docs, findings=50)
    assert network.threshold <= 1


def test_recall_alone_sets_the_threshold():
    network = secrets.Network()
    network.logits = lambda windows: np.array([-3.0, -2.0, 1.0, 2.0, -5.0, -6.0, 0.0, -4.0])
    network.calibrate([b""] * 8, np.array([1, 1, 1, 1, 0, 0, 0, 0]), 0.98)
    assert network.threshold < 0.5 and network.precision == 0.8


def test_pieces_take_texts_in_parts():
    import pyarrow as pa

    sizes = []

    class Column:
        def __init__(self, values):
            self.values = values

        def __len__(self):
            return len(self.values)

        def slice(self, first, size):
            return Column(self.values.slice(first, size))

        def to_pylist(self):
            sizes.append(len(self.values))
            return self.values.to_pylist()

    texts = [None, *map(str, range(1, 1203))]
    parts = list(piece_codec.in_parts(Column(pa.array(texts))))
    assert [first for first, _ in parts] == [0, 500, 1000] and max(sizes) == 500
    assert [t for _, part in parts for t in part] == texts


def test_pieces_equal_the_library_and_decode(spark, awkward, none):
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as proto

    codec = piece_codec.PieceCodec.from_model(PIECES)
    model = proto.ModelProto()
    with open(PIECES, "rb") as source:
        model.ParseFromString(source.read())
    score = dict(zip(codec.ids, codec.scores))
    for i, piece in enumerate(model.pieces):
        piece.score = score.get(i, piece.score)
    model.trainer_spec.model_type = 1
    library = SentencePieceProcessor(model_proto=model.SerializeToString())
    cost = lambda ids: sum(score.get(i, 0.0) for i in ids)
    for _, text in ROWS:
        if text and piece_codec.MARK not in text:
            mine = np.frombuffer(codec.encode(text), "<i4").tolist()
            theirs = library.encode(text)
            assert mine == theirs or cost(mine) == pytest.approx(cost(theirs), rel=1e-6)
    rows = piece_codec.encoded_documents(awkward, PIECES).collect()
    assert len(rows) == len(ROWS) and all(r.round_trip for r in rows)
    back = piece_codec.decode(piece_codec.encode(awkward, codec), codec)
    assert multiset(back, "doc_id", "text") == Counter(ROWS)
    assert piece_codec.encoded_documents(none, PIECES).count() == 0


def plain_contamination(text, items):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: pattern.findall(
        re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = split(text), set(), set()
    for item_id, item in items:
        w = split(item)
        n = min(13, len(w))
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for s in range(len(words) - n + 1):
            if tuple(words[s:s + n]) in windows:
                hit.update(range(s, s + n))
                if item_id is not None:
                    found.add(str(item_id))
    return (len(words), len(hit), len(found), sha(",".join(sorted(found))),
            bool(hit) and 20 * len(hit) >= len(words))


def test_winnowing_finds_every_window(awkward, none, items):
    known = [tuple(r) for r in items.collect()]
    got = multiset(winnowing.contamination(awkward, items), "doc_id", "n_words", "n_hit",
                   "n_items", "items_sha256", "contaminated")
    assert got == Counter((i, *plain_contamination(t, known)) for i, t in ROWS)
    assert any(k[2] for k in got)
    assert winnowing.contamination(none, items).count() == 0
    clean = winnowing.contamination(awkward, items.filter("false"))
    assert clean.filter("contaminated OR n_hit > 0").count() == 0


def test_decontamination_judges_each_text_of_an_id(spark, items):
    dirty = prose(3, 30)
    rows = [(None, dirty), (None, prose(40, 50)), (None, None), (5, dirty), (5, prose(41, 50)),
            (6, dirty), (7, prose(42, 50)), (7, prose(42, 50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert multiset(winnowing.decontaminated(docs, items), "doc_id", "text") == Counter(
        (i, t) for i, t in rows if t != dirty)


def plain_repeats(rows):
    first = {}
    split = [(float("inf") if i is None else i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for s in range(len(w) - 49):
            key = tuple(w[s:s + 50])
            first[key] = min(first.get(key, i), i)
    out = Counter()
    for (doc_id, _), (i, w) in zip(rows, split):
        gone = {p for s in range(len(w) - 49) if first[tuple(w[s:s + 50])] < i
                for p in range(s, s + 50)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out[(doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("large", [1500, 2])
def test_repeats_are_removed(spark, awkward, none, large, monkeypatch):
    monkeypatch.setattr(repeat_trees, "LARGE_PART", large)
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert multiset(repeat_trees.without_repeats(awkward), *names) == plain_repeats(ROWS)
    passage = prose(77, 90)
    rows = [(i, " ".join([prose(i, i % 60), passage[i % 5 * 30:], prose(i + 50, 20)]))
            for i in range(60)] + [(60, "la " * 300), (61, "la " * 70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert multiset(repeat_trees.without_repeats(docs), *names) == plain_repeats(rows)
    assert repeat_trees.without_repeats(none).count() == 0


def test_digest_index_over_batches(spark, awkward, none):
    report = digest_index.exact_duplicates(awkward).collect()
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[sha(t or "")].append(i)
    for r in report:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    assert Counter(r.text_sha256 for r in report if r.kept) == Counter(dict.fromkeys(groups, 1))
    stay = digest_index.without_duplicates(awkward)
    assert stay.columns == awkward.columns
    assert Counter(sha(r.text or "") for r in stay.collect()) == Counter(dict.fromkeys(groups, 1))
    index = digest_index.DigestIndex(spark, fresh_path(spark, "index"), buckets=4)
    first = index.deduplicate(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")],
                                                    "doc_id long, text string"), 0).collect()
    again = digest_index.DigestIndex(spark, index.path, buckets=4).deduplicate(
        spark.createDataFrame([(9, "a"), (10, "c")], "doc_id long, text string"), 1).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in first) == [
        (1, 2, False), (2, 2, True), (3, 3, True)]
    assert sorted((r.doc_id, r.keep_id, r.kept, r.known) for r in again) == [
        (9, 2, False, True), (10, 10, True, False)]
    assert index.deduplicate(none, 2).count() == 0


def test_language_of_held_out_documents(spark, sf_dir, awkward, none):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out")
    assert held.filter("lang = lang_pred").count() >= 0.97 * held.count() > 0
    assert got.filter("score < 0 OR score > 1").count() == 0
    rows = language_id.identify(awkward).collect()
    assert len(rows) == len(ROWS)
    letterless = {i for i, t in ROWS if not any(map(str.isalpha, t or ""))}
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == letterless
    assert language_id.identify(none).count() == 0
    assert set(language_id.accepted(awkward).columns) == set(awkward.columns)


def test_language_does_not_depend_on_labels_of_the_row(spark):
    rows = [(i, prose(i, 30), "aa" if i % 2 else "bb") for i in range(90)]
    one = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = spark.createDataFrame([(1, rows[5][1], "zz")], "doc_id long, text string, lang string")
    pred = language_id.predict(texts, one).first()
    assert pred.lang_pred == "aa"


def test_quality_of_held_out_documents(spark, sf_dir, awkward, none):
    top = sf_dir.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{top}/labels.parquet")
    docs = spark.read.parquet(f"{top}/documents.parquet").join(labels.select("doc_id"), "doc_id")
    got = quality.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out")
    right = got.groupBy("quality").agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("share")).collect()
    assert len(right) == 2 and all(r.share > 0.95 for r in right)
    few = spark.createDataFrame([(7, 1), (9, 0), (4, None), (99, 1)], "doc_id long, quality int")
    rows = quality.quality_scores(awkward, few).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert quality.quality_scores(awkward, few.filter("quality = 1")).count() == len(ROWS)
    assert quality.quality_scores(none, few).count() == 0


def test_every_short_n_gram_of_a_word_is_a_feature():
    for word in ("a", "abcd", "Häßlich-漢字"):
        framed = f"<{word}>"
        pieces = [framed] + [framed[i:i + n] for n in (1, 2, 3, 4)
                             for i in range(len(framed) - n + 1)]
        assert Counter(quality.word_features(word)) == Counter(
            zlib.crc32(p.encode()) % quality.AGAIN for p in pieces)


def test_pipeline_applies_each_stage_to_what_is_left(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet")
             .select("item_id", "text").collect()]
    left = corpus_pipeline.recognised(spark, docs, sf_dir)
    rows = [(r.doc_id, r.text) for r in left.collect()]
    last = {}
    for i, t in rows:
        last[t or ""] = max(i, last.get(t or "", i))
    rows = [(i, t) for i, t in rows if last[t or ""] == i]
    stay = {c for _, _, c in plain_components(rows)}
    rows = [(i, t) for i, t in rows if i in stay]
    rows = {i for i, t in rows if not plain_contamination(t, items)[-1]}
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in got} == rows and len(got) == len(rows)
    assert all(r.round_trip for r in got)
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf_dir)
    assert empty.count() == 0


def test_near_dedup_takes_texts_in_small_batches(spark, tmp_path, monkeypatch):
    """All texts of a task in one Arrow batch were held several times at once."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, describe = spark.conf.get(setting), group_prefix_join._describe
    docs = spark.createDataFrame(
        [(i, " ".join(f"w{i}x{j}" for j in range(4000))) for i in range(400)],
        "doc_id bigint, text string").coalesce(1)

    def sized(batches):
        import os
        batches = list(batches)
        with open(f"{tmp_path}/{os.getpid()}", "w") as out:
            out.write(str(max(batch.nbytes for batch in batches)))
        yield from describe(iter(batches))

    monkeypatch.setattr(group_prefix_join, "_describe", sized)
    assert group_prefix_join.near_duplicates(docs).count() == 400
    assert 0 < max(int(p.read_text()) for p in tmp_path.iterdir()) < 2 * common.BATCH_BYTES
    assert spark.conf.get(setting) == before


def test_members_often_seen():
    rng = np.random.default_rng(3)
    for size in (0, 1, 7, 8, 5000):
        members = rng.integers(0, 900, size).astype(np.uint64)
        kinds, times = np.unique(members, return_counts=True)
        found, counts = group_prefix_join.often(members.copy())
        assert found.tolist() == kinds[times >= group_prefix_join.OFTEN].tolist()
        assert counts.tolist() == times[times >= group_prefix_join.OFTEN].tolist()


def test_languages_are_told_in_parts():
    import pyarrow as pa

    whole = pa.record_batch({"doc_id": list(range(2500))})
    parts = list(language_id.in_parts(iter([whole, whole.slice(0, 0)])))
    assert [part.num_rows for part in parts] == [1000, 1000, 500]
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([whole]))
