"""Workers that do not have this package installed."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
sys.path.insert(0, sys.argv[1] + "/tests/llm")
import public_tokenizers
from callstrata.session import local_session
from callstrata.llm import (bag_search, group_prefix_join, language_id, piece_codec,
                            prefix_trie, quality, repeat_trees, secrets, token_files, word_bpe)
from conftest import SCHEMA, awkward_rows

spark = local_session("2", "bare-workers")

def found(_):
    try:
        import callstrata
        return [1]
    except ModuleNotFoundError:
        return [0]

assert spark.sparkContext.parallelize([0], 1).flatMap(found).collect() == [0]
docs = spark.createDataFrame(awkward_rows(), SCHEMA)
path = public_tokenizers.path
items = docs.selectExpr("doc_id AS item_id", "text")
labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS quality").filter("doc_id > 0")
talks = docs.selectExpr("doc_id AS conv_id", "size AS turn", "lang AS role", "text")
for report in (
        token_files.token_digests(docs, path("byte_bpe_50k.json"), 50_257),
        secrets.secret_report(docs),
        piece_codec.encoded_documents(docs, path("piece_bpe_32k.model")),
        quality.quality_scores(docs, labels),
        language_id.identify(docs),
        group_prefix_join.near_duplicates(docs),
        repeat_trees.without_repeats(docs),
        bag_search.search(docs, items),
        word_bpe.round_trip_digests(docs, path("word_bpe_49k.json")),
        prefix_trie.trie(talks)):
    assert report.count() > 0
print("all ran")
"""


def test_operators_run_on_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    kept = [p for p in os.environ.get("PYTHONPATH", "").split(":")
            if p and Path(p).resolve() != REPO and not (Path(p) / "callstrata").exists()]
    if kept:
        env["PYTHONPATH"] = ":".join(kept)
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    done = subprocess.run([sys.executable, str(script), str(REPO)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=900)
    assert "all ran" in done.stdout, done.stderr[-3000:]
