"""The operators' queries, by name, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from callstrata.llm.bag_search import search
from callstrata.llm.common import table
from callstrata.llm.digest_index import exact_duplicates
from callstrata.llm.group_prefix_join import near_duplicates
from callstrata.llm.language_id import identify
from callstrata.llm.piece_codec import encoded_documents
from callstrata.llm.prefix_trie import trie
from callstrata.llm.quality import quality_scores
from callstrata.llm.repeat_trees import without_repeats
from callstrata.llm.secrets import secret_report
from callstrata.llm.splitters import shard
from callstrata.llm.token_files import token_digests
from callstrata.llm.winnowing import contamination
from callstrata.llm.word_bpe import round_trip_digests
from callstrata.verification.registry import Registry

_registry = Registry()
QUERIES = _registry.queries
SQL = _registry.sql
query = _registry.query


@query()
def op1_token_files(spark, sf_dir):
    return token_digests(table(spark, sf_dir, "documents"),
                         public_tokenizers.path("byte_bpe_50k.json"), 50_257)


@query()
def op2_sampled_splitters(spark, sf_dir):
    return shard(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query()
def op3_group_prefix_join(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op4_secret_network(spark, sf_dir):
    return secret_report(table(spark, sf_dir, "documents"))


@query()
def op5_piece_codec(spark, sf_dir):
    return encoded_documents(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("piece_bpe_32k.model"))


@query(r"""
WITH
  split_docs AS (
    SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
  split_items AS (
    SELECT item_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
  item_starts AS (
    SELECT item_id, w, least(len(w), 13) AS n,
           unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s
    FROM split_items WHERE len(w) > 0),
  item_windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM item_starts),
  sizes AS (SELECT DISTINCT n FROM item_windows),
  doc_starts AS (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM split_docs, sizes
    WHERE len(w) >= n),
  doc_windows AS (
    SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win FROM doc_starts),
  found AS (
    SELECT d.doc_id, d.n, d.s, i.item_id FROM doc_windows d JOIN item_windows i
    ON d.n = i.n AND d.win = i.win),
  hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
      SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, n, s FROM found))
    GROUP BY doc_id),
  listed AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
    FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM split_docs LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
""")
def op6_winnowing(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(r"""
WITH
  split_docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
  starts AS (
    SELECT doc_id, unnest(range(1, len(w) - 48)) AS s, w FROM split_docs WHERE len(w) >= 50),
  windows AS (SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS win FROM starts),
  late AS (
    SELECT doc_id, s FROM (
      SELECT doc_id, s, min(doc_id) OVER (PARTITION BY win) AS least FROM windows)
    WHERE least < doc_id),
  gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM late),
  places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p
             FROM split_docs),
  kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS words, count(*) AS n
    FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM split_docs LEFT JOIN kept USING (doc_id)
""")
def op7_repeat_trees(spark, sf_dir):
    return without_repeats(table(spark, sf_dir, "documents"))


@query("""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY sha256(coalesce(text, '')))
""")
def op8_digest_index(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("known")


@query()
def op9_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


@query()
def op10_quality(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(r"""
WITH
  words AS (
    SELECT doc_id, row_number() OVER () AS r, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
  item_terms AS (
    SELECT item_id, term, count(*) AS times FROM (
      SELECT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
    GROUP BY item_id, term),
  lengths AS (SELECT r, doc_id, count(*) AS n FROM words GROUP BY r, doc_id),
  totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM lengths),
  norms AS (SELECT r, doc_id, 75 + (25 * n * docs) // length AS m FROM lengths, totals),
  tfs AS (SELECT r, term, count(*) AS tf FROM words
          WHERE term IN (SELECT term FROM item_terms) GROUP BY r, term),
  weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals),
  scored AS (
    SELECT item_id, r, doc_id,
           sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM item_terms JOIN weights USING (term) JOIN tfs USING (term) JOIN norms USING (r)
    GROUP BY item_id, r, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id, r)::INTEGER AS rank
  FROM scored WHERE score > 0)
WHERE rank <= 20
""")
def op11_bag_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op12_word_bpe(spark, sf_dir):
    return round_trip_digests(table(spark, sf_dir, "documents"),
                              public_tokenizers.path("word_bpe_49k.json"))


@query("""
WITH
  own AS (
    SELECT conv_id, list(
      sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
      || ':' || strlen(coalesce(text, '')) ORDER BY turn NULLS FIRST) AS t
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
  -- unsigned crc32 of the decimal conv_id, bit by bit
  starts AS (
    SELECT conv_id, t, xor(list_reduce(
      list_concat([4294967295], list_transform(
        range(1, length(conv_id::VARCHAR) + 1), lambda i: ord((conv_id::VARCHAR)[i])::BIGINT)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
        lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
      4294967295) % 9 AS h
    FROM own),
  rebuilt AS (
    SELECT s.conv_id, list_concat(coalesce(b.t, [])[1:h], s.t[h + 1:]) AS t
    FROM starts s LEFT JOIN own b ON b.conv_id = s.conv_id - s.conv_id % 5),
  prefixes AS (
    SELECT conv_id, d, len(t) AS length, array_to_string(t[1:d], '|') AS node,
           array_to_string(t[1:d - 1], '|') AS parent,
           CASE WHEN d > 0 THEN split_part(t[d], ':', 2)::BIGINT ELSE 0 END AS bytes
    FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)),
  nodes AS (
    SELECT d, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n,
           (count(*) - 1) * any_value(bytes) AS saved,
           coalesce(string_agg(CASE WHEN length = d THEN conv_id::VARCHAR END, ','
                               ORDER BY conv_id), '') AS ends
    FROM prefixes GROUP BY d, node),
  children AS (SELECT d - 1 AS d, parent AS node, count(*) AS k FROM nodes WHERE d > 0 GROUP BY ALL),
  subtrees AS (
    SELECT a.d, a.node, sum(v.saved) AS saved,
           count(*) FILTER (WHERE c.k IS NULL) AS leaves
    FROM nodes v LEFT JOIN children c ON c.d = v.d AND c.node = v.node
    JOIN prefixes a ON a.conv_id = v.conv_id AND a.d <= v.d
    GROUP BY a.d, a.node)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs,
       coalesce(c.k, 0) AS n_children, s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM nodes n
LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.node = n.parent
LEFT JOIN children c ON c.d = n.d AND c.node = n.node
JOIN subtrees s ON s.d = n.d AND s.node = n.node
""")
def op13_prefix_trie(spark, sf_dir):
    return trie(table(spark, sf_dir, "conversations"))
