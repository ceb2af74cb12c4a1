"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embeddings, exact_dedup, katz, language, line_dedup, nbest, packing, prefix_trie, simhash, substring, toxicity, urls, whitening
from .common import id_crc, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

URL_RULES = [
    urls.Rule("block", "com/en/"),
    urls.Rule("allow", "example.com/en/7"),
    urls.Rule("allow", "net/de/"),
    urls.Rule("block", "example.net/de/8"),
    urls.Rule("block", "org/es/"),
]


def _fold(of: int):
    return F.pmod(id_crc(), F.lit(of))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.linked(table(spark, sf_dir, "embeddings"), 0.98)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op3_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.scored(table(spark, sf_dir, "documents"), _fold(7) == 2, order=3)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, _fold(4) != 2)
    found = language.predict(docs, model, "doc_id")
    return found.select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op6_nbest_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.segmentations(table(spark, sf_dir, "documents"), PIECES, 3, with_ids=False)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), BYTE_BPE, 2048)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), _fold(5) != 0)
    return toxicity.scored(docs, model).select("doc_id", (_fold(5) == 0).alias("held_out"), "score", "predicted")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), 2).select("doc_id", "fingerprint", "component_id")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_embedding_near_dedup, op2_url_filters, op3_katz_scoring, op4_substring_dedup, op5_language_id,
        op6_nbest_segmentation, op7_best_fit_packing, op8_toxicity, op9_exact_dedup, op10_simhash_near_dedup,
        op11_line_dedup, op12_embedding_whitening, op13_conversation_prefix_trie, pipeline,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_substring_dedup": OP4_SQL, "op9_exact_dedup": OP9_SQL, "op11_line_dedup": OP11_SQL, "op13_conversation_prefix_trie": OP13_SQL}


OP9_SQL = r"""
WITH norm AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM norm WINDOW w AS (PARTITION BY t)
"""

OP4_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS p FROM words WHERE len(ws) >= 50),
firsts AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY array_to_string(ws[p:p + 49], ' ')) AS first_id FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 49)) AS k FROM firsts WHERE first_id < doc_id),
each AS (SELECT doc_id, unnest(generate_series(1, len(ws))) AS k, unnest(ws) AS word FROM words WHERE len(ws) > 0),
kept AS (
  SELECT e.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY k) AS t
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.k = g.k GROUP BY e.doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

OP11_SQL = r"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(generate_series(1, len(ls))) AS k, unnest(ls) AS line FROM cut),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
common AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id < keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key) GROUP BY doc_id
"""

OP13_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS content,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(content)) AS pos FROM given),
crc AS (
  SELECT conv_id, list_reduce([4294967295::BIGINT] || [ascii(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')],
    lambda a, b: list_reduce([xor(a, b)] || [0::BIGINT FOR i IN range(8)], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))) AS x
  FROM (SELECT DISTINCT conv_id FROM given)
),
convs AS (SELECT conv_id, xor(x, 4294967295) % 4 AS h, conv_id - conv_id % 20 AS base FROM crc),
heads AS (SELECT c.conv_id, p.pos, p.content, p.words FROM convs c JOIN placed p ON p.conv_id = c.base AND p.pos <= c.h),
rebuilt AS (
  SELECT * FROM heads
  UNION ALL
  SELECT c.conv_id, p.pos - c.h + (SELECT count(*) FROM heads k WHERE k.conv_id = c.conv_id), p.content, p.words
  FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.pos > c.h
),
prefixes AS (
  SELECT conv_id, pos AS depth, words, string_agg(sha256(content), ' ') OVER w AS seq, max(pos) OVER (PARTITION BY conv_id) AS last
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
  UNION ALL
  SELECT conv_id, 0, 0, '', (SELECT coalesce(max(pos), 0) FROM rebuilt r WHERE r.conv_id = c.conv_id) FROM convs c
),
nodes AS (
  SELECT depth, seq, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = last), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, seq
),
children AS (
  SELECT DISTINCT c.depth, c.seq, p.seq AS parent_seq FROM prefixes c JOIN prefixes p ON p.conv_id = c.conv_id AND p.depth = c.depth - 1
),
counted AS (
  SELECT n.*, (SELECT count(*) FROM children c WHERE c.depth = n.depth + 1 AND c.parent_seq = n.seq) AS n_children FROM nodes n
),
under AS (
  SELECT a.depth, a.seq, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved_tokens
  FROM counted b JOIN prefixes a ON a.conv_id = b.conv_id AND a.depth <= b.depth GROUP BY a.depth, a.seq
)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, n.n_children, u.n_leaves::BIGINT AS n_leaves, u.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN under u USING (depth, seq)
LEFT JOIN children c USING (depth, seq) LEFT JOIN nodes q ON q.depth = n.depth - 1 AND q.seq = c.parent_seq
"""
