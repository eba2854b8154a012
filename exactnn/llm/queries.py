"""The registered queries of this package: operators with production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exactnn.llm import (
    adaptive_join,
    bwt_dedup,
    byte_cnn,
    decision_list,
    license_index,
    odd_minhash,
    pow2_packing,
    prefix_trie,
    resync_count,
    segment_topk,
    speculative_bpe,
    structural_secrets,
    token_alignment,
)

#: The file that the token operators are registered with; they take any byte-level BPE file.
BPE_FILE = "byte_bpe_50k.json"
#: The other side of the alignment; any piece model without spaces inside pieces.
PIECE_FILE = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _bpe() -> str:
    return public_tokenizers.path(BPE_FILE)


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    return byte_cnn.score_quality(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_index.scan_licenses(_table(spark, sf, "documents")).drop("matches")


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = pow2_packing.pack(_table(spark, sf, "documents"), _bpe(), keep_ids=False)
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op4_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return structural_secrets.digest(structural_secrets.scan_secrets(_table(spark, sf, "documents")))


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return resync_count.count_tokens(_table(spark, sf, "documents"), _bpe(), limit=512)


def op6_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return odd_minhash.near_duplicates(_table(spark, sf, "documents"), shingle_words=4)


def op7_repeated_strings(spark: SparkSession, sf: str) -> DataFrame:
    return bwt_dedup.removal_report(_table(spark, sf, "documents"), length=400)


def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return decision_list.quality_rules(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op9_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    return speculative_bpe.encode_round_trip(_table(spark, sf, "documents"), _bpe())


def op10_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings")
    return segment_topk.top_k(vectors.where(F.col("vec_id") % 20 == 0), vectors, k=20, scale=64.0)


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf, "conversations"))


def op12_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return adaptive_join.ngram_components(_table(spark, sf, "documents"), shingle_words=5)


def op13_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    aligned = token_alignment.align(_table(spark, sf, "documents"), _bpe(), public_tokenizers.path(PIECE_FILE))
    return aligned.drop("n_shared")


_QUERIES = (
    op1_quality, op2_license_scan, op3_packing, op4_secret_scan, op5_token_counts,
    op6_near_duplicates, op7_repeated_strings, op8_quality_rules, op9_bpe_round_trip, op10_exact_topk,
    op11_prefix_trie, op12_ngram_join, op13_token_alignment,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


_TOP_K_SQL = """
WITH v AS (
    SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS c
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, b.vec_id,
           CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.c, b.c)]) AS BIGINT) AS score
    FROM v q JOIN v b ON q.vec_id <> b.vec_id AND len(q.c) = len(b.c)
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT query_id, vec_id, score,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


#: Components of near-duplicates; SIZE words a shingle.
_NEAR_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= SIZE THEN list_transform(range(1, len(w) - SIZE + 2), lambda i: array_to_string(w[i:i + SIZE - 1], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
    WHERE 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
    GROUP BY a.doc_id, b.doc_id, p.n, q.n
    HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), reach(x, y) AS (
    SELECT x, y FROM links
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least_of AS (
    SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.y, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(l.y, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least_of l ON l.x = d.doc_id
"""


#: crc32, bit by bit, of the decimal digits.
_TRIE_SQL = """
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), counts AS (
    SELECT conv_id, count(*) AS n, xor(list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(
               string_split(CAST(conv_id AS VARCHAR), ''),
               lambda ch: [CAST(unicode(ch) AS UBIGINT), 0, 0, 0, 0, 0, 0, 0]))),
               lambda x, y: CASE WHEN xor(x, y) & 1 = 1 THEN xor(xor(x, y) >> 1, 3988292384::UBIGINT) ELSE xor(x, y) >> 1 END
           ), 4294967295::UBIGINT) % 6 AS h
    FROM t GROUP BY conv_id
), c AS (
    SELECT a.conv_id, CAST(a.h AS BIGINT) AS h, least(CAST(a.h AS BIGINT), coalesce(b.n, 0)) AS kept
    FROM counts a LEFT JOIN counts b ON b.conv_id = a.conv_id - a.conv_id % 100
), r AS (
    SELECT c.conv_id, t.pos AS place, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos < c.h
    UNION ALL
    SELECT c.conv_id, t.pos - c.h + c.kept, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h
), whole AS (
    SELECT c.conv_id, coalesce(list([role, text] ORDER BY place) FILTER (place IS NOT NULL), []) AS path
    FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id
), member AS (
    SELECT conv_id, d AS depth, path[:d] AS path, d = len(path) AS ends
    FROM whole, LATERAL (SELECT unnest(range(0, len(path) + 1)) AS d)
), node AS (
    SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM member GROUP BY depth, path
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM node k WHERE k.depth = n.depth + 1 AND k.path[:n.depth] = n.path) AS n_children
    FROM node n LEFT JOIN node p ON p.depth = n.depth - 1 AND p.path = n.path[:n.depth - 1]
), below AS (
    SELECT v.depth, v.path, count(*) FILTER (w.n_children = 0) AS n_leaves,
           sum(CASE WHEN w.depth = 0 THEN 0 ELSE (w.n_convs - 1) * length(w.path[w.depth][2]) END) AS saved_tokens
    FROM linked v JOIN linked w ON w.depth >= v.depth AND w.path[:v.depth] = v.path GROUP BY v.depth, v.path
)
SELECT l.conv_id, l.depth, l.parent_conv_id, l.n_convs, l.n_children, b.n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, l.ends_sha256
FROM linked l JOIN below b ON b.depth = l.depth AND b.path = l.path
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_near_duplicates": _NEAR_SQL.replace("SIZE", "4"), "op10_exact_topk": _TOP_K_SQL, "op11_prefix_trie": _TRIE_SQL,
        "op12_ngram_join": f"SELECT doc_id, n_shingles, component_id FROM ({_NEAR_SQL.replace('SIZE', '5')})",
    }
