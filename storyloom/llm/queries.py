"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from storyloom.llm.common import read_table
from storyloom.llm.op1_lm_scoring import score_documents
from storyloom.llm.op2_ann import nearest
from storyloom.llm.op3_token_counts import token_counts
from storyloom.llm.op4_mixing import mix
from storyloom.llm.op5_toxicity import toxicity
from storyloom.llm.op6_simhash import near_duplicates
from storyloom.llm.op7_line_dedup import line_dedup
from storyloom.llm.op8_licences import KNOWN, HOLDER, NOT_WORD, SAME, licence_scan
from storyloom.llm.op9_exact_topk import top_products
from storyloom.llm.op10_sentencepiece import segmentations
from storyloom.llm.op11_hard_negatives import hard_negatives
from storyloom.llm.op12_prefix_trie import prefix_trie
from storyloom.llm.op13_sharding import shards


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = score_documents(read_table(spark, sf_dir, "documents"))
    return scores.select("doc_id", "n_words", F.round("score", 3).alias("score"), F.round("mean_log", 6).alias("mean_log"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licence_scan(read_table(spark, sf_dir, "documents"))
    return found.withColumn("line_licences", F.array_join("line_licences", ","))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(read_table(spark, sf_dir, "embeddings"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentations(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read_table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_scoring, op2_ann, op3_token_counts, op4_mixing, op5_toxicity, op6_simhash, op7_line_dedup, op8_licences,
        op9_exact_topk, op10_sentencepiece, op11_hard_negatives, op12_prefix_trie, op13_sharding,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

_KNOWN = ", ".join(
    "({}, {})".format(*("'" + x.replace("'", "''") + "'" for x in (name, text))) for name, texts in KNOWN.items() for text in texts
)

# CRC-32 of a string's UTF-8 bytes, with the table ``crc`` of one row and column joined.
_CRC_TABLE = """(SELECT list(e ORDER BY i) AS crc FROM (SELECT i,
      list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS e
      FROM range(256) r(i)))"""


def _crc32(text: str) -> str:
    byte = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {byte}), lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295)"


def _canonical(line: str) -> str:
    out = f"' ' || regexp_replace(lower({line}), '{NOT_WORD}', ' ', 'g') || ' '"
    for a, b in SAME:
        out = f"replace({out}, ' {a} ', ' {b} ')"
    return f"CASE WHEN regexp_matches(lower({line}), '{HOLDER}') THEN '' ELSE trim(regexp_replace({out}, '  +', ' ', 'g')) END"


ORACLES: dict[str, str] = {
    "op1_lm_scoring": rf"""
WITH w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM
           (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), {_UPPER}, {_LOWER})")} AS ws FROM documents)),
g AS (SELECT *, lag(w) OVER (PARTITION BY doc_id ORDER BY pos) AS p FROM w),
c1 AS (SELECT w, count(*) AS n FROM w GROUP BY w),
c2 AS (SELECT p, w, count(*) AS n FROM g WHERE p IS NOT NULL GROUP BY p, w),
d0 AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id),
d1 AS (SELECT doc_id, w, count(*) AS n FROM w GROUP BY doc_id, w),
d2 AS (SELECT doc_id, p, w, count(*) AS n FROM g WHERE p IS NOT NULL GROUP BY doc_id, p, w),
x AS (SELECT g.doc_id, g.p, c1.n - d1.n AS n1, coalesce(c2.n - d2.n, 0) AS n2, q1.n - e1.n AS before,
             (SELECT count(*) FROM w) - d0.n AS n0
      FROM g JOIN c1 ON c1.w = g.w JOIN d1 ON d1.doc_id = g.doc_id AND d1.w = g.w JOIN d0 ON d0.doc_id = g.doc_id
      LEFT JOIN c2 ON c2.p = g.p AND c2.w = g.w LEFT JOIN d2 ON d2.doc_id = g.doc_id AND d2.p = g.p AND d2.w = g.w
      LEFT JOIN c1 q1 ON q1.w = g.p LEFT JOIN d1 e1 ON e1.doc_id = g.doc_id AND e1.w = g.p),
s AS (SELECT doc_id, count(*) AS n, sum(CASE WHEN n2 > 0 THEN ln(n2 / before)
             ELSE (CASE WHEN p IS NULL THEN 0 ELSE ln(0.4) END) + (CASE WHEN n1 > 0 THEN ln(n1 / n0) ELSE -ln(n0 + 1) END) END) AS t
      FROM x GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, round(coalesce(t, 0), 3) AS score, round(t / n, 6) AS mean_log
FROM documents d LEFT JOIN s USING (doc_id)""",
    "op4_mixing": f"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), '42')) AS k
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
      FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY 3 * source_size / w, w, source NULLS LAST) AS j FROM s),
c AS (SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
             sum(w) OVER (ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
             (SELECT sum(source_size) FROM s) AS total FROM r),
lam AS (SELECT (total - fixed)::DOUBLE / open_w::DOUBLE AS share FROM c
        WHERE (total - fixed)::DOUBLE / open_w::DOUBLE * w <= 3 * source_size ORDER BY j LIMIT 1),
t AS (SELECT s.source, source_size, least(share * w::DOUBLE, (3 * source_size)::DOUBLE) AS target FROM s, lam),
x AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + least(greatest(floor(target)::BIGINT - epochs * source_size - before, 0), size))::BIGINT AS taken
FROM x""",
    "op7_line_dedup": rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_UPPER}, {_LOWER}) AS key FROM l),
s AS (SELECT key, min(doc_id) AS keep FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, s.keep IS NOT NULL AND s.keep <> doc_id AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op8_licences": rf"""
WITH u AS (SELECT doc_id, pos, {_canonical("line")} AS c FROM
           (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
k AS (SELECT licence, i, {_canonical("line")} AS c, pos FROM
      (SELECT licence, i, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos
       FROM (SELECT col0 AS licence, col1 AS t, row_number() OVER () AS i FROM (VALUES {_KNOWN}) v(col0, col1)))),
kt AS (SELECT c, min(licence) AS licence FROM
       (SELECT licence, i, string_agg(c, ' ' ORDER BY pos) AS c FROM k WHERE c <> '' GROUP BY licence, i) GROUP BY c),
t AS (SELECT doc_id, string_agg(c, ' ' ORDER BY pos) AS c FROM u WHERE c <> '' GROUP BY doc_id),
l AS (SELECT u.doc_id, string_agg(DISTINCT kt.licence, ',' ORDER BY kt.licence) AS found, count(*) AS n
      FROM u JOIN kt ON u.c = kt.c GROUP BY u.doc_id)
SELECT d.doc_id, sha256(coalesce(t.c, '')) AS text_digest, kt.licence AS text_licence,
       coalesce(l.found, '') AS line_licences, coalesce(l.n, 0)::BIGINT AS n_lines
FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN kt ON kt.c = t.c LEFT JOIN l ON l.doc_id = d.doc_id""",
    "op9_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM p QUALIFY rank <= 5""",
    "op11_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
           WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5""",
    "op12_prefix_trie": f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                  md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))), strlen(coalesce(text, ''))) AS i,
                  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t), {_CRC_TABLE}),
r AS (SELECT c.conv_id, t.i, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.i <= h
      UNION ALL SELECT c.conv_id, t.i, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > h),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS d, md5(concat(strlen(role), ':', role, text)) AS m, strlen(text) AS bytes FROM r),
p AS (SELECT conv_id, d, bytes, md5(string_agg(m, '') OVER (PARTITION BY conv_id ORDER BY d)) AS k FROM o
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
e AS (SELECT conv_id, max(d) AS d, arg_max(k, d) AS k FROM p GROUP BY conv_id),
n AS (SELECT d, k, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs FROM p GROUP BY d, k),
u AS (SELECT a.d, a.k, b.k AS up FROM n a LEFT JOIN p b ON b.conv_id = a.conv_id AND b.d = a.d - 1),
ch AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM u WHERE up IS NOT NULL GROUP BY ALL),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (d, k)),
sub AS (SELECT p.d, p.k, count(*) FILTER (w.n_children = 0) AS n_leaves, sum((w.n_convs - 1) * w.bytes)::BIGINT AS saved_tokens
        FROM w JOIN p ON p.conv_id = w.conv_id AND p.d <= w.d GROUP BY ALL),
f AS (SELECT d, k, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM e GROUP BY d, k)
SELECT w.conv_id, w.d::BIGINT AS depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children, sub.n_leaves, sub.saved_tokens,
       coalesce(f.ends_sha256, sha256('')) AS ends_sha256
FROM w JOIN u USING (d, k) LEFT JOIN n up ON up.d = w.d - 1 AND up.k = u.up JOIN sub USING (d, k) LEFT JOIN f USING (d, k)""",
    "op13_sharding": f"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {_crc32("coalesce(text, '')")} AS text_crc32,
                  ('0x' || md5(coalesce(text, ''))[1:10])::BIGINT AS grp, ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:5])::BIGINT AS own
           FROM documents, {_CRC_TABLE}),
s AS (SELECT *, sum(size) OVER w - size AS start, row_number() OVER w AS place FROM d
      WINDOW w AS (ORDER BY grp, own, doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING)),
g AS (SELECT *, min(start) OVER (PARTITION BY grp) AS g_start, sum(size) OVER (PARTITION BY grp) AS g_size, (SELECT sum(size) FROM d) AS total FROM s),
x AS (SELECT *, least(CASE WHEN g_size * 256 <= total THEN 2 * g_start + g_size ELSE 2 * start + size END * 8 // (2 * total), 7)::INTEGER AS shard FROM g)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       (place - min(place) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM x""",
}
