"""The registered queries of this subpackage: each operator over whole tables, with its digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugelake.llm import (
    debruijn,
    decontaminate,
    licenses,
    lines,
    mixing,
    negatives,
    parity,
    personal,
    quality,
    resampling,
    secrets,
    suffixes,
    wavelet,
)
from gaugelake.llm.shared import importable

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents")).drop("text_hash")


def op2_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.pack_documents(_table(spark, sf_dir, "documents"), TOKENIZER)


def op3_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"), width=400).drop("kept")


def op4_smith_waterman_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents")).drop("copies")


def op6_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op7_license_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op8_bloom_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_repeated_lines(_table(spark, sf_dir, "documents"), documents=3, least=20).drop("kept_text")


def op9_parity_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.jaccard_components(_table(spark, sf_dir, "documents"), words=3, percent=90)[0].drop("node")


def op10_debruijn_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.remove_repeats(_table(spark, sf_dir, "documents"), k=35).drop("kept_text")


def op11_four_russians_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return negatives.mine(vectors, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low_percent=50, high_percent=95)


def op12_segment_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return resampling.resample(docs, target, percent=25, least_words=20, seed=7, buckets=10_000).drop("n_words")


def op13_anchor_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.summary(personal.find(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kneser_ney_quality": op1_kneser_ney_quality,
    "op2_wavelet_tokens": op2_wavelet_tokens,
    "op3_suffix_repeats": op3_suffix_repeats,
    "op4_smith_waterman_leaks": op4_smith_waterman_leaks,
    "op5_pareto_mix": op5_pareto_mix,
    "op6_entropy_secrets": op6_entropy_secrets,
    "op7_license_blocks": op7_license_blocks,
    "op8_bloom_lines": op8_bloom_lines,
    "op9_parity_components": op9_parity_components,
    "op10_debruijn_substrings": op10_debruijn_substrings,
    "op11_four_russians_negatives": op11_four_russians_negatives,
    "op12_segment_resampling": op12_segment_resampling,
    "op13_anchor_personal_data": op13_anchor_personal_data,
}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_LETTERED = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _sql_list(words: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words.split()) + "]"


def _license_sql() -> str:
    phrases = ", ".join(f"({_sql_list(p)}, '{label}')" for p, label in licenses.PHRASES)
    templates = ", ".join(f"({k}, '{label}', {_sql_list(t)})" for k, (label, t) in enumerate(licenses.TEMPLATES))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), {_LOWER}) AS t FROM documents),
words AS (SELECT r, doc_id, regexp_extract_all(t, {_LETTERED}) AS ws FROM docs),
phrases(p, label) AS (VALUES {phrases}),
templates(k, label, sentence) AS (VALUES {templates}),
starts AS (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM words),
places AS (SELECT r, i - 1 AS place, label FROM starts JOIN phrases ON ws[i:i + len(p) - 1] = p),
base AS (
  SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY r),
sizes AS (SELECT k, label, len(list_distinct(sentence)) AS n, 2 * len(sentence) AS width FROM templates),
members AS (SELECT DISTINCT k, unnest(sentence) AS w FROM templates),
tokens AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM words),
hits AS (SELECT r, k, w, i FROM tokens JOIN members USING (w)),
likely AS (
  SELECT r, k, any_value(n) AS n, any_value(width) AS width, any_value(label) AS label FROM hits JOIN sizes USING (k)
  GROUP BY r, k HAVING count(DISTINCT w) >= 0.9 * any_value(n) - 1e-9),
blocks AS (
  SELECT a.r, a.k, a.i, count(DISTINCT b.w) AS held
  FROM likely l JOIN hits a ON a.r = l.r AND a.k = l.k
    JOIN hits b ON b.r = a.r AND b.k = a.k AND b.i >= a.i AND b.i < a.i + l.width
  GROUP BY a.r, a.k, a.i),
shares AS (
  SELECT r, label, max(held)::DOUBLE / any_value(n) AS share FROM blocks JOIN likely USING (r, k) GROUP BY r, k, label),
found AS (
  SELECT r, label, share FROM shares WHERE share >= 0.9 - 1e-12 UNION ALL SELECT r, label, 1.0::DOUBLE FROM places),
named AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM found GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM words LEFT JOIN base USING (r) LEFT JOIN named USING (r)
"""


ORACLE_SQL: dict[str, str] = {
    "op5_pareto_mix": """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 13))::BIGINT AS bits
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size::HUGEINT * size)::DOUBLE AS squares FROM d GROUP BY source
), w AS (
  SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         source_size * 2 AS cap
  FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () * 150 / 100
             - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS spare
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)
), t AS (
  SELECT *, least(first_value(CASE WHEN spare * weight <= cap THEN spare END IGNORE NULLS) OVER (
                    ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                  * weight, cap)::DOUBLE AS shared
  FROM l
), r AS (
  SELECT source, source_size, squares, coalesce(shared, cap::DOUBLE) AS target,
         CASE WHEN source_size > 0 THEN floor(coalesce(shared, cap::DOUBLE) / source_size)::BIGINT ELSE 0 END AS whole
  FROM t
), e AS (
  SELECT d.doc_id, d.size, d.source, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size AS rest,
         (d.bits + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u,
         greatest(least(d.size * (r.target - r.whole * r.source_size) / greatest(r.squares, 1.0::DOUBLE),
                        (1 - 1e-9)::DOUBLE), 1e-300::DOUBLE) AS p
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
), q AS (
  SELECT *, (u / (1 - u)) * ((1 - p) / p) AS odds FROM e
), k AS (
  SELECT *, least(floor(odds / (1 + odds) * 281474976710656::DOUBLE)::BIGINT, 281474976710655) AS rank FROM q
), c AS (
  SELECT source, rank, sum(size) AS words, any_value(rest) AS rest,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY rank) AS upto
  FROM k WHERE size > 0 GROUP BY source, rank
), z AS (
  SELECT source, arg_min(CASE WHEN abs(upto - rest) < abs(upto - words - rest) THEN rank ELSE rank - 1 END, rank)
         AS last_rank
  FROM c WHERE upto >= rest GROUP BY source
)
SELECT k.doc_id, k.size, k.source_size, k.target,
       k.size * (k.whole + CASE WHEN k.rank <= coalesce(z.last_rank, -1) THEN 1 ELSE 0 END) AS taken
FROM k LEFT JOIN z ON k.source IS NOT DISTINCT FROM z.source
""",
    "op8_bloom_lines": """
WITH split AS (
  SELECT rowid_, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM split
), common AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT rowid_, doc_id, line, i, keeper IS NULL OR doc_id IS NOT DISTINCT FROM keeper AS stays
  FROM keyed LEFT JOIN common USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
FROM judged GROUP BY rowid_, doc_id
""",
    "op7_license_blocks": _license_sql(),
    "op9_parity_components": f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_SPACED}) AS ws
  FROM documents
), starts AS (
  SELECT r, ws, unnest(range(1, greatest(len(ws) - 2, least(len(ws), 1)) + 1)) AS i FROM docs
), shingles AS (SELECT DISTINCT r, array_to_string(ws[i:i + 2], ' ') AS s FROM starts),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s) WHERE a.r <> b.r GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y WHERE 100 * c >= 90 * (p.n + q.n - c)
), reach(x, y) AS (
  SELECT r, r FROM docs UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM docs d LEFT JOIN sizes USING (r) JOIN reach ON reach.x = d.r JOIN docs o ON o.r = reach.y GROUP BY d.r, d.doc_id
""",
    "op10_debruijn_substrings": f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS ws FROM documents
), starts AS (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM docs WHERE len(ws) >= 35),
windows AS (SELECT r, i, array_to_string(ws[i:i + 34], ' ') AS w FROM starts),
again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT r, i + k AS p
  FROM (SELECT r, i FROM windows SEMI JOIN again USING (w)), (SELECT unnest(range(35)) AS k)
), words AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM docs),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (r, p) GROUP BY r
), lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)
""",
    "op11_four_russians_negatives": """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, v.r, v.vec_id, a.label = v.label AS same,
         list_sum(list_transform(list_zip(a.q, v.q), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0)))::BIGINT AS score
  FROM v AS a JOIN v ON a.vec_id % 50 = 0 AND a.r <> v.r
), p AS (
  SELECT ar, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER w AS place FROM s WHERE same
  WINDOW w AS (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST) QUALIFY place <= 5
)
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY p.ar, place ORDER BY score DESC, vec_id NULLS LAST))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.ar = p.ar AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""",
}
