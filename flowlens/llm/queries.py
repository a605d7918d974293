"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import (
    bmw_search, bwt_dedup, byte_bpe, fm_dedup, hd_langid, html_extract, mil_quality, mixing,
    pq_neardup, preference, qd_whiten, simhash_cover, token_align)
from flowlens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.bpe_digest(table(spark, sf_dir, "documents"), BPE_RANKS,
                               public_tokenizers.PATTERN)


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return hd_langid.language_id(docs).select("doc_id", "held_out", "lang_pred", "score")


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_cover.simhash_groups(table(spark, sf_dir, "documents"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.substring_dedup(table(spark, sf_dir, "documents"))


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.byte_dedup(table(spark, sf_dir, "documents"))


ORACLE["op3_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') AS ws
  FROM documents),
win AS (
  SELECT doc_id, i, list_aggregate(ws[i:i + 12], 'string_agg', ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
low AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j
  FROM win JOIN low USING (k) WHERE m < doc_id),
words AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_single(table(spark, sf_dir, "documents"))


ORACLE["op4_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix-1:' || doc_id) AS ord,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source),
w AS (
  SELECT source, n, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w,
         sum(n) OVER () AS total FROM s),
l AS (
  SELECT *, coalesce(sum(2 * n) OVER below, 0) AS capped, sum(w) OVER above AS open
  FROM w WINDOW below AS (ORDER BY 2.0 * n / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                above AS (ORDER BY 2.0 * n / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
pick AS (
  SELECT capped, open FROM l WHERE w * (1.5 * total - capped) / open <= 2 * n
  ORDER BY 2.0 * n / w, source LIMIT 1),
t AS (
  SELECT source, n, least(2.0 * n, (w * (1.5 * total - pick.capped)) / pick.open) AS target
  FROM w, pick),
p AS (SELECT *, floor(target)::BIGINT // greatest(n, 1) AS copies,
             floor(target)::BIGINT % greatest(n, 1) AS rest FROM t),
o AS (
  SELECT doc_id, size, n, target, copies, rest,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY ord, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, n AS source_size, target::DOUBLE AS target,
       (size * (copies + CASE WHEN rest > 0 AND 2 * before + size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM o
"""


@query
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_neardup.embedding_groups(table(spark, sf_dir, "embeddings"))


@query
def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


@query
def op5_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id is divisible by 100, as a query on all."""
    docs = table(spark, sf_dir, "documents")
    return bmw_search.top_k(docs, docs.where("doc_id % 100 = 0"))


ORACLE["op5_top_k_search"] = r"""
WITH tok AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS term
  FROM documents WHERE doc_id IS NOT NULL),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
len AS (SELECT doc_id, count(*) AS n FROM tok GROUP BY doc_id),
stat AS (SELECT (SELECT count(*) FROM documents WHERE doc_id IS NOT NULL)::DOUBLE AS nd,
                (SELECT count(*) FROM tok)::DOUBLE AS total),
idf AS (SELECT term, ln(1.0 + (any_value(nd) - count(*) + 0.5) / (count(*) + 0.5)) AS idf
        FROM tf, stat GROUP BY term),
imp AS (
  SELECT tf.doc_id, term, tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / (total / nd))) AS impact
  FROM tf JOIN len USING (doc_id), stat),
hit AS (
  SELECT q.doc_id AS query_id, imp.doc_id, round(sum(q.tf * idf * impact), 6) AS score
  FROM tf q JOIN idf USING (term) JOIN imp USING (term)
  WHERE q.doc_id % 100 = 0 GROUP BY ALL)
SELECT query_id, doc_id, rank::INTEGER AS rank, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM hit)
WHERE rank <= 10
"""


@query
def op9_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.mismatched_pairs(table(spark, sf_dir, "conversations"))
    spans = {c: F.array_join(F.transform(f"{c}_mask", lambda s: F.concat_ws(
        "-", s["begin"], s["end"])), ",").alias(f"{c}_mask") for c in ("chosen", "rejected")}
    return preference.format_pairs(pairs, ("conv_id",)).select(
        "conv_id", "n_prompt_turns", "prompt", "chosen_text", "rejected_text", *spans.values())


ORACLE["op9_preference_format"] = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT conv_id, max(i) AS j FROM t WHERE role = 'assistant' GROUP BY conv_id),
answer AS (SELECT conv_id, t.text AS a, j FROM t JOIN last USING (conv_id) WHERE i = j),
pair AS (
  SELECT x.conv_id, x.j, x.a, y.a AS b FROM answer x LEFT JOIN answer y
  ON y.conv_id = xor(x.conv_id, 1)),
lead AS (
  SELECT conv_id, string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), ''
                             ORDER BY i) AS prompt
  FROM t JOIN pair p USING (conv_id) WHERE i < p.j + (a IS NOT DISTINCT FROM b)::INT
  GROUP BY conv_id)
SELECT conv_id, (j - (a IS DISTINCT FROM b)::INT)::INTEGER AS n_prompt_turns,
       coalesce(prompt, '') AS prompt,
       CASE WHEN a = b THEN '' ELSE '<|assistant|>' || chr(10) || a || '<|end|>' || chr(10) END AS chosen_text,
       CASE WHEN b IS NULL OR a = b THEN ''
            ELSE '<|assistant|>' || chr(10) || b || '<|end|>' || chr(10) END AS rejected_text,
       CASE WHEN a = b THEN '' ELSE '14-' || (14 + length(a)) END AS chosen_mask,
       CASE WHEN b IS NULL OR a = b THEN '' ELSE '14-' || (14 + length(b)) END AS rejected_mask
FROM pair LEFT JOIN lead USING (conv_id)
"""


@query
def op11_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mil_quality.quality(docs, table(spark, sf_dir, "labels"))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        a_json = f.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        b_model = f.read()
    return token_align.align_tokenizers(table(spark, sf_dir, "documents"), a_json, b_model)


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qd_whiten.whiten(table(spark, sf_dir, "embeddings"))
