"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bagminhash, bpe, chat, langid, line_dedup, packing, pii, quality, rabitq
from .common import crc32_of_id, table

VOCABULARY = "byte_bpe_50k.json"


def _vocabulary() -> str:
    return public_tokenizers.path(VOCABULARY)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), _vocabulary())


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(table(spark, sf_dir, "documents"))


def op4_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc32_of_id() % 3 == 1
    model = quality.learn(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out))
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), _vocabulary())


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok").alias("text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.format_digests(rows.unionByName(more))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc32_of_id() % 5 == 0
    model = langid.learn(docs.where(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_packing": op2_packing,
        "op3_pii": op3_pii,
        "op4_bagminhash": op4_bagminhash,
        "op5_rabitq": op5_rabitq,
        "op6_ann": op6_ann,
        "op7_quality": op7_quality,
        "op8_bpe": op8_bpe,
        "op9_chat": op9_chat,
        "op10_langid": op10_langid,
    }


# Links between all vectors, and the smallest id that a walk over links reaches.
RABITQ_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM v),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.9),
reach AS (SELECT vec_id, vec_id AS least FROM embeddings UNION SELECT l.a, r.least FROM reach r JOIN links l ON l.b = r.vec_id WHERE r.least < l.a),
parts AS (SELECT vec_id, min(least) AS component_id FROM reach GROUP BY 1),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, p.component_id, e.vec_id = p.component_id AS kept
FROM embeddings e JOIN parts p ON p.vec_id = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""

# What the output of the template says once it is read back, from the rows themselves.
CHAT_SQL = """
WITH rows0 AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
told AS (SELECT *, replace(replace(replace(text, '\\', '\\\\'), '###', '\\###'), '</turn>', '\\</turn>') AS escaped FROM rows0)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ') + length(role) + length(':') + 1 + length(escaped) + length('</turn>') + 1)::BIGINT AS formatted_chars
FROM told GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.ORACLE_SQL, "op5_rabitq": RABITQ_SQL, "op9_chat": CHAT_SQL}
