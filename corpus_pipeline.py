"""The corpus pipeline: quality, line dedup, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept
and returns a DataFrame; run() writes each stage's rows to the shared folder and
reads them again as the next one's docs. All stages but the last return the
columns of documents (n_chars follows the text, null texts become empty). Line
dedup never removes a document: one that loses all its lines stays as an empty
text, and the near-duplicate stage keeps one of those.

ORACLE_SQL is None: the classifier, the tagger, the signatures and the tokenizer
can't be written in SQL; tests/llm holds each stage against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import bagminhash, line_dedup, packing, pii, quality
from tidecast.llm.common import Scratch, crc32_of_id, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
KEPT = ("lang", "source")
VOCABULARY = "byte_bpe_50k.json"
ORACLE_SQL = None


def _documents(df: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return df.select("doc_id", text.alias("text"), *KEPT, F.length(text).cast("long").alias("n_chars"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.5. Labels of the held-out fold are not learned from."""
    known = crc32_of_id() % 3 != 1
    model = quality.learn(docs.where(known), table(spark, sf_dir, "labels").where(known))
    return _documents(quality.score(docs, model, ("text", *KEPT)).where("score >= 0.5"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of recurring templates, long passages and short lines, their first occurrence kept."""
    return _documents(line_dedup.dedup_lines(docs, KEPT))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    return _documents(bagminhash.keep_one(docs))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind in brackets."""
    return _documents(pii.redact(docs, KEPT))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document in a training sequence."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the rows of the last."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return docs
