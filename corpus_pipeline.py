"""The corpus pipeline: each stage applies a training-data operator to all that the one before kept.

Null texts count as empty throughout, repeated rows share a fate but in the near-dedup
stage, where rows of one id stay or go together, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transitloom.llm import bpe, decontam, jaccard, quality, secrets
from transitloom.llm.common import discard, materialize
from transitloom.llm.queries import RANKS


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; null and empty texts are judged by their zero statistics."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by SimHash or by five-word shingles the one with the smallest id; empty texts are one group, rows without an id stay."""
    return jaccard.keep_first(docs).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage, each judged by its own text; empty ones stay."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark and its characters counted anew; null texts stay null."""
    return secrets.redact(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digests of ids and decoded bytes."""
    import public_tokenizers as tokenizers

    return bpe.encode_texts(docs, tokenizers.path(RANKS), tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("byte-level BPE encoding and decoding", encoding_stage),
]

#: Not expressible in SQL: learned models and locality-sensitive search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = materialize(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
        discard(docs)  # of the tables written here; the input has no such mark
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
