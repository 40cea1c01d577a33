"""The training-data queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, htmltext, langid, lmscore, quality, secrets, simhash, suffixdedup, topk

RANKS = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = _table(spark, sf_dir, "benchmark").filter("item_id % 20 = 0")
    return topk.top_k(_table(spark, sf_dir, "documents"), queries)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "length", F.sha2("secret", 256).alias("secret_sha256"), "score", "is_secret")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_table(spark, sf_dir, "pages"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.deduplicate(_table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    return bpe.encode_texts(_table(spark, sf_dir, "documents"), tokenizers.path(RANKS), tokenizers.PATTERN, keep_ids=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_secret_scans, op2_html_extraction, op7_suffix_array_dedup, op8_benchmark_decontamination, op3_quality_classifier, op4_exact_top_k, op5_language_id, op6_simhash_near_dedup, op9_lm_scoring, op10_byte_bpe)}
ORACLES: dict[str, str] = {"op4_exact_top_k": topk.ORACLE}
