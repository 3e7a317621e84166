"""Corpus pipeline: quality rules, SimHash near-dedup, secret scan, source mix, BPE.

Each stage takes ``(spark, docs, sf_dir)`` and its result is written as Parquet
and read again as the next one's ``docs``.  All but the last return the columns
of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayflow.llm import bpe, mixing, quality_rules, secret_scan, simhash
from dayflow.llm.queries import ranks_path
from dayflow.session import materialize, share_code
from dayflow.sources.tables import load


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (3-word shingles, at most 3 bits)."""
    return simhash.keep_one(docs, shingle_words=3, max_bits=3)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced by a mark; ``n_chars`` follows the new text."""
    clean = secret_scan.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources at weights 5, 2, 1 takes them."""
    return mixing.resample(docs, weights=(5, 2, 1), max_epochs=3)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed little-endian uint32) of each document that the mix took."""
    coded = docs.select("doc_id", "source", "text", bpe.encode(
        spark, F.col("text"), ranks_path(), decoded=True).alias("e"))
    whole = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    return coded.select("doc_id", "source", bpe.n_tokens(F.col("e.ids")).alias("n_tokens"),
                        "e.ids", "e.piece_chars", "e.piece_tokens",
                        (F.col("e.decoded") == whole).alias("round_trip"))


STAGES = [("quality_rules", rules_stage), ("simhash_near_dedup", dedup_stage),
          ("secret_scan", secrets_stage), ("source_mix", mix_stage),
          ("byte_bpe", tokens_stage)]
# Hash-ordered mixing, XXH64 fingerprints and BPE merges have no SQL form; the
# tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    share_code(spark)
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
