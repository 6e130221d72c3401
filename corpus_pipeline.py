"""The corpus pipeline: documents go through five stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of documents;
the last returns doc_id, n_tokens, ids_sha256, decoded_sha256 and token_ids. A stage works
on all that its predecessor kept. Empty tables go through as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import bpe, contamination, neardup, rules, secret_scan
from ledgerloom.llm.common import scratch, table

# Words of a shingle and least similarity, in percent, of near duplicates.
SHINGLE, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return rules.keep(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return neardup.keep_one(docs, SHINGLE, PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; all documents stay."""
    return secret_scan.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, with the digests of a round trip."""
    return bpe.round_trip(docs, keep_ids=True)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("secret_masking", secret_masking), ("encoding", encoding)]
# Shingle similarity, learned cutoffs and merges are beyond SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), name)
    return docs
