"""Registered queries of the numbered operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (ball_search, bpe, byte_cnn, contamination, conversations, html_text, licenses, neardup, pitman_yor, quality, rules, secret_scan,
               toxicity)
from .common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op3_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"), size=4, percent=80)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.digest(contamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find(table(spark, sf_dir, "documents")))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(conversations.damage(table(spark, sf_dir, "conversations")))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_cnn.predict(docs, byte_cnn.train(docs))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_toxicity, op3_minmax_dedup, op4_byte_bpe, op5_quality_rules, op6_pitman_yor, op7_html_text, op8_quality,
    op9_decontamination, op10_secret_scan, op11_ranked_search, op12_conversation_repair, op13_language)}
ORACLE_SQL = {"op1_license_scan": licenses.oracle_sql(), "op11_ranked_search": ball_search.oracle_sql(),
              "op12_conversation_repair": conversations.oracle_sql()}
