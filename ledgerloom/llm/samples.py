"""Bounded, repeatable samples of labelled documents for the classifiers, and their scoring map."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, fold, mapped

FOLDS, HELD_OUT = 4, 2


def graded(labels: DataFrame, column: str) -> DataFrame:
    """doc_id and grade of ids outside the held-out fold; of repeated labels the largest counts; nulls are no labels."""
    rows = labels.select("doc_id", F.col(column).cast("int").alias("grade")).where("doc_id is not null and grade is not null")
    return rows.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT).groupBy("doc_id").agg(F.max("grade").alias("grade"))


def drawn(rows: DataFrame, count: int) -> DataFrame:
    """At most ``count`` rows, those whose ids have the least hashes: the same at every run, spread over all ids."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(count)


def examples(docs: DataFrame, ids: DataFrame, of: Callable[[bytes], list], kind: str) -> DataFrame:
    """grade and features of the documents that a drawn sample names; the sample is small, so it is broadcast.

    Of several texts with one doc_id the least counts, so there are as many rows as ids at most.
    """
    named = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    chosen = named.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    return mapped(byte_texts(chosen, "doc_id", "grade"), lambda: lambda b: [(g, of(t)) for g, t in zip(b["grade"], b["text"], strict=True)],
                  f"grade int, features {kind}")


def features(docs: DataFrame, ids: DataFrame, of: Callable[[bytes], list], kind: str) -> list:
    """The (grade, features) of :func:`examples` on the driver, in an order of their own."""
    return sorted((r["grade"], list(r["features"])) for r in examples(docs, ids, of, kind).collect())


def scored(docs: DataFrame, score: Callable[[], Callable[[list[bytes]], list[float]]], threshold: float) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; a null doc_id is not held out."""

    def rows():
        apply = score()
        return lambda b: list(zip(b["doc_id"], apply(b["text"]), strict=True))

    out = mapped(byte_texts(docs, "doc_id"), rows, "doc_id long, score double")
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
