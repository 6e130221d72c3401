"""Quality rules with risk-controlled thresholds (operator 5).

Every document gets counts of its whole text. A rule rejects it if a statistic of these
lies above a cutoff of its stratum. Cutoffs are chosen on labelled documents: the number
of good ones (quality 1) that given cutoffs would reject together is binomial, and the
exact binomial tail tests whether the rate of false rejection reaches ``RISK``. Two ways
to cutoffs share the confidence of a stratum half and half:

* all statistics jointly, at the whole ``RISK``, along one sequence from no cutoff to strict
  ones until one is not certified. Its order comes from the bad documents alone (the next
  cutoff is that of the statistic which gains most of them a step), so the counts of good
  ones do not know it and the sequence needs no correction within itself;
* each statistic by itself, from the most lenient cutoff to the strictest, at an equal share
  of ``RISK`` and confidence. Large strata have labels enough for it, and a statistic
  that good documents have too does not stop the others.

Of the certified cutoffs those are taken which reject most labelled bad documents, a good
one counting ``PRICE`` times.

A stratum is a language with labelled good documents enough to certify something; all other
languages, also those without labels, are one stratum more. ``CONFIDENCE`` is divided by
their number (Bonferroni). So, with probability 1 - CONFIDENCE, at most RISK of the good
documents of any stratum are rejected; for the languages that share one this holds together,
not for each. If it has not enough labels either, nothing of it is certified or rejected.

Scale: one map over the texts, whose small result is written once. Labels are joined to
the counts, never to the texts, and summed to a histogram over the grid's cells; tests
run per stratum on its cells.

Defined cases: null or empty text has no words and fails the base rule; a null language
is a language of its own; labels of repeated ids count once, with the worst quality; rows with equal
or null doc_id are judged each (null ids have no label).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import every, mapped, pieces, scratch, shipped, WHITE

RISK = 0.02
CONFIDENCE = 0.05
PRICE = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
# Statistics, each a rate that is higher for worse texts.
STATISTICS = ("symbols_per_word", "bangs_per_word", "upper_share", "duplicate_lines_per_line", "repeated_words_per_word")
# Cutoffs that are tried, the same for each statistic.
GRID = [round(1.6 * 0.85 ** k, 6) for k in range(36)]
COUNTS = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_lines long, n_bangs long, n_upper long")


def repeated_words(numbers: np.ndarray, window: int = WINDOW) -> int:
    """How many words lie in windows that occur twice or more in the text."""
    count = len(numbers) - window + 1
    if count < 2:
        return 0
    code = np.zeros(count, np.int64)
    base = int(numbers.max()) + 1
    size = 1
    for k in range(window):
        if size * base >= 1 << 62:  # number the codes anew, so that they stay exact
            code = np.unique(code, return_inverse=True)[1]
            size = int(code.max()) + 1
        code, size = code * base + numbers[k:k + count], size * base
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(count, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edges = np.zeros(len(numbers) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def counts_of(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_bangs, n_upper of one text."""
    raw = text.encode()
    words = raw.split()
    number: dict[bytes, int] = {}
    numbers = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\x0b\x0c\r")] if b"\n" in raw else [raw] * bool(words)
    upper = len(raw) - len(raw.translate(None, UPPER))
    return (len(words), len(text) - sum(text.count(c) for c in WHITE), sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)),
            0 if len(number) == len(words) else repeated_words(numbers), len(lines), raw.count(b"!"), upper)


UPPER = bytes(range(65, 91))


def counts(docs: DataFrame) -> DataFrame:
    """The counts of every row."""
    return mapped(docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text")),
                  lambda: lambda b: [(i, s, *counts_of(t)) for i, s, t in zip(b["doc_id"], b["lang"], b["text"], strict=True)], COUNTS)


def _statistics() -> dict[str, Column]:
    rate = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)).cast("double")
    return dict(zip(STATISTICS, (rate("n_symbols", "n_words"), rate("n_bangs", "n_words"), rate("n_upper", "word_chars"),
                                 rate("n_dup_lines", "n_lines"), rate("n_repeat_words", "n_words")), strict=True))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def tail(failures: int, trials: int, rate: float) -> float:
    """P(X <= failures) for X binomial; summed downwards, where the terms vanish."""
    if failures >= trials * rate:
        return 1.0
    term = (math.lgamma(trials + 1) - math.lgamma(failures + 1) - math.lgamma(trials - failures + 1)
            + failures * math.log(rate) + (trials - failures) * math.log1p(-rate))
    total, ratio, k = 0.0, 1.0, failures
    while k >= 0 and ratio > 1e-16 * total:
        total += ratio
        ratio *= k * (1 - rate) / ((trials - k + 1) * rate)
        k -= 1
    return min(1.0, math.exp(term) * total)


def sequence(bins: np.ndarray, bad: np.ndarray) -> list[tuple[int, ...]]:
    """Joint cutoffs, as positions in GRID (-1: none), from lenient to strict; each rejects more bad documents than the one before."""
    at, out = [-1] * bins.shape[1], []
    while True:
        rest = (bins > at).all(axis=1) & (bad > 0)
        best, step = 0.0, None
        for s in range(len(at)):
            gain = np.cumsum(np.bincount(bins[rest, s], bad[rest], len(GRID) + 1)[at[s] + 1:len(GRID)])
            if len(gain) and gain[-1]:
                rate = gain / np.arange(1, len(gain) + 1)
                if rate.max() > best:
                    best, step = rate.max(), (s, at[s] + 1 + int(np.argmax(gain > 0)))
        if step is None:
            return out
        at[step[0]] = step[1]
        out.append(tuple(at))


def certified(steps: list[tuple[int, ...]], bins: np.ndarray, good: np.ndarray, bad: np.ndarray, risk: float, level: float) -> tuple[int, tuple[int, ...]]:
    """The best of the joint cutoffs before the first that is not certified, and what it is worth; no cutoff is worth 0."""
    most, best = 0, (-1,) * bins.shape[1]
    for at in steps:
        above = (bins <= at).any(axis=1)
        wrong, right = int(good[above].sum()), int(bad[above].sum())
        if tail(wrong, int(good.sum()), risk) > level:
            break
        if right - PRICE * wrong > most:
            most, best = right - PRICE * wrong, at
    return most, best


def choose(bins: np.ndarray, good: np.ndarray, bad: np.ndarray, risk: float, level: float) -> tuple[int, ...]:
    """Positions in GRID of the cutoffs of a stratum; bins are, for each cell and statistic, how many cutoffs the value does not exceed."""
    count = bins.shape[1]
    joint = certified(sequence(bins, bad), bins, good, bad, risk, level / 2)[1]
    alone = tuple(certified([(k,) for k in range(len(GRID))], bins[:, s:s + 1], good, bad, risk / count, level / 2 / count)[1][0] for s in range(count))

    def worth(at: tuple[int, ...]) -> int:
        above = (bins <= at).any(axis=1)
        return int(bad[above].sum()) - PRICE * int(good[above].sum())

    return max(joint, alone, key=worth)


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """stratum, statistic and the chosen certified cutoff (null: none) from labelled documents.

    The null stratum is that of all languages not named. Documents that the base rule rejects
    anyway are left out: the method's verdict does not touch them.
    """
    shipped(measured.sparkSession)
    graded = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("good"))
    passed = lambda value: F.size(F.filter(F.array(*map(F.lit, GRID)), lambda c: value <= c))
    held = scratch(measured.where(~base_failed()).join(graded, F.col("doc_id") == F.col("_id")).select(
        F.coalesce("lang", F.lit("")).alias("language"), (F.col("good") == 1).cast("long").alias("good"),
        F.array(*map(passed, _statistics().values())).alias("bins"))
        .groupBy("language", "bins").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")), "held")
    # The joint test certifies no cutoff with fewer good documents than this; with the k-th most the language is one of k + 1 strata.
    needed = lambda strata: F.log(F.lit(confidence / 2) / strata) / F.lit(math.log1p(-risk))
    sizes = held.groupBy("language").agg(F.sum("good").alias("trials")).where(F.col("trials") >= needed(F.lit(2)))
    ranked = sizes.withColumn("strata", F.row_number().over(Window.orderBy(F.desc("trials"), "language")) + 1)
    own = ranked.where(F.col("trials") >= needed(F.col("strata"))).select(F.col("language").alias("stratum"))
    strata = own.agg((F.count("*") + 1).alias("strata"))

    def chosen(rows: pd.DataFrame) -> pd.DataFrame:
        bins = np.array(rows["bins"].tolist(), np.int64)
        at = choose(bins, rows["good"].to_numpy(), rows["bad"].to_numpy(), risk, confidence / int(rows["strata"].iloc[0]))
        return pd.DataFrame({"stratum": rows["stratum"].iloc[0], "statistic": STATISTICS,
                             "cutoff": pd.Series([GRID[k] if k >= 0 else None for k in at], dtype="float64")})

    cells = held.join(own, F.col("language") == F.col("stratum"), "left").groupBy("stratum", "bins").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    return cells.join(strata).groupBy("stratum").applyInPandas(chosen, "stratum string, statistic string, cutoff double")


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """Counts, base_failed, kept and the statistics that rejected (reasons) of every row."""
    measured = scratch(counts(docs), "counts")
    return _judged(measured, _wide(measured, labels, risk, confidence)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reasons")


def _wide(measured: DataFrame, labels: DataFrame, risk: float, confidence: float) -> DataFrame:
    """_stratum and a column of cutoffs for each statistic."""
    chosen = cutoffs(measured, labels, risk, confidence).groupBy(F.col("stratum").alias("_stratum"))
    return scratch(chosen.pivot("statistic", list(STATISTICS)).agg(F.first("cutoff")), "cutoffs")


def _judged(measured: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows with base_failed, reasons and kept."""
    own = chosen.where("_stratum is not null").select("_stratum", *(F.col(s).alias(f"_{s}") for s in STATISTICS))
    pooled = chosen.where("_stratum is null").groupBy().agg(*(F.first(s).alias(f"_pooled_{s}") for s in STATISTICS))
    cutoff = lambda name: F.when(F.col("_stratum").isNotNull(), F.col(f"_{name}")).otherwise(F.col(f"_pooled_{name}"))
    reasons = F.filter(F.array(*(F.when(value > cutoff(name), name) for name, value in _statistics().items())), lambda x: x.isNotNull())
    return (measured.join(own, F.coalesce("lang", F.lit("")) == F.col("_stratum"), "left").join(pooled).withColumn("base_failed", base_failed())
            .withColumn("reasons", reasons).withColumn("kept", ~F.col("base_failed") & (F.size("reasons") == 0)))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows without the rejected ones; each is judged by its own text, which is counted once and written with its counts."""
    row = docs.select(F.struct(*every(docs)).alias("_row"))
    names = [f.split()[0] for f in COUNTS.split(", ")][2:]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = batch.column("_row")
            columns = list(zip(*(counts_of(t or "") for t in rows.field("text").to_pylist()), strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([rows, rows.field("lang").cast(pa.string()), *(pa.array(c, pa.int64()) for c in columns)], ["_row", "lang", *names])

    shipped(docs.sparkSession)
    schema = StructType([row.schema["_row"], StructField("lang", StringType()), *(StructField(n, LongType()) for n in names)])
    counted = scratch(row.mapInArrow(count, schema), "counted")
    measured = counted.select(F.col("_row.doc_id").alias("doc_id"), "lang", *names)
    return _judged(counted, _wide(measured, labels, RISK, CONFIDENCE)).where("kept").select("_row.*")
