"""Toxicity by a factorization machine over hashed terms (operator 2).

A text's distinct words are hashed to 2^18 terms. The model is

    w0 + sum_i w_i + sum_{i<j} <v_i, v_j>   over the text's terms,

whose last part learns pairs, such as an insult with the mention of a group, that added
weights miss. Terms have weights that are associated with the label (likelihood ratio of their
document counts), and terms that are so only together: for each pair of the ``PAIRED`` most
frequent terms, how much the association of one with the label differs between the
documents with and without the other. Each is seen in several labelled documents, so that the
thousands of chance words of a long text do not add up.

Training: a bounded sample (``SAMPLE`` labelled documents) by adaptive gradient steps on
the driver. The sample's terms are counted in Spark; only those that may get a weight come to the driver. Scoring: one map over all documents, whole texts.

Defined cases: null or empty text has no terms and the score of the intercept; without
labels every score is 0; labels of one kind only give that kind's rate; repeated rows are
scored each; other columns are no input.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, mapped, scratch
from .samples import drawn, examples, graded, scored

BITS = 18
SAMPLE = 24_000
THRESHOLD = 0.3
# Terms with weights at most, and their least likelihood ratio and document count.
TERMS, LEAST_RATIO, LEAST_DOCUMENTS = 8192, 12.0, 3
# Terms whose pairs are looked at, least likelihood ratio of a pair, and terms that pairs add at most.
PAIRED, LEAST_PAIR, PARTNERS = 1024, 40.0, 512
FACTORS, EPOCHS, BATCH, RATE, PENALTY = 8, 12, 64, 0.1, 1e-4


def terms(text: bytes) -> list[int]:
    """Sorted distinct hashed words of a text."""
    mask = (1 << BITS) - 1
    return sorted({zlib.crc32(w) & mask for w in set(alnum_words(text))})


def _ratio(a: np.ndarray, b: np.ndarray, na: int, nb: int) -> np.ndarray:
    """Likelihood ratio of counts a of na against b of nb."""

    def part(k: np.ndarray, n: int, rate: np.ndarray) -> np.ndarray:
        rate = np.clip(rate, 1e-12, 1 - 1e-12)
        return k * np.log(rate) + (n - k) * np.log1p(-rate)

    return 2 * (part(a, na, a / na) + part(b, nb, b / nb) - part(a, na, (a + b) / (na + nb)) - part(b, nb, (a + b) / (na + nb)))


def _partners(rows: list[np.ndarray], grades: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Of the frequent terms those whose association with the label depends on another one, strongest first."""
    place = np.full(1 << BITS, -1, np.int32)
    place[frequent] = np.arange(len(frequent))
    pairs = {}
    for grade in (0, 1):
        mine = [place[r] for r, g in zip(rows, grades, strict=True) if g == grade]
        seen = np.zeros((len(mine), len(frequent)), np.float32)
        for k, at in enumerate(mine):
            seen[k, at[at >= 0]] = 1
        pairs[grade] = (seen.T @ seen).astype(np.float64), len(mine)  # counts below 2^24 are exact
    (bad, na), (good, nb) = pairs[1], pairs[0]
    a, b = np.diag(bad), np.diag(good)
    with np.errstate(divide="ignore", invalid="ignore"):
        within = _ratio(bad, good, a[:, None], b[:, None])  # the column's term, in documents with the row's term
        without = _ratio(a[None, :] - bad, b[None, :] - good, na - a[:, None], nb - b[:, None])
        gain = np.nan_to_num(within + without - _ratio(a, b, na, nb)[None, :])
    np.fill_diagonal(gain, 0)
    both = np.minimum(gain, gain.T)
    both[bad + good < LEAST_DOCUMENTS] = 0
    best = both.max(axis=1, initial=0)
    order = np.argsort(-best, kind="stable")[:PARTNERS]
    return frequent[order[best[order] >= LEAST_PAIR]]


class Machine:
    """Weights of the chosen terms; slot 0 of every array is for all others and stays 0."""

    def __init__(self, examples: list[tuple[int, list[int] | np.ndarray]], seed: int = 7):
        self.slot = np.zeros(1 << BITS, np.int32)
        grades = np.array([g for g, _ in examples], np.float64)
        na, nb = int(grades.sum()), int(len(grades) - grades.sum())
        self.bias = -math.inf if not na else math.log((na + 0.5) / (nb + 0.5))
        self.weight, self.factor = np.zeros(1), np.zeros((1, FACTORS))
        if not na or not nb:
            return
        a, b = np.zeros(1 << BITS), np.zeros(1 << BITS)
        for grade, found in examples:
            (a if grade else b)[found] += 1
        ratio = np.where(a + b >= LEAST_DOCUMENTS, _ratio(a, b, na, nb), 0)
        chosen = np.flatnonzero(ratio >= LEAST_RATIO)
        chosen = chosen[np.argsort(-ratio[chosen], kind="stable")][:TERMS]
        frequent = np.argsort(-(a + b), kind="stable")[:PAIRED]
        frequent = frequent[(a + b)[frequent] >= LEAST_DOCUMENTS]
        partners = _partners([np.asarray(found, np.int64) for _, found in examples], grades, frequent)
        chosen = np.concatenate([chosen, partners[~np.isin(partners, chosen)]])
        self.slot[chosen] = np.arange(1, len(chosen) + 1)
        rng = np.random.default_rng(seed)
        self.weight = np.zeros(len(chosen) + 1)
        self.factor = rng.normal(0, 0.01, (len(chosen) + 1, FACTORS))
        self.factor[0] = 0
        self._fit([self.active(found) for _, found in examples], grades, rng)

    def active(self, found: list[int]) -> np.ndarray:
        slots = self.slot[found] if len(found) else self.slot[:0]
        return slots[slots > 0]

    def _raw(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        flat = np.concatenate([*rows, np.zeros(0, np.int32)])
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        v = self.factor[flat]
        sums = np.zeros((len(rows), FACTORS))
        np.add.at(sums, owner, v)
        own = np.bincount(owner, (v * v).sum(axis=1), len(rows))
        raw = self.bias + np.bincount(owner, self.weight[flat], len(rows)) + 0.5 * ((sums * sums).sum(axis=1) - own)
        return raw, flat, owner, sums

    def _fit(self, rows: list[np.ndarray], grades: np.ndarray, rng: np.random.Generator) -> None:
        past_w, past_v, past_b = np.full(len(self.weight), 1e-6), np.full(self.factor.shape, 1e-6), 1e-6
        for _ in range(EPOCHS):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), BATCH):
                part = order[at:at + BATCH]
                raw, flat, owner, sums = self._raw([rows[i] for i in part])
                error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - grades[part]) / len(part)
                grad_b = error.sum()
                past_b += grad_b ** 2
                self.bias -= RATE * grad_b / math.sqrt(past_b)
                if not len(flat):
                    continue
                used, place = np.unique(flat, return_inverse=True)
                grad_w = np.bincount(place, error[owner]) + PENALTY * self.weight[used]
                grad_v = np.zeros((len(used), FACTORS))
                np.add.at(grad_v, place, error[owner, None] * (sums[owner] - self.factor[flat]))
                grad_v += PENALTY * self.factor[used]
                past_w[used] += grad_w ** 2
                past_v[used] += grad_v ** 2
                self.weight[used] -= RATE * grad_w / np.sqrt(past_w[used])
                self.factor[used] -= RATE * grad_v / np.sqrt(past_v[used])

    def score(self, texts: list[bytes]) -> list[float]:
        raw = self._raw([self.active(terms(t)) for t in texts])[0]
        return (1 / (1 + np.exp(-np.clip(raw, -700, 700)))).tolist() if math.isfinite(self.bias) else [0.0] * len(texts)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """A machine from at most ``sample`` labelled documents outside the held-out fold."""
    rows = scratch(examples(docs, drawn(graded(labels, "toxic"), sample), terms, "array<int>"), "examples")
    counts = rows.select("grade", F.explode("features").alias("term")).groupBy("term").agg(
        F.sum("grade").alias("a"), F.sum(1 - F.col("grade")).alias("b")).where(F.col("a") + F.col("b") >= LEAST_DOCUMENTS).toArrow()  # 2^18 terms at most
    na, nb = (int(x or 0) for x in rows.agg(F.sum("grade"), F.sum(1 - F.col("grade"))).first())
    term, a, b = (counts.column(c).to_numpy().astype(np.int64) for c in ("term", "a", "b"))
    with np.errstate(divide="ignore", invalid="ignore"):
        wanted = np.nan_to_num(_ratio(a, b, na, nb)) >= LEAST_RATIO
    by_count = np.lexsort((term, -(a + b)))[:PAIRED]
    wanted[by_count] = True
    mask = np.zeros(1 << BITS, bool)
    mask[term[wanted]] = True
    sent = docs.sparkSession.sparkContext.broadcast(mask)
    few = mapped(rows, lambda: lambda batch: [(g, [t for t in f if sent.value[t]]) for g, f in zip(batch["grade"], batch["features"], strict=True)],
                 "grade int, features array<int>").toArrow()
    lists = few.column("features").combine_chunks()
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    grades = few.column("grade").to_pylist()
    found = [(g, flat[offsets[k]:offsets[k + 1]]) for k, g in enumerate(grades)]
    return Machine(sorted(found, key=lambda x: (x[0], x[1].tobytes())))


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    return scored(docs, lambda: sent.value.score, threshold)
