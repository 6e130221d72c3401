"""Quality classifier by positive-unlabelled learning (operator 8).

Trusted positives are labelled documents of quality 1; unlabelled ones are documents
without a label outside the held-out fold. With class prior p, the model minimises the
non-negative unbiased risk

    p E_P[loss(g, 1)] + max(0, E_U[loss(g, 0)] - p E_P[loss(g, 0)])

with the logistic loss. No negative label is used. The prior is estimated from a first
classifier of positives against unlabelled: the share of the unlabelled above a cutoff,
divided by that of the positives, is least where only positives are left above it.

Features are rates of the whole text: classes of its characters three by three (letters
of either case, digits, white space, each common symbol), repeated words and lines, word
length. The training sample is bounded (``POSITIVES`` and ``UNLABELLED``); scoring is one
map over all documents.

Defined cases: null or empty text gets the score of all-zero rates; without positives or
unlabelled documents every score is the prior 0.5; repeated rows are scored each; other
columns are no input.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold
from .samples import FOLDS, HELD_OUT, drawn, features, graded, scored

POSITIVES, UNLABELLED = 6_000, 12_000
THRESHOLD = 0.7
EPOCHS, BATCH, RATE, PENALTY = 40, 512, 0.02, 1e-4
# Character classes: 0 other bytes, 1 a-z, 2 A-Z, 3 digits, 4 blanks, 5 line ends, then each symbol its own.
OWN = "!#$%&*|<>.,"
CLASSES = 6 + len(OWN)
_CLASS = bytearray(256)
for _bytes, _number in ((range(97, 123), 1), (range(65, 91), 2), (range(48, 58), 3), (b" \t\x0b\x0c", 4), (b"\r\n", 5)):
    for _byte in _bytes:
        _CLASS[_byte] = _number
for _k, _byte in enumerate(OWN.encode()):
    _CLASS[_byte] = 6 + _k
for _byte in range(128, 256):  # letters beyond ASCII count as small letters
    _CLASS[_byte] = 1
CLASS = bytes(_CLASS)
DENSE = 6
WIDTH = CLASSES ** 3 + DENSE
GROUP = 4096


def measures(text: bytes) -> list[float]:
    """Non-zero rates as position, value, position, value and so on."""
    kinds = np.frombuffer(text.translate(CLASS), np.uint8).astype(np.int64)
    out: list[float] = []
    if len(kinds) > 2:
        counts = np.bincount(kinds[:-2] * CLASSES * CLASSES + kinds[1:-1] * CLASSES + kinds[2:])
        at = np.flatnonzero(counts)
        out = np.column_stack((at, np.log1p(1000 * counts[at] / len(kinds)))).ravel().tolist()
    words = text.split()
    if words:
        lines = [x for x in text.split(b"\n") if x]
        n = len(words)
        dense = (math.log1p(1000 * sum(map(bytes.__eq__, words, words[1:])) / n), len(set(words)) / n ** 0.75, math.log1p(100 - 100 * len(set(lines)) / max(1, len(lines))),
                 min(20, sum(map(len, words)) / n) / 20, math.log1p(n) / 10, len(max(words, key=len)) > 60)
        out += [float(x) for k, v in enumerate(dense) for x in (CLASSES ** 3 + k, v)]
    return out


def _matrix(rows: list[list[float]]) -> np.ndarray:
    out = np.zeros((len(rows), WIDTH), np.float32)
    for k, row in enumerate(rows):
        pairs = np.asarray(row).reshape(-1, 2)
        out[k, pairs[:, 0].astype(np.int64)] = pairs[:, 1]
    return out


class Model:
    """A linear model of the rates that vary; weights by Adam steps."""

    def __init__(self, examples: list[tuple[int, list[float]]], seed: int = 7):
        positive, unlabelled = [x for g, x in examples if g == 1], [x for g, x in examples if g == 0]
        self.prior, self.bias, self.used = 0.5, 0.0, np.zeros(0, np.int64)
        self.weight = self.scale = np.zeros(0, np.float32)
        if not positive or not unlabelled:
            return
        seen = np.zeros(WIDTH, np.int64)
        for x in positive + unlabelled:
            seen[np.asarray(x[::2], np.int64)] += 1
        self.used = np.flatnonzero(seen >= 5)
        p, u = self._dense(positive), self._dense(unlabelled)
        self.scale = 1 / (np.concatenate((p, u)).std(axis=0) + 0.05)
        p, u = p * self.scale, u * self.scale
        self._fit(p, u, None, seed)
        self.prior = self._estimate(self._raw(p), self._raw(u))
        self._fit(p, u, self.prior, seed)

    def _dense(self, rows: list[list[float]]) -> np.ndarray:
        return np.concatenate([_matrix(rows[k:k + GROUP])[:, self.used] for k in range(0, len(rows), GROUP)])

    def _raw(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weight + self.bias

    @staticmethod
    def _estimate(p: np.ndarray, u: np.ndarray) -> float:
        """Least ratio of the shares above a cutoff, each with a margin of its sampling error."""
        cuts = np.quantile(p, np.linspace(0.0, 0.6, 61))
        above = lambda x: np.array([(x >= c).mean() for c in cuts])
        error = 1 / math.sqrt(len(p)) + 1 / math.sqrt(len(u))
        return float(np.clip(((above(u) + error) / above(p)).min(), 0.05, 0.98))

    def _fit(self, p: np.ndarray, u: np.ndarray, prior: float | None, seed: int) -> None:
        """With a prior the non-negative risk; without one plain positives against unlabelled."""
        rng = np.random.default_rng(seed)
        self.weight, self.bias = np.zeros(p.shape[1], np.float32), 0.0
        first, second = np.zeros(len(self.weight) + 1), np.zeros(len(self.weight) + 1)
        step = 0
        sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        rounds = max(1, (len(p) + len(u)) // BATCH)
        for _ in range(EPOCHS * rounds):
            a, b = p[rng.integers(0, len(p), BATCH // 2)], u[rng.integers(0, len(u), BATCH // 2)]
            za, zb = self._raw(a), self._raw(b)
            if prior is None:
                ga, gb = sigmoid(za) - 1, sigmoid(zb)
            else:
                negative = np.logaddexp(0, zb).mean() - prior * np.logaddexp(0, za).mean()
                ga = prior * (sigmoid(za) - 1)
                gb = sigmoid(zb)
                if negative >= 0:
                    ga = ga - prior * sigmoid(za)
                else:  # the estimate fell below zero: step back on that part alone
                    ga, gb = prior * sigmoid(za), -gb
            grad = np.append(a.T @ ga / len(a) + b.T @ gb / len(b) + PENALTY * self.weight, ga.mean() + gb.mean())
            step += 1
            first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad ** 2
            move = RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
            self.weight = (self.weight - move[:-1]).astype(np.float32)
            self.bias -= float(move[-1])

    def score(self, texts: list[bytes]) -> list[float]:
        if not len(self.used):
            return [self.prior] * len(texts)
        full = np.zeros(WIDTH)
        full[self.used] = self.weight * self.scale
        raw = []
        for text in texts:
            pairs = np.asarray(measures(text)).reshape(-1, 2)
            raw.append(self.bias + full[pairs[:, 0].astype(np.int64)] @ pairs[:, 1])
        return (1 / (1 + np.exp(-np.clip(raw, -700, 700)))).tolist()


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """A model from bounded samples of labelled positives and of unlabelled documents."""
    trusted = drawn(graded(labels, "quality").where("grade = 1"), positives)
    known = labels.where("doc_id is not null").select("doc_id").distinct()
    plain = docs.select("doc_id").where("doc_id is not null").where(fold(F.col("doc_id"), FOLDS) != HELD_OUT).join(known, "doc_id", "left_anti").distinct()
    ids = trusted.unionByName(drawn(plain.withColumn("grade", F.lit(0)), unlabelled))
    return Model(features(docs, ids, measures, "array<double>"))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return scored(docs, lambda: sent.value.score, threshold)
