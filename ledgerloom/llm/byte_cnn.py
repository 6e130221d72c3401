"""Language identification by a byte convolutional network, trained in numpy on labelled texts.

Texts are lower-cased A-Z, and every run of other ASCII bytes than letters becomes one space. The
whole text is cut into windows of WINDOW bytes that overlap by one less than the widest filter, so
that every place of every filter lies in just one of them; the last one is filled up with spaces.
Filters of WIDTHS bytes, FILTERS of each width, run over the bytes; their largest output in a window
(0 at least) goes to a softmax over the languages. A text's log probabilities are the mean of those of
its windows, weighted by their letters' bytes, made to sum to one again.

A filter over bytes is a table of outputs by place and byte. For scoring, the tables of two
neighbouring places are added to one by pairs of bytes, which needs two look-ups a place for all
filters and gives the same sums.

Learnt from: at most LANGUAGES most frequent languages; of each as many documents as TEXTS allows
for all together, drawn by the hash of id and text, exact copies once; of each at most PLACES
windows, evenly spread over the whole text. Rows of the held-out fold, without id, text or lang teach nothing.

A text that is null or has no letter is ``und`` with score 0, and so is every text where no language
was learnt. Repeated rows are scored each; a null doc_id is not held out. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, mapped, pieces, shipped
from .samples import FOLDS, HELD_OUT

WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 16
REACH = WINDOW - max(WIDTHS) + 1  # places of a filter in a window, and the step from window to window
LANGUAGES, TEXTS, PLACES = 256, 4096, 4
ROUNDS, BATCH, RATE, LEAST_BYTES = 4, 64, 0.01, 12
TOGETHER = 128  # windows that are looked up at once
SPACE = 32
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 97 <= b <= 122 else SPACE for b in range(256))


def windows(text: str) -> np.ndarray:
    """The windows of a whole text, one a row."""
    plain = b" " + b" ".join(text.encode().translate(LETTERS).split()) + b" "
    count = max(1, -(-(len(plain) - WINDOW + REACH) // REACH))
    filled = np.full(count * REACH + WINDOW - REACH, SPACE, np.uint8)
    filled[:len(plain)] = np.frombuffer(plain, np.uint8)
    return np.lib.stride_tricks.as_strided(filled, (count, WINDOW), (REACH, 1))


class Network:
    """Filters (a table by place, byte and filter for each width), their bias, and the softmax layer."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.filters = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.dense = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.offset = np.zeros(len(languages), np.float32)

    def train(self, inputs: np.ndarray, targets: np.ndarray, rounds: int = ROUNDS, seed: int = 11) -> Network:
        """Adam on the cross entropy. Half of the windows are cut short at random, so that short texts are learnt too."""
        rng = np.random.default_rng(seed)
        values = [*self.filters, self.bias, self.dense, self.offset]
        first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(inputs))
            for at in range(0, len(order), BATCH):
                chosen = order[at:at + BATCH]
                x = inputs[chosen].copy()
                ends = np.where(rng.random(len(x)) < 0.5, rng.integers(LEAST_BYTES, WINDOW, len(x)), WINDOW)
                x[np.arange(WINDOW)[None, :] >= ends[:, None]] = SPACE
                step += 1
                for v, g, m, s in zip(values, self._gradients(x, targets[chosen]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    v -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradients(self, x: np.ndarray, targets: np.ndarray) -> list[np.ndarray]:
        rows, pooled, places = np.arange(len(x)), [], []
        for tables in self.filters:
            out = sum(tables[j][x[:, j:j + REACH]] for j in range(len(tables)))
            place = out.argmax(axis=1)
            places.append(place)
            pooled.append(np.take_along_axis(out, place[:, None, :], 1)[:, 0])
        top = np.concatenate(pooled, axis=1) + self.bias
        features = np.maximum(top, 0)
        scores = features @ self.dense + self.offset
        chance = np.exp(scores - scores.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        chance[rows, targets] -= 1
        chance /= len(x)
        back = (chance @ self.dense.T) * (top > 0)
        grads = []
        for k, (tables, place) in enumerate(zip(self.filters, places, strict=True)):
            grad, part = np.zeros_like(tables), back[:, k * FILTERS:(k + 1) * FILTERS]
            for j in range(len(tables)):
                np.add.at(grad[j], (x[rows[:, None], place + j], np.arange(FILTERS)[None, :]), part)
            grads.append(grad)
        return [*grads, back.sum(axis=0), features.T @ chance, chance.sum(axis=0)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Outputs by the pair of bytes at places 0 and 1 of all filters, and at places 2 and 3 of those that reach so far."""
        tables = []
        for place, widths in ((0, WIDTHS), (2, WIDTHS[1:])):
            table = np.zeros((256, 256, len(widths), FILTERS), np.float32)
            for k, width in enumerate(widths):
                filters = self.filters[WIDTHS.index(width)]
                table[:, :, k] += filters[place][:, None]
                if place + 1 < width:
                    table[:, :, k] += filters[place + 1][None, :]
            tables.append(table.reshape(65536, -1))
        return tables[0], tables[1]

    def scorer(self):
        """A function that gives the windows' log probabilities."""
        near, far = self.pairs()
        one, two = (np.empty((TOGETHER * REACH, t.shape[1]), np.float32) for t in (near, far))
        dense, offset = self.dense.astype(np.float64), self.offset.astype(np.float64)

        def logs(x: np.ndarray) -> np.ndarray:
            out = np.empty((len(x), len(self.languages)))
            for at in range(0, len(x), TOGETHER):
                part = x[at:at + TOGETHER].astype(np.int32)
                pair = part[:, :-1] * 256 + part[:, 1:]
                size = len(part) * REACH
                a = near.take(pair[:, :REACH].ravel(), axis=0, out=one[:size], mode="clip")
                b = far.take(pair[:, 2:].ravel(), axis=0, out=two[:size], mode="clip")
                a[:, FILTERS:] += b
                top = np.maximum(a.reshape(len(part), REACH, -1).max(axis=1) + self.bias, 0)
                scores = np.einsum("nf,fl->nl", top.astype(np.float64), dense) + offset
                scores -= scores.max(axis=1, keepdims=True)
                out[at:at + TOGETHER] = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
            return out

        return logs


def sample(docs: DataFrame, languages: int = LANGUAGES, texts: int = TEXTS, places: int = PLACES) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages learnt, windows and the places of their languages."""
    rows = docs.select("doc_id", "lang", "text").where((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()}
    if not counts:
        return [], np.empty((0, WINDOW), np.uint8), np.empty(0, np.int64)
    each = max(1, texts // len(counts))
    # Twice the wanted share of every language by hash, then the least hashes of those.
    share = F.lit(0.0)
    for name, count in counts.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, 2 * each / count + 1e-3))).otherwise(share)
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = rows.withColumns({"draw": drawn, "share": share}).where("draw < share").groupBy("lang", "doc_id", "draw").agg(F.min("text").alias("text"))
    first = Window.partitionBy("lang").orderBy("draw", "doc_id")
    chosen = few.withColumn("place", F.row_number().over(first)).where(F.col("place") <= each).select("lang", "doc_id", "text")
    shipped(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for lang, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "doc_id", "text")), strict=True):
                if any(map(str.isalpha, text)):
                    all_of = windows(text)
                    out += [(lang, doc_id, int(k), all_of[k].tobytes()) for k in np.unique(np.linspace(0, len(all_of) - 1, places).astype(int))]
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                                             ["lang", "doc_id", "place", "window"])

    found = sorted((r["lang"], bytes(r["window"])) for r in chosen.mapInArrow(cut, "lang string, doc_id long, place long, window binary").collect())
    names = sorted({lang for lang, _ in found})
    number = {lang: k for k, lang in enumerate(names)}
    inputs = np.frombuffer(b"".join(w for _, w in found), np.uint8).reshape(-1, WINDOW)
    return names, inputs, np.array([number[lang] for lang, _ in found], np.int64)


def train(docs: DataFrame) -> Network:
    names, inputs, targets = sample(docs)
    return Network(names).train(inputs, targets)


def predict(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def rows():
        languages = sent.value.languages
        logs = sent.value.scorer() if languages else None

        def apply(batch: dict) -> list[tuple]:
            out, waiting, many = [], [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                cut = windows(text) if languages and text is not None and any(map(str.isalpha, text)) else None
                waiting.append((doc_id, cut))
                many += 0 if cut is None else len(cut)
                if many >= TOGETHER:
                    out += verdicts(waiting)
                    waiting, many = [], 0
            return out + verdicts(waiting)

        def verdicts(waiting: list[tuple]) -> list[tuple]:
            cuts = [c for _, c in waiting if c is not None]
            every = logs(np.concatenate(cuts) if len(cuts) > 1 else cuts[0]) if cuts else None
            out, at = [], 0
            for doc_id, cut in waiting:
                if cut is None:
                    out.append((doc_id, "und", 0.0))
                    continue
                letters = (cut[:, :REACH] != SPACE).sum(axis=1) + 1e-3
                mean = letters @ every[at:at + len(cut)] / letters.sum()
                at += len(cut)
                chance = np.exp(mean - mean.max())
                best = int(mean.argmax())
                out.append((doc_id, languages[best], float(chance[best] / chance.sum())))
            return out

        return apply

    out = mapped(docs.select("doc_id", "text"), rows, "doc_id long, lang_pred string, score double")
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
