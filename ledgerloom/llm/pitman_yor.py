"""Language-model scores by a hierarchical Pitman-Yor model (operator 6).

The corpus sits in a tree of restaurants. Every word token is a customer of the restaurant
of the word before it (at the start of a text the end token); a new table there sends a
customer to the word restaurant, which all contexts share; a new table there sends the word's
spelling, byte by byte and with an end, to the spelling restaurants. Those have a context of
the four bytes before (in 32 classes); a new table of a context sends a customer to the
restaurant of the shorter context, down to single bytes over the uniform distribution. So a
word is expected after some words more than after others, a frequent one has its own
probability, and a new one that of its spelling.

Seating is sampled by Gibbs sweeps; the first starts from one table for every pair of words.
Given all other tables, the customers of a dish are seated one after another: a new table with
weight (theta + d T) P_parent, an old one with weight n - d t. (Beyond the first customers of a
dish, steps of a sixteenth of those seated are drawn at once.) The discount of each restaurant
level is estimated from its counts. Every draw depends on the dish and the sweep alone, so a
repeated task, other partitions or batches seat alike, and a sample is scored with the tables
that its sweep drew. After ``BURN`` sweeps the predictive probabilities of ``SAMPLES`` sweeps
are averaged; the perplexity of a text is 10 ** (-score / n_tokens).

Scale: words and pairs are counted over all training documents, with partial sums in each task,
and both stay tables. Documents are coded once into word numbers: the rank of the ``FREQUENT``
most frequent words, which every task knows with their tables and probability, a hash of 62
bits for the others. Pairs of two frequent words meet in cells, dealt by the pair, so that no
word is a group; all other pairs meet what the sweeps left for their rare words in parts, dealt
by the rare word. Both move as packed numbers, a run for each part and some documents.
``FREQUENT`` decides where a pair is seated and scored, not how. A pair that occurs once has
one table; sweeps read the other pairs alone, and seat a word that has one customer whatever
they draw just once. Each step's shuffles go when its rows are written. Spelling sums are
bounded by the 32^4 contexts and 257 symbols, whatever the input, and that bounded model is
what the driver holds and broadcasts, besides the arrays of the frequent words.

Defined cases: null or empty text is its end token alone; rows are scored each, also with
equal or null doc_id (null is not held out); without training tokens every word has its
spelling's probability under the uniform distribution; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_texts, fold, pieces, scratch, shipped

FOLDS = 10
BURN, SAMPLES = 2, 2
STRENGTH = 5.0
# Words that every task knows; pairs with others are joined.
FREQUENT = 300_000
# Distinct words a task counts before it passes them on.
COUNTED = 400_000
WORDS_TOGETHER = 50_000
# Documents whose pairs are dealt at once, and the tokens a cell is made for.
DOCS_TOGETHER, PAIRS_TOGETHER = 2_000, 4_000_000
# Tokens not frequent that a part is made for, and the least number of parts.
RARE_TOGETHER, PARTS = 300_000, 24
# Bytes of text split into words at once, and distinct spelling keys a task sums before it merges them.
TEXT_TOGETHER, KEYS_TOGETHER = 8 << 20, 2_000_000
# While a step's rows are written: its shuffle files go once they are there, and what is written is small.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
SYMBOLS, END, LEVELS = 257, 256, 4
CLASS_BITS = 5
# Byte classes: 0 the word's start, 1-26 a-z, 27 digits, the rest shared by the remaining bytes.
BYTE_CLASS = np.array([b - 96 if 97 <= b <= 122 else 27 if 48 <= b <= 57 else 28 + b % 4 for b in range(256)], np.int64)


def discount(counts: np.ndarray) -> float:
    """Estimate from how many dishes have one and two customers."""
    return from_counts(int((counts == 1).sum()), int((counts == 2).sum()))


def uniforms(keys: np.ndarray, draw: int) -> np.ndarray:
    """A uniform number for each 64-bit key: the same in every task and batch, another for every draw."""
    x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (draw + 1) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53


# Successes expected from which a binomial number is drawn as a normal one.
MANY = 50


def successes(keys: np.ndarray, draw: int, trials: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Binomial numbers: by inversion where few are expected, from above where the chance is more than a half, else by a sum of uniforms."""
    flip = chance > 0.5
    p = np.where(flip, 1 - chance, chance)
    out = np.zeros(len(trials), np.int64)
    many = trials * p > MANY
    if many.any():
        normal = sum(uniforms(keys[many], 16 * draw + k) for k in range(12)) - 6
        mean = trials[many] * p[many]
        out[many] = np.clip(np.rint(mean + normal * np.sqrt(mean * (1 - p[many]))), 0, trials[many]).astype(np.int64)
    rows = np.flatnonzero(~many)
    term, left = np.exp(trials * np.log1p(-p)), np.zeros(len(trials))
    left[rows] = uniforms(keys[rows], 16 * draw + 15) - term[rows]
    rows = rows[left[rows] > 0]
    ratio = p / (1 - p)
    while len(rows):
        out[rows] += 1
        k = out[rows]
        term[rows] *= (trials[rows] - k + 1) / k * ratio[rows]
        left[rows] -= term[rows]
        rows = rows[(left[rows] > 0) & (k < trials[rows])]
    return np.where(flip, trials - out, out)


def seats(count: np.ndarray, parent: np.ndarray, strength: float, less: float, tables: np.ndarray | float, keys: np.ndarray, seed: int) -> np.ndarray:
    """Tables of dishes with so many customers, given the parent's probabilities and the tables of their restaurants.

    The draws of a dish depend on its key and the seed alone.
    """
    out = (count > 0).astype(np.int64)
    seated = out.copy()
    fresh = (strength + less * tables) * parent
    rows, draw = np.flatnonzero(count > seated), seed << 20
    while len(rows):
        step = np.minimum(count[rows] - seated[rows], np.maximum(1, seated[rows] // 16))
        weight, draw = fresh[rows], draw + 1
        out[rows] += successes(keys[rows], draw, step, np.clip(weight / (seated[rows] - less * out[rows] + weight), 0, 1 - 1e-12))
        seated[rows] += step
        rows = rows[count[rows] > seated[rows]]
    return out


def positions(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Context and symbol of every byte and end of some words as one key each, and the word each belongs to."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    flat = np.frombuffer(b"\0".join(words) + b"\0", np.uint8).astype(np.int64)
    ends = np.cumsum(sizes) - 1
    place = np.arange(len(flat)) - np.repeat(ends + 1 - sizes, sizes)
    kind = BYTE_CLASS[flat]
    context = np.zeros(len(flat), np.int64)
    for back in range(1, LEVELS + 1):
        context[back:] += np.where(place[back:] >= back, kind[:-back], 0) << CLASS_BITS * (back - 1)
    flat[ends] = END
    return context * SYMBOLS + flat, np.repeat(np.arange(len(words)), sizes)


class Spelling:
    """What the spelling restaurants predict: for each context length the seen dishes, and each context's share for new tables."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [  # keys, probabilities, shares
            (np.zeros(0, np.int64), np.zeros(0), np.ones(1 << CLASS_BITS * level)) for level in range(LEVELS + 1)]

    def __getstate__(self) -> list[tuple]:
        """Without the shares of contexts never seen, which are one."""
        return [(keys, probability, len(share), np.flatnonzero(share != 1), share[share != 1]) for keys, probability, share in self.levels]

    def __setstate__(self, state: list[tuple]) -> None:
        self.levels = [(keys, probability, np.ones(size)) for keys, probability, size, _, _ in state]
        for (_, _, share), (_, _, _, at, values) in zip(self.levels, state, strict=True):
            share[at] = values

    @staticmethod
    def sampled(keys: np.ndarray, counts: np.ndarray, before: Spelling, seed: int) -> Spelling:
        """Seat the customers of all contexts, from the longest to none, then compute what they predict."""
        seated_levels = []
        for level in range(LEVELS, -1, -1):
            context, less = keys // SYMBOLS, discount(counts)
            dishes = np.bincount(context, minlength=1 << CLASS_BITS * level)  # a table a dish at least
            seated = seats(counts, before.probability(_shorter(keys, level), level - 1), STRENGTH, less, dishes[context], keys, seed)
            seated_levels.append((level, keys, counts, seated, less))
            keys, place = np.unique(_shorter(keys, level), return_inverse=True)
            counts = np.bincount(place, seated, minlength=len(keys)).astype(np.int64)
        out = Spelling()
        for level, keys, counts, seated, less in reversed(seated_levels):
            context, size = keys // SYMBOLS, 1 << CLASS_BITS * level
            customers = STRENGTH + np.bincount(context, counts, size)
            share = (STRENGTH + less * np.bincount(context, seated, size)) / customers
            under = out.probability(_shorter(keys, level), level - 1)
            out.levels[level] = (keys, (counts - less * seated) / customers[context] + share[context] * under, share)
        return out

    def probability(self, keys: np.ndarray, level: int) -> np.ndarray:
        """Of context and symbol keys of a level; what a context has not seen comes from the shorter one, in proportion to its share."""
        out, rows = np.ones(len(keys)), np.arange(len(keys))
        for at_level in range(level, -1, -1):
            known, probability, share = self.levels[at_level]
            at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
            found = known[at] == keys if len(known) else np.zeros(len(keys), bool)
            out[rows[found]] *= probability[at[found]]
            rows, keys = rows[~found], keys[~found]
            out[rows] *= share[keys // SYMBOLS]
            keys = _shorter(keys, at_level)
        out[rows] /= SYMBOLS
        return out

    def logs(self, words: list[bytes]) -> np.ndarray:
        """Natural logarithm of each word's probability."""
        return spelled([self], words)[0]


def spelled(spellings: list[Spelling], words: list[bytes]) -> list[np.ndarray]:
    """Natural logarithms of the words' probabilities by each of some models; what words share is looked up once."""
    if not words:
        return [np.zeros(0)] * len(spellings)
    keys, owner = positions(words)
    keys, place = np.unique(keys, return_inverse=True)
    return [np.bincount(owner, np.log(s.probability(keys, LEVELS))[place], len(words)) for s in spellings]


def _shorter(keys: np.ndarray, level: int) -> np.ndarray:
    """The keys without the farthest byte of their context; those without context stay."""
    if level == 0:
        return keys % SYMBOLS
    return (keys // SYMBOLS) % (1 << CLASS_BITS * (level - 1)) * SYMBOLS + keys % SYMBOLS


class Sample:
    """The state after a sweep: spelling restaurants, tables of the word restaurant, its customers and discount."""

    def __init__(self, spelling: Spelling, tables: float, tokens: int, less: float, seed: int, before: Sample | None = None):
        self.spelling, self.tables, self.tokens, self.less, self.seed = spelling, tables, tokens, less, seed
        self.before = before and Sample(before.spelling, before.tables, tokens, less, before.seed)  # what the tables were drawn from

    def seat(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Tables of some words; one customer has one table, however it is spelled."""
        tables = (counts > 0).astype(np.int64)
        rows = np.flatnonzero(counts > 1)
        words = [words[k] for k in rows]
        tables[rows] = self._seated(hashes_of(words), counts[rows], np.exp(self.spelling.logs(words)))
        return tables

    def _seated(self, keys: np.ndarray, counts: np.ndarray, spelt: np.ndarray) -> np.ndarray:
        return seats(counts, spelt, STRENGTH, self.less, self.tables, keys, self.seed)

    def predict(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        return predictive([self], words, [counts])[0]


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter((int.from_bytes(hashlib.blake2b(w, digest_size=8).digest()) for w in words), np.uint64, len(words))


def predictive(samples: list[Sample], words: list[bytes], counts: list[np.ndarray]) -> list[np.ndarray]:
    """The words' probabilities after each of some sweeps, given their customers after each."""
    models = {id(m): m for s in samples for m in (s.before.spelling, s.spelling)}
    spelt = dict(zip(models, map(np.exp, spelled(list(models.values()), words)), strict=True))
    rows = np.flatnonzero(np.max(counts, axis=0) > 1) if words else np.zeros(0, np.int64)
    keys, out = hashes_of([words[k] for k in rows]), []
    for s, count in zip(samples, counts, strict=True):
        tables = (count > 0).astype(np.int64)
        tables[rows] = s.before._seated(keys, count[rows], spelt[id(s.before.spelling)][rows])  # the draws of the sweep again
        out.append((count - s.less * tables + (STRENGTH + s.less * s.tables) * spelt[id(s.spelling)]) / (STRENGTH + s.tokens))
    return out


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """The settings of WRITING, for what is written within."""
    before = {k: spark.conf.get(k) for k in WRITING}
    try:
        for k, v in WRITING.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def stored(df: DataFrame, name: str) -> DataFrame:
    """scratch(), after which the shuffles that made the rows take no disk."""
    with writing(df.sparkSession):
        return scratch(df, name)


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut to about TEXT_TOGETHER bytes of text."""
    for batch in batches:
        ends, at = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT_TOGETHER, "right")))
            yield batch.slice(at, to - at)
            at = to


def gathered(batches: Iterator[pa.RecordBatch], rows: int = WORDS_TOGETHER) -> Iterator[pa.RecordBatch]:
    """The batches put together, then cut to at most so many rows; none is empty."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pieces(pa.Table.from_batches(held).combine_chunks().to_batches(), rows)
            held, n = [], 0
    if n:
        yield from pieces(pa.Table.from_batches(held).combine_chunks().to_batches(), rows)


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words of some texts (bytes), lower-cased, and the place of the text that each is from."""
    wide = pa.types.is_large_binary(texts.type)
    texts = pa.Array.from_buffers(pa.large_string() if wide else pa.string(), len(texts), texts.buffers(), offset=texts.offset)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, owner = lists.flatten(), pc.list_parent_indices(lists)
    some = pc.greater(pc.binary_length(words), 0)  # white space at an end of a text leaves an empty one
    return owner.filter(some).to_numpy(zero_copy_only=False).astype(np.int64), words.filter(some).cast(pa.binary())


def word_counts(docs: DataFrame) -> DataFrame:
    """word (bytes; the end token is empty) and its count over the rows not held out; all rows' words are there."""
    shipped(docs.sparkSession)

    def table(words: pa.Array, counts: pa.Array) -> pa.Table:
        return pa.table([words, counts], ["word", "count"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[pa.Table] = []

        def merged() -> pa.Table:
            rows = pa.concat_tables(found).group_by("word", use_threads=False).aggregate([("count", "sum")])
            return table(rows.column("word"), rows.column("count_sum"))

        for batch in portions(batches):
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            owner, words = words_of(batch.column("text"))
            learnt = words.filter(pa.array(~held[owner])).value_counts()
            others = words.filter(pa.array(held[owner])).unique()
            found += [table(learnt.field(0), learnt.field(1)), table(others, pa.array(np.zeros(len(others), np.int64))),
                      table(pa.array([b""], pa.binary()), pa.array([int((~held).sum())], pa.int64()))]
            if sum(t.num_rows for t in found) > 2 * COUNTED:
                found[:] = [merged()]
                if found[0].num_rows > COUNTED:
                    yield from found.pop().to_batches()
        if found:
            yield from merged().to_batches()

    return byte_texts(docs, "held_out").mapInArrow(count, "word binary, count long").groupBy("word").agg(F.sum("count").alias("count"))


def word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest()) >> 2


class Numbers:
    """The number of every word: of the frequent ones their rank, of others a hash above all ranks."""

    def __init__(self, known: pa.Array | dict[bytes, int]):
        self.known = known if isinstance(known, pa.Array) else pa.array(list(known), pa.binary())

    def of(self, words: pa.Array) -> np.ndarray:
        ids = pc.index_in(words, self.known)
        far = ids.is_null()
        others = words.filter(far).dictionary_encode()
        ids = ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        hashed = np.fromiter(map(word_hash, others.dictionary.to_pylist()), np.int64, len(others.dictionary)) + len(self.known)
        ids[ids < 0] = hashed[others.indices.to_numpy(zero_copy_only=False)]
        return ids


def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of numbers, or of rows of them, as bytes, one for each end after the first."""
    offsets = np.ascontiguousarray(ends * (values.itemsize * (values.shape[1] if values.ndim > 1 else 1)), np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(runs: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """All numbers of some runs."""
    return np.frombuffer(b"".join(runs.drop_null().to_pylist()), kind)


def in_parts(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The order that puts the rows of a part together, where each part ends, and the parts."""
    order = np.argsort(part.astype(np.uint16) if len(part) and part.max() < 1 << 16 else part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    return order, np.append(starts, len(part)), pa.array(part[starts].astype(np.int32))


def rows_with(kind: str, **columns: pa.Array) -> pa.RecordBatch:
    """Rows of a schema, with null in the columns that aren't given."""
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    size = len(next(iter(columns.values())))
    names = [f.split() for f in kind.split(", ")]
    return pa.RecordBatch.from_arrays([columns.get(n, pa.nulls(size, types[t])) for n, t in names], [n for n, _ in names])


def coded(docs: DataFrame, known: Broadcast) -> DataFrame:
    """row, doc_id, held_out and the word numbers of every document: words (32 bits each), -1 for those in rare (64 bits)."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, first, number = Numbers(known.value), TaskContext.get().partitionId() << 40, 0
        last = numbers.of(pa.array([b""], pa.binary()))[0]
        for batch in portions(batches):
            owner, words = words_of(batch.column("text"))
            ends = np.append(0, np.cumsum(np.bincount(owner, minlength=batch.num_rows) + 1))
            ids = np.full(ends[-1], last)
            ids[np.arange(len(owner)) + owner] = numbers.of(words)
            far = ids >= len(numbers.known)
            rows = pa.array(np.arange(number, number + batch.num_rows) + first, pa.int64())
            number += batch.num_rows
            yield pa.RecordBatch.from_arrays([rows, batch.column("doc_id").cast(pa.int64()), batch.column("held_out"),
                                              packed(np.where(far, -1, ids).astype(np.int32), ends), packed(ids[far], np.append(0, np.cumsum(far))[ends])],
                                             ["row", "doc_id", "held_out", "words", "rare"])

    shipped(docs.sparkSession)
    return byte_texts(docs, "doc_id", "held_out").mapInArrow(code, "row long, doc_id long, held_out boolean, words binary, rare binary")


def tokens_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the document in the batch, number of the word before (at the start the end token) and of the word, of every token."""
    words = unpacked(batch.column("words"), np.int32).astype(np.int64)
    words[words < 0] = unpacked(batch.column("rare"), np.int64)
    sizes = pc.binary_length(batch.column("words")).to_numpy(zero_copy_only=False) // 4
    return np.repeat(np.arange(batch.num_rows), sizes), np.concatenate([words[-1:], words[:-1]]), words


def rows_of(batch: pa.RecordBatch) -> np.ndarray:
    """Twice the row, and one if it is held out."""
    return batch.column("row").to_numpy() * 2 + batch.column("held_out").to_numpy(zero_copy_only=False)


class Cells:
    """Where the pairs of two frequent words meet: pair number modulo ``cells`` is the cell, the rest its 31-bit code there."""

    def __init__(self, frequent: int, tokens: int):
        self.frequent = frequent
        self.cells = max(frequent * frequent // (1 << 31) + 1, tokens // PAIRS_TOGETHER) | 1

    def words(self, cell: np.ndarray | int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.divmod(code.astype(np.int64) * self.cells + cell, self.frequent)

    def dealt(self, docs: DataFrame, by_row: bool) -> DataFrame:
        """cell, codes (32 bits each), their counts (32) and rows_of() (64); without rows the counts of all rows together."""
        frequent, cells = self.frequent, self.cells

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, DOCS_TOGETHER):
                if not batch.num_rows:
                    continue
                doc, before, word = tokens_of(batch)
                near = (before < frequent) & (word < frequent)
                pair, doc = before[near] * frequent + word[near], doc[near] if by_row else np.zeros(int(near.sum()), np.int64)
                span = frequent * frequent // cells + 1
                keys, counts = np.unique((pair % cells * batch.num_rows + doc) * span + pair // cells, return_counts=True)
                place, code = np.divmod(keys, span)
                cell, doc = np.divmod(place, batch.num_rows)
                starts = np.flatnonzero(np.diff(cell, prepend=-1))
                ends = np.append(starts, len(cell))
                rows = rows_of(batch)[doc] if by_row else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(cell[starts].astype(np.int32)), packed(code.astype(np.int32), ends), packed(counts.astype(np.int32), ends),
                    packed(rows, ends if by_row else np.zeros(len(ends), np.int64))], ["cell", "code", "n", "row"])

        return docs.mapInArrow(deal, "cell int, code binary, n binary, row binary")


# Pairs with rare words, packed by part: both tells that neither word is frequent, left has what sweeps left for the word before then.
PAIRS = "part int, both boolean, before binary, word binary, n binary, row binary, left binary, id binary, state binary"


def rare_pairs(docs: DataFrame, frequent: int, parts: int, both: bool | None = None) -> DataFrame:
    """PAIRS, one for each place where a word is not frequent: in the part of the rare word (the second of two), without rows.

    If both is given, those of one or of two rare words, with rows_of(); two are in the part of the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, DOCS_TOGETHER):
            if not batch.num_rows:
                continue
            doc, before, word = tokens_of(batch)
            first, second = before >= frequent, word >= frequent
            far = np.flatnonzero(first | second if both is None else first & second if both else first ^ second)
            if not len(far):
                continue
            before, word, second = before[far], word[far], second[far] & (not both)
            order, ends, part = in_parts(np.where(second, word, before) % parts)
            rows = {} if both is None else {"row": packed(rows_of(batch)[doc[far]][order], ends)}
            yield rows_with(PAIRS, part=part, both=pa.array([bool(both)] * len(part)), before=packed(before[order], ends), word=packed(word[order], ends), **rows)

    return docs.mapInArrow(run, PAIRS)


def distinct_pairs(before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different pair is first, and which of them every pair is."""
    order = np.lexsort((word, before))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(before[order]) != 0) | (np.diff(word[order]) != 0)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(fresh) - 1
    return order[fresh], place


class States:
    """What some sweeps left for the frequent words, by their number: hash, count, tables of their contexts and probability."""

    def __init__(self, rows: pa.Table, hashes: np.ndarray, sweeps: int):
        order = np.argsort(rows.column("id").to_numpy())
        self.hashes, self.frequent = hashes, len(hashes)
        self.count = rows.column("count").to_numpy()[order]
        self.tables, self.probability = (np.ascontiguousarray(rows.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
                                                              .astype(float).reshape(-1, sweeps)[order].T) for c in ("tables", "probability"))

    def keys(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """A key of every pair, whichever words are frequent."""
        hashed = [(self.hashes[np.minimum(w, self.frequent - 1)] if self.frequent else w) * (w < self.frequent) + (w - self.frequent) * (w >= self.frequent)
                  for w in (before, word)]
        return hashed[0].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + hashed[1].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)


def pair_log(keys: np.ndarray, count: np.ndarray, context_count: np.ndarray, tables: np.ndarray, probability: np.ndarray, less: float, first: int) -> np.ndarray:
    """log10 of the probability of words after others, averaged over the sweeps after the first one given.

    Tables of the contexts and probabilities of the words come by sweep; a pair's own tables are drawn again from those of the sweep before.
    """
    found = []
    for k in range(1, len(tables)):
        own = seats(count, probability[k - 1], STRENGTH, less, tables[k - 1], keys, first + k)
        found.append((count - less * own + (STRENGTH + less * tables[k]) * probability[k]) / (STRENGTH + context_count))
    return np.log10(np.maximum(np.mean(found, axis=0), 1e-300))


class Left:
    """What sweeps left for the rare words of a part: a row of count, tables and probabilities by sweep for each word."""

    def __init__(self, table: pa.Table):
        ids, values = unpacked(table.column("id"), np.int64), unpacked(table.column("state"), float)
        order = np.argsort(ids)
        self.ids, self.values = ids[order], values.reshape(len(ids), len(values) // max(1, len(ids)))[order]

    def of(self, ids: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.ids, ids)
        assert np.array_equal(self.ids[at], ids)
        return self.values[at]


class Pairs:
    """The pairs of a part with what sweeps left for their words, rare or frequent."""

    def __init__(self, table: pa.Table, frequent: int):
        self.frequent, self.state = frequent, Left(table)
        two = table.column("left").is_valid()
        table = pa.concat_tables([table.filter(pc.invert(two)), table.filter(two)])
        self.before, self.word, self.n, self.row = (unpacked(table.column(c), np.int64) for c in ("before", "word", "n", "row"))
        left = unpacked(table.column("left"), float)
        self.left = left.reshape(-1, self.state.values.shape[1]) if len(left) else left  # of the last pairs

    def filled(self, at: np.ndarray, common: States) -> tuple[np.ndarray, ...]:
        """Of some pairs: keys, tables and probabilities by sweep, counts of the words before and of the words."""
        before, word, sweeps = self.before[at], self.word[at], len(common.tables)
        out, rare = [], (before >= self.frequent, word >= self.frequent)
        for ids, far, own, first in ((before, rare[0], common.tables, 1), (word, rare[1], common.probability, 1 + sweeps)):
            values, count = np.empty((sweeps, len(ids))), np.empty(len(ids))
            values[:, ~far], count[~far] = own[:, ids[~far]], common.count[ids[~far]]
            two = far & rare[0] & rare[1] if ids is before else np.zeros(len(ids), bool)
            for which, found in ((far & ~two, None), (two, self.left)):
                if which.any():
                    state = self.state.of(ids[which]) if found is None else found[at[which] - (len(self.before) - len(found))]
                    values[:, which], count[which] = state[:, first:first + sweeps].T, state[:, 0]
            out.append((values, count))
        (tables, before_count), (probability, word_count) = out
        return common.keys(before, word), tables, probability, before_count, word_count


def met(one: DataFrame, two: DataFrame, state: DataFrame, parts: int) -> DataFrame:
    """All PAIRS and the state in the part of their rare word; those of two rare words go there from the part of the first."""

    def enriched(table: pa.Table) -> pa.Table:
        left, pairs = Left(table), [unpacked(table.column(c), np.int64) for c in ("before", "word", "n", "row")]
        order, ends, part = in_parts(pairs[1] % parts)
        columns = {c: packed(x[order], ends) for c, x in zip(("before", "word", "n", "row"), pairs, strict=True) if len(x)}
        return pa.Table.from_batches([rows_with(PAIRS, part=part, **columns, left=packed(left.of(pairs[0])[order], ends))])

    return one.unionByName(two.unionByName(state).groupBy("part").applyInArrow(enriched, PAIRS)).unionByName(state)


class Contexts:
    """The restaurants of the words before: pairs that occur twice or more are seated by sweeps, the others have one table."""

    def __init__(self, docs: DataFrame, vocabulary: DataFrame, known: Broadcast, tokens: int, rare: int = 0):
        spark, names = docs.sparkSession, Numbers(known.value).known
        self.spark, self.frequent, self.cells = spark, len(names), Cells(len(names), tokens)
        self.parts = parts = max(PARTS, rare // RARE_TOGETHER) | 1
        self.hashes = np.fromiter(map(word_hash, names.to_pylist()), np.int64, len(names))
        train, cells, frequent = docs.where(~F.col("held_out")), self.cells, self.frequent
        # Of pairs, those that come again, and how many come once and twice; of words by part, in how many pairs they are first and second, and if in one that comes again.
        near_kind = "cell int, code binary, n binary, ones long, twos long, part int, id binary, seen binary"
        far_kind = f"{PAIRS}, ones long, twos long, seen binary"
        word_kind = "part int, id binary, seen binary, word binary, count binary"

        def words_seen(kind: str, before: np.ndarray, word: np.ndarray, again: np.ndarray) -> pa.RecordBatch:
            ids, place = np.unique(np.concatenate([before, word]), return_inverse=True)
            sums = [np.bincount(x, w, len(ids)) for x, w in ((place[:len(before)], None), (place[len(before):], None), (place, np.concatenate([again, again])))]
            order, ends, part = in_parts(ids % parts)
            return rows_with(kind, part=part, id=packed(ids[order], ends), seen=packed(np.stack(sums, 1).astype(np.int64)[order], ends))

        def merge(table: pa.Table) -> pa.Table:
            cell = table.column("cell")[0].as_py()
            code, place = np.unique(unpacked(table.column("code"), np.int32), return_inverse=True)
            n = np.bincount(place, unpacked(table.column("n"), np.int32), len(code)).astype(np.int64)
            again = n > 1
            pairs = rows_with(near_kind, cell=pa.array([cell], pa.int32()), code=pa.array([code[again].tobytes()]), n=pa.array([n[again].tobytes()]),
                              ones=pa.array([int((n == 1).sum())]), twos=pa.array([int((n == 2).sum())]))
            return pa.Table.from_batches([pairs, words_seen(near_kind, *cells.words(cell, code), np.zeros(len(code)))])

        def merge_rare(table: pa.Table) -> pa.Table:
            before, word = (unpacked(table.column(c), np.int64) for c in ("before", "word"))
            first, place = distinct_pairs(before, word)
            before, word, n = before[first], word[first], np.bincount(place)
            again = n > 1
            out = [rows_with(far_kind, ones=pa.array([int((n == 1).sum())]), twos=pa.array([int((n == 2).sum())])), words_seen(far_kind, before, word, again)]
            for both in (False, True):
                at = np.flatnonzero(again & (both == ((before >= frequent) & (word >= frequent))))
                order, ends, part = in_parts(np.where((word[at] >= frequent) & (not both), word[at], before[at]) % parts)
                out.append(rows_with(far_kind, part=part, both=pa.array([both] * len(part), pa.bool_()), **{c: packed(x[at][order], ends) for c, x in (("before", before), ("word", word), ("n", n))}))
            return pa.Table.from_batches(out)

        def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers = Numbers(known.value)
            for batch in gathered(batches, COUNTED):
                ids = numbers.of(batch.column("word"))
                order, ends, part = in_parts(ids % parts)
                words = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), batch.column("word").take(pa.array(order)))
                yield rows_with(word_kind, part=part, id=packed(ids[order], ends), word=pc.binary_join(words, pa.scalar(b"\n", pa.binary())),
                                count=packed(batch.column("count").to_numpy(zero_copy_only=False)[order], ends))

        def joined(table: pa.Table) -> pa.Table:
            names = table.column("word").is_valid()
            found, table = table.filter(pc.invert(names)), table.filter(names)
            seen, place = np.unique(unpacked(found.column("id"), np.int64), return_inverse=True)
            sums = unpacked(found.column("seen"), np.int64).reshape(-1, 3)
            sums = [np.append(np.bincount(place, x, len(seen)).astype(np.int64), 0) for x in sums.T]
            ids = unpacked(table.column("id"), np.int64)
            at = np.searchsorted(seen, ids)
            at[np.append(seen, -1)[at] != ids] = len(seen)
            words = [w for run in table.column("word").to_pylist() for w in run.split(b"\n")]  # words hold no white space
            return pa.table([pa.array(x) for x in (ids, pa.array(words, pa.binary()), unpacked(table.column("count"), np.int64), sums[0][at], sums[1][at], np.minimum(sums[2][at], 1).astype(np.int32))],
                            ["id", "word", "count", "followers", "contexts", "again"])

        near = stored(cells.dealt(train, False).groupBy("cell").applyInArrow(merge, near_kind), "near")
        far = stored(rare_pairs(train, frequent, parts).groupBy("part").applyInArrow(merge_rare, far_kind), "far")
        self.near = near.where("cell is not null").select("cell", "code", "n")
        self.far = far.where("before is not null").select(*(f.split()[0] for f in PAIRS.split(", ")))
        seen = [x.where("seen is not null").select("part", "id", "seen") for x in (near, far)]
        seen = vocabulary.mapInArrow(numbered, word_kind).unionByName(seen[0].unionByName(seen[1]), True)
        self.words = stored(seen.groupBy("part").applyInArrow(joined, "id long, word binary, count long, followers long, contexts long, again int"), "words")
        self.moving = stored(self.words.where(~self._alone()), "moving")
        sums = [x.agg(F.sum("ones"), F.sum("twos")).first() for x in (near, far)]
        self.less = from_counts(*(sum(s[k] or 0 for s in sums) for k in (0, 1)))
        # From the second sweep on, the tables above one each: id, those in its context, those of the word.
        self.more: dict[int, DataFrame] = {}

    def customers(self, sweep: int, moving: bool = False) -> DataFrame:
        """word and count: the customers of the word restaurant, one for each table of the contexts; if moving, without the words of alone()."""
        words = self.moving if moving else self.words
        words = words if sweep not in self.more else self._joined(words, [sweep])
        return words.select("word", (F.col("contexts") + (F.col(f"word_{sweep}") if sweep in self.more else 0)).alias("count")).where("count > 0")

    def _alone(self) -> Column:
        return (F.col("id") >= self.frequent) & (F.col("again") == 0) & (F.col("contexts") == 1)

    def alone(self) -> DataFrame:
        """word and count of those that have one customer in every sweep, and so one table."""
        return self.words.where(self._alone()).select("word", F.lit(1).cast("long").alias("count"))

    def _joined(self, words: DataFrame, sweeps: list[int]) -> DataFrame:
        more = None
        for sweep in sweeps:
            rows = self.more[sweep].select("id", *(F.when(F.lit(k == sweep), F.col(c)).otherwise(0).alias(f"{c}_{k}") for k in sweeps for c in ("before", "word"))) \
                if sweep in self.more else None
            more = rows if more is None else more if rows is None else more.unionByName(rows)
        names = [f"{c}_{k}" for k in sweeps for c in ("before", "word")]
        if more is None:
            return words.select("*", *(F.lit(0).alias(c) for c in names))
        more = more.groupBy("id").agg(*(F.sum(c).alias(c) for c in names))
        seated = (F.col("id") < self.frequent) | (F.col("again") > 0)  # only these words can have more
        others = words.where(~seated).select("*", *(F.lit(0).cast("long").alias(c) for c in names))
        return words.where(seated).join(more, "id", "left").na.fill(0, names).unionByName(others)

    def state(self, words: DataFrame, sent: Broadcast, dealt: bool = False) -> DataFrame:
        """id, count, tables of the context and probability of the word after each sample sent; dealt as PAIRS, to the word's part."""
        sweeps, parts = [s.seed - 1 for s in sent.value], self.parts

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in gathered(batches):
                b = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if c != "word"}
                probability = predictive(sent.value, batch.column("word").to_pylist(), [b["contexts"] + b[f"word_{k}"] for k in sweeps])
                tables = [b[f"before_{k}"] + b["followers"] for k in sweeps]
                if dealt:
                    order, ends, part = in_parts(b["id"] % parts)
                    yield rows_with(PAIRS, part=part, id=packed(b["id"][order], ends), state=packed(np.stack([b["count"], *tables, *probability], 1).astype(float)[order], ends))
                    continue
                ends = pa.array(np.arange(batch.num_rows + 1) * len(sweeps), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.stack(x, 1).ravel())) for x in (tables, probability)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("count"), *lists], ["id", "count", "tables", "probability"])

        return self._joined(words, sweeps).mapInArrow(run, PAIRS if dealt else "id long, count long, tables array<long>, probability array<double>")

    def known(self) -> DataFrame:
        """The words that every task knows."""
        return self.moving.where(F.col("id") < self.frequent)

    def common(self, state: DataFrame, sweeps: int) -> Broadcast:
        return self.spark.sparkContext.broadcast(States(state.where(F.col("id") < self.frequent).toArrow(), self.hashes, sweeps))

    def seat(self, before: Sample, sweep: int) -> None:
        """Seat the pairs by what the sweep before left; the tables above one each."""
        less, cells, frequent = self.less, self.cells, self.frequent
        samples = self.spark.sparkContext.broadcast([before])
        sent = self.common(self.state(self.known(), samples), 1)

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            common = sent.value
            for batch in batches:
                for cell, codes, n in zip(*(batch.column(c) for c in ("cell", "code", "n")), strict=True):
                    left, word = cells.words(cell.as_py(), np.frombuffer(codes.as_py(), np.int32))
                    n = np.frombuffer(n.as_py(), np.int64)
                    yield over(left, word, seats(n, common.probability[0][word], STRENGTH, less, common.tables[0][left], common.keys(left, word), sweep))

        def far(table: pa.Table) -> pa.Table:
            pairs = Pairs(table, frequent)
            keys, tables, probability, _, _ = pairs.filled(np.arange(len(pairs.before)), sent.value)
            return pa.Table.from_batches([over(pairs.before, pairs.word, seats(pairs.n, probability[0], STRENGTH, less, tables[0], keys, sweep))])

        def over(left: np.ndarray, word: np.ndarray, tables: np.ndarray) -> pa.RecordBatch:
            at = tables > 1
            none = np.zeros(int(at.sum()), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (
                (left[at], word[at]), (tables[at] - 1, none), (none, tables[at] - 1))], ["id", "before", "word"])

        kind = "id long, before long, word long"
        state = stored(self.state(self.moving.where((F.col("id") >= frequent) & (F.col("again") > 0)), samples, dealt=True), f"state_{sweep}")
        pairs = met(self.far.where(~F.col("both")), self.far.where("both"), state, self.parts)
        rows = self.near.mapInArrow(near, kind).unionByName(pairs.groupBy("part").applyInArrow(far, kind))
        self.more[sweep] = stored(rows.groupBy("id").agg(F.sum("before").alias("before"), F.sum("word").alias("word")), f"more_{sweep}")
        sent.destroy()
        samples.destroy()


def from_counts(ones: int, twos: int) -> float:
    """The discount for so many dishes with one and with two customers."""
    return float(np.clip(ones / (ones + 2 * twos), 0.1, 0.9)) if ones else 0.1


def summed_keys(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)


def gibbs(vocabulary: DataFrame, tokens: int, ones: int, twos: int, burn: int = BURN, samples: int = SAMPLES, contexts: Contexts | None = None) -> list[Sample]:
    """The samples kept; each sweep seats the pairs of the contexts, all words of the vocabulary and then the spelling restaurants.

    With contexts, the sample before the kept ones is returned too, and customers are the tables of the contexts, at first one a pair.
    """
    less = from_counts(ones, twos)
    spark, kept, first_tokens = vocabulary.sparkSession, [], tokens
    state = Sample(Spelling(), 0.0, tokens, less, 0)
    for sweep in range(burn + samples):
        if contexts:
            if sweep:
                contexts.seat(state, sweep)
                tokens = first_tokens + (contexts.more[sweep].agg(F.sum("word")).first()[0] or 0)
            vocabulary = contexts.customers(sweep, moving=True)
        sent = spark.sparkContext.broadcast(Sample(state.spelling, state.tables, tokens, less, state.seed))

        def seat(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            sums, parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
            for batch in gathered(batches):
                words, counts = batch.column("word").to_pylist(), batch.column("count").to_numpy()
                if not words:
                    continue
                tables = sent.value.seat(words, counts)
                keys, owner = positions(words)
                sums += [(keys, tables[owner]), (np.array([-1]), np.array([tables.sum()]))]
                parts += len(keys)
                if parts > KEYS_TOGETHER:
                    sums, parts = [summed_keys(sums)], 0
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in summed_keys(sums)], ["key", "count"])

        shipped(spark)
        if contexts and not sweep:
            alone = contexts.alone().mapInArrow(seat, "key long, count long").groupBy("key").agg(F.sum("count").alias("count")).toArrow()
        rows = vocabulary.mapInArrow(seat, "key long, count long").groupBy("key").agg(F.sum("count").alias("count")).toArrow()
        sent.destroy()
        if contexts:
            rows = pa.concat_tables([rows, alone])
        keys, counts = rows.column("key").to_numpy(), rows.column("count").to_numpy()
        keys, counts = summed_keys([(keys, counts)])
        tables = float(counts[keys < 0].sum())
        spelling = Spelling.sampled(keys[keys >= 0], counts[keys >= 0], state.spelling, sweep)
        state = Sample(spelling, tables, tokens, less, sweep + 1, state)
        if sweep >= burn - bool(contexts):
            kept.append(state)
    return kept


def most_frequent(vocabulary: DataFrame, frequent: int) -> tuple[pa.Table, int, int]:
    """word and count of about so many most frequent words, the tokens and the words of the training documents.

    Of the words of the least count taken, a share by their hash makes up the number: nothing is sorted, no task gets all.
    """
    seen = vocabulary.where("count > 0")
    sizes = sorted(seen.groupBy("count").agg(F.count("*").alias("words")).collect(), reverse=True)
    left, least, share = frequent, 0, 1.0
    for r in sizes:
        if r["words"] > left:
            least, share = r["count"], left / r["words"]
            break
        left -= r["words"]
    tied = (F.col("count") == least) & (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30)))
    words = seen.where((F.col("count") > least) | tied).toArrow().sort_by([("count", "descending"), ("word", "ascending")])
    return words, sum(r["count"] * r["words"] for r in sizes), sum(r["words"] for r in sizes)


SUMS = ("n_tokens", "n_known", "base_score", "score")


def score(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"))
    vocabulary = stored(word_counts(docs), "vocabulary")
    words, n, v = most_frequent(vocabulary, frequent)
    known = spark.sparkContext.broadcast(words.column("word").combine_chunks())
    texts = stored(coded(docs, known), "coded")
    contexts = Contexts(texts, vocabulary, known, n, n - (pc.sum(words.column("count")).as_py() or 0))
    known.destroy()
    customers, ones, twos = contexts.words.agg(F.coalesce(F.sum("contexts"), F.lit(0)), F.count_if(F.col("contexts") == 1), F.count_if(F.col("contexts") == 2)).first()
    samples = gibbs(contexts.customers(0), customers, ones, twos, contexts=contexts)
    sent = spark.sparkContext.broadcast(samples)
    frequent, all_counts, parts = contexts.frequent, n + 0.1 * (v + 1), contexts.parts
    state = stored(contexts.state(contexts.words.where(F.col("id") >= frequent), sent, dealt=True), "state")
    common = contexts.common(contexts.state(contexts.known(), sent), len(samples))
    sent.destroy()
    sent, cells, less, first = common, contexts.cells, contexts.less, samples[0].seed - 1

    def near(table: pa.Table) -> pa.Table:
        common, cell = sent.value, table.column("cell")[0].as_py()
        code, place = np.unique(unpacked(table.column("code"), np.int32), return_inverse=True)
        row, times = unpacked(table.column("row"), np.int64), unpacked(table.column("n"), np.int32).astype(np.int64)
        count = np.bincount(place, times * (row % 2 == 0), len(code)).astype(np.int64)
        before, word = cells.words(cell, code)
        log = pair_log(common.keys(before, word), count, common.count[before], common.tables[:, before], common.probability[:, word], less, first)
        return summed(row // 2, times, common.count[word][place], log[place])

    def far(table: pa.Table) -> pa.Table:
        pairs = Pairs(table, frequent)
        at, place = distinct_pairs(pairs.before, pairs.word)
        keys, tables, probability, before_count, word_count = pairs.filled(at, sent.value)
        count = np.bincount(place, pairs.row % 2 == 0, len(at)).astype(np.int64)
        log = pair_log(keys, count, before_count, tables, probability, less, first)
        return summed(pairs.row // 2, np.ones(len(place), np.int64), word_count[place], log[place])

    def summed(row: np.ndarray, times: np.ndarray, word_count: np.ndarray, log: np.ndarray) -> pa.Table:
        row, place = np.unique(row, return_inverse=True)
        base = np.log10((word_count + 0.1) / all_counts)
        sums = [np.bincount(place, x, len(row)) for x in (times, times * (word_count > 0), times * base, times * log)]
        return pa.table([pa.array(row), *(pa.array(x.astype(np.int64)) for x in sums[:2]), *map(pa.array, sums[2:])], ["row", *SUMS])

    kind = "row long, n_tokens long, n_known long, base_score double, score double"
    pairs = met(*(rare_pairs(texts, frequent, parts, both) for both in (False, True)), state, parts)
    # One after the other, each with its shuffles gone before the next.
    sums = [stored(part.groupBy("row").agg(*(F.sum(c).alias(c) for c in SUMS)), name) for name, part in (
        ("near_sums", cells.dealt(texts, True).groupBy("cell").applyInArrow(near, kind)), ("far_sums", pairs.groupBy("part").applyInArrow(far, kind)))]
    sent.destroy()
    sums = texts.select("row", "doc_id", "held_out", *(F.lit(None).alias(c) for c in SUMS)).unionByName(sums[0], True).unionByName(sums[1], True)
    return sums.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), *(F.sum(c).alias(c) for c in SUMS)).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
