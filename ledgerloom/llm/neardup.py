"""MinHash near-duplicates by min-max hashing (operator 3).

A text's word shingles are hashed to 64 bits. Under each of ``HASHES`` permutations both
the least and the greatest value are kept: two independent samples for one evaluation, so
half the evaluations give the same number of unbiased signature values. ``ROWS`` values of
as many permutations make a band; minima and maxima have bands of their own. Two texts of
similarity 0.8 share none of the 32 bands with probability (1 - 0.8^4)^32 < 5e-8.

Texts with equal sets are one class, which enters once, by its smallest doc_id. Texts that
share a band are candidates. A bucket (the texts of one band value) is not paired all with
all: its smallest member is compared with the others, which joins most of a group at once.
Then members of a bucket that are still in different components are compared, in blocks.
So every candidate pair is confirmed, refused, or within one component already.

Confirmation compares full shingle sets. For each hub the members' texts are sent to its
task, salted, so a hub with very many members is spread; the sets are built there.

Components are found by alternating large-star and small-star steps, each a grouping.

Defined cases: null text, or one without words, has an empty set and links to nothing;
fewer words than a shingle: the whole sequence is the only shingle. Rows are documents:
equal rows are each returned, with the same component. A null doc_id names nothing: such
a row is linked to nothing, component_id null, kept. Rows that share a doc_id but not the
text have the smallest id that either text reaches only if that id is theirs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, every, free_name, mapped, scratch, shipped

SHINGLE = 5
PERCENT = 80
HASHES = 64
ROWS = 4
# A hub's members are spread over so many tasks.
SALTS = 32
# Members of a bucket that are compared with another at once.
BLOCK = 256
# Hash evaluations and bytes of words held at once.
CELLS = 1 << 20
CHUNK = 1 << 20
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_RANDOM = np.random.default_rng(20240229)
BYTE_HASH = _RANDOM.integers(0, 1 << 64, 256, np.uint64)
BYTE_STEP = np.uint64(0x9E3779B97F4A7C15)
WORD_STEP = np.uint64(0xD6E8FEB86659FD93)
TIMES = _RANDOM.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
PLUS = _RANDOM.integers(0, 1 << 64, HASHES, np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _powers(step: np.uint64, count: int) -> np.ndarray:
    key = int(step)
    if len(_POWERS.get(key, ())) < count:
        _POWERS[key] = np.cumprod(np.full(max(count, 256), step))
    return _POWERS[key][:count]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word: polynomial over random byte values, then mixed."""
    out = []
    at = 0
    while at < len(words):
        end, size = at, 0
        while end < len(words) and size < CHUNK:
            size += len(words[end])
            end += 1
        part = words[at:end]
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        starts = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
        values = BYTE_HASH[np.frombuffer(b"".join(part), np.uint8)] * _powers(BYTE_STEP, int(sizes.max()))[place]
        out.append(mix(np.add.reduceat(values, starts)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; empty without words."""
    words = word_hashes(text.translate(LOWER).split())
    if not len(words):
        return words
    width = min(size, len(words))
    code = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        code = code * WORD_STEP + words[k:k + len(code)]
    code = np.sort(mix(code + np.uint64(width)))
    keep = np.ones(len(code), bool)
    keep[1:] = code[1:] != code[:-1]
    return code[keep]


def bands(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key a band: ROWS minima, or ROWS maxima, of as many permutations."""
    low, high = np.full(HASHES, (1 << 64) - 1, np.uint64), np.zeros(HASHES, np.uint64)
    step = max(1, CELLS // HASHES)
    for at in range(0, len(shingles), step):
        values = shingles[at:at + step, None] * TIMES + PLUS
        np.minimum(low, values.min(axis=0), out=low)
        np.maximum(high, values.max(axis=0), out=high)
    both = np.concatenate((low.reshape(-1, ROWS), high.reshape(-1, ROWS)))
    key = np.arange(len(both), dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * WORD_STEP + both[:, k])
    return key.view(np.int64)


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, set_id (digest of the set, null if empty) and band keys of every row."""

    def one(doc_id: int | None, text: bytes) -> tuple:
        found = shingle_set(text, size)
        if not len(found):
            return doc_id, 0, None, None
        return doc_id, len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest(), bands(found).tolist()

    return mapped(byte_texts(docs, "doc_id"), lambda: lambda b: [one(i, t) for i, t in zip(b["doc_id"], b["text"], strict=True)],
                  "doc_id long, n_shingles long, set_id binary, bands array<long>")


def confirm(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (hub, id) whose full sets are similar enough. docs: id and text (bytes) of all that occur."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    sides = salted.select("hub", "salt", "id", F.lit(1).alias("role")).unionByName(
        salted.select("hub", "salt", F.col("hub").alias("id"), F.lit(0).alias("role")).distinct())
    rows = sides.join(docs, "id").select("hub", "salt", "role", "id", "text")
    shipped(docs.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, sets = None, []  # the hub's rows come first; they are few, as they differ in text
        for batch in batches:
            linked = ([], [])
            for h, role, i, text in zip(*(batch.column(c).to_pylist() for c in ("hub", "role", "id", "text")), strict=True):
                if role == 0:
                    hub, sets = h, [*(sets if h == hub else ()), shingle_set(text, size)]
                    continue
                own = shingle_set(text, size)
                for other in sets:
                    least, most = sorted((len(own), len(other)))
                    if 100 * least < percent * most:
                        continue
                    common = len(np.intersect1d(own, other, assume_unique=True))
                    if 100 * common >= percent * (len(own) + len(other) - common):
                        linked[0].append(h)
                        linked[1].append(i)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in linked], ["hub", "id"])

    dealt = rows.repartition(F.col("hub"), F.col("salt")).sortWithinPartitions("hub", "salt", "role")
    return dealt.mapInArrow(compare, "hub long, id long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node it reaches) of all linked nodes; links are pairs a, b.

    Large-star links each node's larger neighbours, small-star its smaller ones, to the
    smallest of them; both until nothing changes, in a number of rounds that grows with
    the logarithm of the graph. A node with very many neighbours is grouped by a minimum
    and a join, never collected.
    """
    edges = scratch(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    total = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = scratch(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        if now == total:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        total = now


def classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    marked = scratch(signatures(docs, size), "signatures")
    named = marked.where("set_id is not null and doc_id is not null")
    first = named.groupBy("set_id").agg(F.min("doc_id").alias("id"))
    members = named.alias("n").join(first.alias("f"), F.expr("n.set_id = f.set_id and n.doc_id = f.id")).select("id", "bands").distinct()
    buckets = members.select("id", F.explode("bands").alias("band"))
    hubs = buckets.groupBy("band").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").select("band", "hub")
    shared = scratch(buckets.join(hubs, "band"), "buckets")
    pairs = scratch(shared.where("id <> hub").select("hub", "id").distinct(), "pairs")
    wanted = pairs.select("id").unionByName(pairs.select(F.col("hub").alias("id"))).distinct()
    bodies = scratch(byte_texts(docs.where("doc_id is not null"), "doc_id").withColumnRenamed("doc_id", "id").join(wanted.hint("merge"), "id", "left_semi"), "bodies")
    links = scratch(confirm(pairs, bodies, size, percent), "links")
    pair = (F.col("hub").alias("a"), F.col("id").alias("b"))
    found = scratch(components(links.select(*pair)), "components")
    more = scratch(_across(shared, found, bodies, size, percent), "links")
    if not more.isEmpty():
        found = scratch(components(links.unionByName(more).select(*pair)), "components")
    roots = first.join(found, F.col("id") == F.col("node"), "left").select(F.col("set_id").alias("_set"), F.coalesce("root", "id").alias("_root"))
    out = marked.join(roots, (F.col("set_id") == F.col("_set")) & F.col("doc_id").isNotNull(), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _across(shared: DataFrame, found: DataFrame, bodies: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between members of a bucket that the first comparison left in different components.

    The hub was compared with all members. Of the others, those outside the component with
    the smallest root are dealt into blocks of about ``BLOCK``; each block is held in a
    task while all members of the bucket but the hub pass by, and is compared with each at
    once. No pair is ever a row, and a bucket costs one row for each member and block.
    """
    parts = (shared.where("id <> hub").join(found, F.col("id") == F.col("node"), "left").select("band", "id", F.coalesce("root", "id").alias("root")))
    split = parts.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("band", "low")
    mixed = scratch(parts.join(split, "band"), "mixed")
    blocks = mixed.where("root <> low").groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    held = mixed.where("root <> low").join(blocks, "band").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    passing = mixed.join(blocks, "band").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = held.select("band", "block", "id", "root", F.lit(0).alias("role")).unionByName(passing.select("band", "block", "id", "root", F.lit(1).alias("role")))
    dealt = rows.join(bodies, "id").repartition(F.col("band"), F.col("block")).sortWithinPartitions("band", "block", "role")
    shipped(shared.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held_ids, held_roots, held_sets, index = None, [], [], [], None
        for batch in batches:
            linked = ([], [])
            for *key, role, i, root, text in zip(*(batch.column(c).to_pylist() for c in ("band", "block", "role", "id", "root", "text")), strict=True):
                if key != here:
                    here, held_ids, held_roots, held_sets, index = key, [], [], [], None
                own = shingle_set(text, size)
                if role == 0:
                    held_ids.append(i)
                    held_roots.append(root)
                    held_sets.append(own)
                    continue
                if index is None:
                    index = _index(held_sets)
                    sizes, roots = np.array([len(x) for x in held_sets]), np.array(held_roots)
                common = _common(own, index, len(held_sets))
                for k in np.flatnonzero((100 * common >= percent * (len(own) + sizes - common)) & (roots != root)).tolist():
                    linked[0].append(held_ids[k])
                    linked[1].append(i)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in linked], ["hub", "id"])

    return dealt.mapInArrow(compare, "hub long, id long").distinct()


def _index(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of some sets, where the owners of each begin, and the owners."""
    values, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(values, kind="stable")
    distinct, begin = np.unique(values[order], return_index=True)
    return distinct, np.append(begin, len(values)), owners[order]


def _common(own: np.ndarray, index: tuple[np.ndarray, np.ndarray, np.ndarray], count: int) -> np.ndarray:
    """How many shingles each indexed set has in common with one set."""
    distinct, begin, owners = index
    at = np.minimum(np.searchsorted(distinct, own), len(distinct) - 1)
    at = at[distinct[at] == own]
    runs = begin[at + 1] - begin[at]
    places = np.arange(int(runs.sum())) + np.repeat(begin[at] - (np.cumsum(runs) - runs), runs)
    return np.bincount(owners[places], minlength=count)


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component of rows, one with the smallest doc_id (null last); rows without words stay.

    Rows are numbered once, as an id may be null or repeated; each is compared by its own text.
    """
    row = free_name(docs, "_row")
    numbered = scratch(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = classes(numbered.select(F.col(row).alias("doc_id"), "text"), size, percent).select(F.col("doc_id").alias(row), "component_id")
    rows = scratch(found.join(numbered.select(row, "doc_id"), row), "rows")
    first = rows.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.col(row).alias("row"))).alias("first"))
    gone = rows.select(row).join(first.select(F.col("first.row").alias(row)), row, "left_anti")
    return numbered.join(gone, row, "left_anti").select(*every(docs))
