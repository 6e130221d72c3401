"""Benchmark decontamination by one Aho-Corasick automaton over words (operator 9).

The windows of all test items, as sequences of word numbers, make up one automaton. It
reads the numbers of a document's words once and reports every window that ends at each
word. Hits are word positions; spans map them to code points of the original text.

Scale: documents are only mapped, never shuffled. The benchmark is broadcast, in blocks
of at most ``BLOCK_BYTES``; a larger one is scanned block by block and the hits of a
document are united by its key.

Defined cases: null or empty text has no words and no hits; an item without words has no
window; one without an id is searched, but not named; items with equal windows are all named; rows with equal or null doc_id are
scanned each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, byte_texts, mapped, pieces, rows_mapped, shipped

WINDOW = 10
# Text of test items in one automaton, which takes about 125 times as much memory.
BLOCK_BYTES = 768 << 10
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, n_words long, hit_words array<int>, spans array<struct<start:int,end:int>>, items array<long>"
_SCANNERS: dict[str, Scanner] = {}


class Scanner:
    """The automaton of some items; ``scan`` gives hit words and items of one text."""

    def __init__(self, items: list[tuple[int | None, bytes]], window: int):
        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = defaultdict(set)  # empty for items without an id
        for item, text in items:
            words = [self.number.setdefault(w, len(self.number) + 1) for w in alnum_words(text)]
            for at in range(max(1, len(words) - window + 1) if words else 0):
                owners[tuple(words[at:at + window])].update(() if item is None else (item,))
        self.machine = None
        if owners:
            self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for words, names in owners.items():
                self.machine.add_word(words, (len(words), names))
            self.machine.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[int], list[int]]:
        words = alnum_words(text)
        hit, items, number = set(), set(), self.number
        if self.machine is not None and words:
            numbers = tuple([number.get(w, 0) for w in words])
            for end, (length, names) in self.machine.iter(numbers):
                hit.update(range(end - length + 1, end + 1))
                items |= names
        return len(words), sorted(hit), sorted(items)


def spans_of(text: bytes, hit: list[int]) -> list[dict]:
    """Runs of hit words as code-point spans of the original text, end exclusive."""
    if not hit:
        return []
    places = [m.span() for m in WORD.finditer(text.decode())]
    out = []
    for at in hit:
        start, end = places[at]
        if out and at - 1 == last:
            out[-1]["end"] = end
        else:
            out.append({"start": start, "end": end})
        last = at
    return out


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row: doc_id, n_words, hit_words (positions), spans (code points) and items, ascending."""
    parts = _blocks(benchmark, block_bytes)
    if len(parts) == 1:
        return _scan(docs, parts[0](), window)
    keyed = docs.withColumn("_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = None
    for part in parts:
        one = _scan(keyed, part(), window, key=True)
        found = one if found is None else found.unionByName(one)
    flat = lambda c: F.sort_array(F.array_distinct(F.flatten(F.collect_list(c))))
    merged = found.distinct().groupBy("doc_id", "_key").agg(F.max("n_words").alias("n_words"), flat("hit_words").alias("hit_words"), flat("items").alias("items"))
    rows = byte_texts(keyed, "doc_id", "_key").alias("d").join(
        merged.alias("m"), F.expr("d.doc_id <=> m.doc_id and d._key = m._key")).select("d.doc_id", "d.text", "m.n_words", "m.hit_words", "m.items")
    return mapped(rows, lambda: lambda b: [(i, n, h, spans_of(t, h), x) for i, t, n, h, x in
                                           zip(b["doc_id"], b["text"], b["n_words"], b["hit_words"], b["items"], strict=True)], SCHEMA)


def _blocks(benchmark: DataFrame, block_bytes: int) -> list[Callable[[], list[tuple]]]:
    """Functions that read the items of each block."""
    items = benchmark.select("item_id", F.col("text").cast("binary").alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return [lambda k=k: [tuple(r) for r in items.where(part == k).collect()] for k in range(blocks)]


def _scan(docs: DataFrame, items: list[tuple], window: int, key: bool = False) -> DataFrame:
    scanner = _shared_scanner(docs, items, window)

    def rows():
        scan = scanner().scan

        def apply(b: dict) -> list[tuple]:
            out = []
            for k, text in enumerate(b["text"]):
                n, hit, names = scan(text)
                out.append((b["doc_id"][k], *((b["_key"][k],) if key else ()), n, hit, *(() if key else (spans_of(text, hit),)), names))
            return out

        return apply

    schema = "doc_id long, _key long, n_words long, hit_words array<int>, items array<long>" if key else SCHEMA
    return mapped(byte_texts(docs, "doc_id", *(("_key",) if key else ())), rows, schema)


def _shared_scanner(docs: DataFrame, items: list[tuple], window: int) -> Callable[[], Scanner]:
    """What gives a task the automaton of the items, built once in each Python worker."""
    rows = sorted(((i, bytes(t)) for i, t in items), key=repr)
    sent = docs.sparkSession.sparkContext.broadcast(rows)
    name = hashlib.sha256(repr((window, rows)).encode()).hexdigest()

    def scanner() -> Scanner:
        if name not in _SCANNERS:
            _SCANNERS.clear()
            _SCANNERS[name] = Scanner(sent.value, window)
        return _SCANNERS[name]

    return scanner


def digest(found: DataFrame) -> DataFrame:
    """Counts and the sha256 of the items' ids, sorted as strings."""
    names = F.array_join(F.sort_array(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (F.size("hit_words") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows without those that hold a window of a test item; each row is judged by its own text."""
    shipped(docs.sparkSession)
    for part in _blocks(benchmark, block_bytes):
        scanner = _shared_scanner(docs, part(), window)

        def clean(batches: Iterator[pa.RecordBatch], scanner=scanner) -> Iterator[pa.RecordBatch]:
            scan = scanner().scan
            for batch in pieces(batches):
                yield batch.filter(pa.array([not scan((t or "").encode())[1] for t in batch.column("text").to_pylist()], pa.bool_()))

        docs = rows_mapped(docs, clean)
    return docs


def sha(names: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
