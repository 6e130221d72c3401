"""Ranked lexical search by exact inner products in ball trees.

A document is a sparse vector over the terms that items ask for: the root of a term's weight times
its impact; an item has the roots of its weights. Every task cuts its documents into groups of bounded
size and builds a ball tree over each: a ball is halved by the distance to two far documents, until a
leaf has LEAF of them. No document of a ball scores more than the item's product with the centre plus
the radius times the length of the item (Cauchy-Schwarz), where only terms that the ball holds count
for that length; the bound is rounded up by more than the arithmetic can lose. An item visits balls
best first and stops at the first whose bound is below its 50th score so far; a bound equal to it is
still visited, because ties go to the smaller doc_id. Leaves are scored in 64-bit integers, so results
do not depend on the tree, the partitions or rounding.

Items are dealt to blocks of at most TERMS distinct terms, one after the other (an item with more is
a block of its own); a block is all that the driver holds and sends at once, and it is run against all
documents. Rows sent on are the ranked ones of a task, reduced by a hash of their ids before the last
ranking of an item.

A null text has no terms and is in no result. Rows with the same doc_id are documents each; null
doc_ids rank behind others. Rows with the same item_id (null included) are one item with the terms of
all. An item without terms, or whose terms no document holds, has no rows; so have empty tables.
Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import alnum_words, byte_texts, pieces, scratch, shipped

RANKED = 50
TERMS = 8192  # distinct terms of a block of items
CELLS = 1_572_864  # documents times terms of one tree: 6 MB of impacts
LEAF = 16
DEALT = 64  # parts of an item's rows before its last ranking


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and terms (bytes, distinct, sorted) of every item that has any."""
    shipped(items.sparkSession)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            pairs = [(i, w) for i, t in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for w in set(alnum_words(t))]
            ids, words = zip(*pairs, strict=True) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("item_id").type), pa.array(words, pa.binary())], ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return byte_texts(items, "item_id").mapInArrow(split, f"item_id {kind}, term binary").groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def blocks(items: DataFrame, terms: int = TERMS) -> Iterator[list[tuple]]:
    """Items in blocks of at most ``terms`` distinct terms; only one block is held."""
    block: list[tuple] = []
    held: set[bytes] = set()
    for row in item_terms(items).orderBy("item_id").toLocalIterator():
        words = [bytes(w) for w in row["terms"]]
        if block and len(held.union(words)) > terms:
            yield block
            block, held = [], set()
        block.append((row["item_id"], words))
        held.update(words)
    if block:
        yield block


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (terms with repeats) and, in parallel lists, the numbers and occurrences of the vocabulary's terms; rows without terms are left out."""
    shipped(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast({w: k for k, w in enumerate(vocabulary)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        for batch in pieces(batches):
            kept, totals, terms, times = [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                words = alnum_words(text)
                if words:
                    found = Counter(words)
                    shared = found.keys() & number.keys()
                    kept.append(row)
                    totals.append(len(words))
                    terms.append([number[w] for w in shared])
                    times.append([found[w] for w in shared])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(kept, pa.int64())), pa.array(totals, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(times, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "times"])

    return byte_texts(docs, "doc_id").mapInArrow(count, "doc_id long, n long, terms array<int>, times array<long>")


def weights(index: DataFrame, vocabulary: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms with repeats, and the weight of each term of the vocabulary."""
    documents, total = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(vocabulary, np.int64)
    for row in index.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():  # at most one row a term of the block
        held[row["term"]] = row["count"]
    return documents, total, np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)


class Tree:
    """A ball tree over the rows of ``impacts`` (documents x terms of the block), each term scaled by the root of its weight.

    Rows are taken in the order of ``order``; a ball is a range of it. Balls have a centre,
    a radius and the terms they hold. All entries are 0 or more and every sum has at most
    as many as there are terms, so ``slack`` covers what rounding can take off a bound.
    """

    def __init__(self, impacts: np.ndarray, weight: np.ndarray, leaf: int = LEAF):
        self.root = np.sqrt(weight.astype(np.float64))
        self.order = np.arange(len(impacts))
        self.slack = 1 + (impacts.shape[1] + 64) * 2.0**-50
        self.ranges, self.children, centres, radii, held = [(0, len(impacts))], [], [], [], []
        for low, high in self.ranges:  # grows while it is read
            rows = self.order[low:high]
            scaled = impacts[rows] * self.root
            centre = scaled.mean(axis=0)
            scaled -= centre
            squares = np.einsum("ij,ij->i", scaled, scaled)
            centres.append(centre)
            held.append(centre > 0)
            radii.append(math.sqrt(float(squares.max())) * self.slack)
            if high - low <= leaf or radii[-1] == 0:
                self.children.append(None)
                continue
            one = scaled[int(squares.argmax())]
            other = scaled[int(np.argmax(squares - 2 * (scaled @ one)))]
            middle = (low + high) // 2
            self.order[low:high] = rows[np.argsort(scaled @ (other - one), kind="stable")]
            self.children.append((len(self.ranges), len(self.ranges) + 1))
            self.ranges += [(low, middle), (middle, high)]
        self.centres, self.radii, self.held = np.array(centres), np.array(radii), np.array(held)

    def bounds(self, terms: np.ndarray) -> np.ndarray:
        """What no document of each ball exceeds, for an item of these terms."""
        asked = self.root[terms]
        length = np.sqrt(self.held[:, terms] @ (asked * asked))
        return (self.centres[:, terms] @ asked + length * self.radii) * self.slack


class Best:
    """The ``size`` best (score, doc_id) of an item so far; among equal scores the smaller id is better, none is worst."""

    def __init__(self, size: int):
        self.size, self.heap = size, []

    def least(self) -> int:
        """A document below this score cannot enter."""
        return self.heap[0][0] if len(self.heap) == self.size else 1

    def add(self, score: int, doc_id: int | None) -> None:
        entry = (score, -math.inf if doc_id is None else -doc_id)
        if len(self.heap) < self.size:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)


def search(tree: Tree, impacts: np.ndarray, ids: list, weight: np.ndarray, items: list[np.ndarray], best: list[Best]) -> int:
    """Add the documents of one tree to the items' best ones; the number of leaves visited."""
    visited = 0
    ordered = impacts[tree.order]
    for terms, top in zip(items, best, strict=True):
        bounds = tree.bounds(terms)
        waiting = [(-bounds[0], 0)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            if -bound < top.least():
                break
            if tree.children[node]:
                for child in tree.children[node]:
                    heapq.heappush(waiting, (-bounds[child], child))
                continue
            visited += 1
            low, high = tree.ranges[node]
            scores = ordered[low:high].take(terms, axis=1).astype(np.int64) @ weight[terms]
            for k in np.flatnonzero(scores >= top.least()).tolist():
                top.add(int(scores[k]), ids[tree.order[low + k]])
    return visited


def _impacts(n: np.ndarray, offsets: np.ndarray, terms: np.ndarray, times: np.ndarray, vocabulary: int, documents: int, total: int) -> np.ndarray:
    """Dense impacts below 10^6 of some documents."""
    lengths = np.array([50 + 50 * x * documents // total for x in n.tolist()], np.int64)  # Python integers: no overflow
    out = np.zeros((len(n), vocabulary), np.int32)
    owner = np.repeat(np.arange(len(n)), np.diff(offsets))
    out[owner, terms] = (1_000_000_000 * times) // (1000 * times + 20 * lengths[owner])
    return out


def ranked_block(index: DataFrame, block: list[tuple], vocabulary: list[bytes], ranked: int = RANKED) -> DataFrame:
    """item (its place in the block), doc_id and score: of each task the best documents of every item."""
    documents, total, weight = weights(index, len(vocabulary))
    number = {w: k for k, w in enumerate(vocabulary)}
    items = [np.array([number[w] for w in words], np.int64) for _, words in block]
    sent = index.sparkSession.sparkContext.broadcast((weight, items))
    together = max(1, CELLS // max(len(vocabulary), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, items = sent.value
        best = [Best(ranked) for _ in items]
        for batch in pieces(batches, together):
            lists = batch.column("terms"), batch.column("times")
            offsets = lists[0].offsets.to_numpy()
            low, high = int(offsets[0]), int(offsets[-1])
            impacts = _impacts(batch.column("n").to_numpy(), offsets, lists[0].values.to_numpy()[low:high], lists[1].values.to_numpy()[low:high],
                               len(weight), documents, total)
            search(Tree(impacts, weight), impacts, batch.column("doc_id").to_pylist(), weight, items, best)
        for at in range(0, len(items), 256):
            rows = [(at + k, None if less == -math.inf else -less, score) for k, top in enumerate(best[at:at + 256]) for score, less in top.heap]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)], ["item", "doc_id", "score"])

    return index.mapInArrow(run, "item int, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, ranked: int = RANKED, terms: int = TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``ranked`` best documents of each item."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    found = []
    for block in blocks(items, terms):
        vocabulary = sorted({w for _, words in block for w in words})
        index = scratch(postings(docs, vocabulary), "postings")
        local = ranked_block(index, block, vocabulary, ranked)
        best = [F.desc("score"), F.asc_nulls_last("doc_id")]
        part = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(DEALT))).orderBy(*best)
        whole = Window.partitionBy("item").orderBy(*best)
        reduced = local.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= ranked)
        top = reduced.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= ranked)
        names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], f"item int, item_id {kind.simpleString()}")
        found.append(top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def oracle_sql() -> str:
    """DuckDB SQL of rank(documents, benchmark)."""
    words = lambda text: f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {words("text")} AS w FROM documents WHERE text IS NOT NULL),
held AS (SELECT d, doc_id, len(w)::BIGINT AS n, w FROM docs WHERE len(w) > 0),
sums AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM held),
asked AS (SELECT DISTINCT item_id, unnest({words("text")}) AS term FROM benchmark),
tf AS (SELECT d, term, count(*)::BIGINT AS tf FROM (SELECT d, unnest(w) AS term FROM held) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
df AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM tf, sums GROUP BY term),
impact AS (SELECT d, term, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll)) AS impact FROM tf JOIN held USING (d), sums),
scored AS (SELECT item_id, d, sum(weight * impact)::BIGINT AS score FROM asked JOIN df USING (term) JOIN impact USING (term) GROUP BY ALL HAVING sum(weight * impact) > 0),
ordered AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
  FROM scored JOIN held USING (d))
SELECT item_id, rank, doc_id, score FROM ordered WHERE rank <= {RANKED}"""
