"""The restaurants of the words before: order counts, every word has them, and their tables fit together."""

import collections
import glob
import os
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from ledgerloom.llm import pitman_yor
from ledgerloom.llm.common import scratch
from pyspark.sql import functions as F

HELD = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)


def text(k, rng):
    """Sentences in which a word is followed by few others, and some words that come once or twice in all."""
    words = [f"w{rng.integers(6)}"]
    for _ in range(30):
        words.append(f"w{(int(words[-1][1:]) * 3 + rng.integers(2)) % 17}")
    return " ".join([*words, f"only{k}", f"twice{k // 2}", f"TWICE{k // 2 + 1}", f"after{k // 2}"])


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = [(k, text(k, rng)) for k in range(60) if k != HELD]
    ordered = text(900, rng).split()
    return [*out, (HELD, " ".join(ordered)), (HELD, " ".join(sorted(ordered))), (HELD, None), (None, "w1 w3"), (None, "w1 w3")]


def test_order_counts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for frequent in (10 ** 6, 5):
        held = sorted((r["n_tokens"], r["base_score"], r["score"]) for r in pitman_yor.score(docs, frequent).where(F.col("doc_id") == HELD).collect())
        assert len(held) == 3 and held[1][0] == held[2][0] == 36
        (_, base, one), (_, other, two) = held[1:]
        assert base == pytest.approx(other)
        assert abs(one - two) > 5


def test_scores_do_not_depend_on_the_words_every_task_knows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [sorted(((r["doc_id"], r["n_tokens"], round(r["score"], 7)) for r in pitman_yor.score(docs, k).collect()), key=repr) for k in (0, 7, 10 ** 6)]
    assert found[0] == found[1] == found[2]


def contexts_of(spark, rows, frequent):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", F.coalesce(F.col("doc_id") == HELD, F.lit(False)))
    vocabulary = scratch(pitman_yor.word_counts(docs), "vocabulary")
    top = [r["word"] for r in vocabulary.where("count > 0").orderBy(F.desc("count"), "word").limit(frequent).collect()]
    known = spark.sparkContext.broadcast({bytes(w): k for k, w in enumerate(top)})
    tokens = vocabulary.agg(F.sum("count")).first()[0]
    return pitman_yor.Contexts(scratch(pitman_yor.coded(docs, known), "coded"), vocabulary, known, tokens)


@pytest.mark.parametrize("frequent", [4, 10 ** 6])
def test_tables_of_contexts_fit_together(spark, rows, frequent):
    pairs = collections.Counter()
    for doc_id, t in rows:
        words = [b"", *(t or "").lower().encode().split(), b""]
        if doc_id != HELD:
            pairs.update(zip(words, words[1:], strict=False))
    contexts = contexts_of(spark, rows, frequent)
    follow, precede = collections.Counter(u for u, _ in pairs), collections.Counter(w for _, w in pairs)
    words = contexts.words.collect()
    assert {bytes(r["word"]): (r["followers"], r["contexts"]) for r in words} == {bytes(r["word"]): (follow[r["word"]], precede[r["word"]]) for r in words}
    samples = pitman_yor.gibbs(contexts.customers(0), sum(precede.values()), 1, 0, contexts=contexts)
    left = contexts.state(contexts.words, spark.sparkContext.broadcast(samples))
    state = {bytes(w["word"]): r for r in left.collect() for w in words if w["id"] == r["id"]}
    less, strength = contexts.less, pitman_yor.STRENGTH
    names = list(state)
    hashed = np.array([pitman_yor.word_hash(w) for w in names])
    states = pitman_yor.States(left.limit(0).toArrow(), hashed[:0], len(samples))
    for k in (1, 2):
        tables = collections.Counter()
        for (u, w), n in pairs.items():
            key = states.keys(np.array([pitman_yor.word_hash(u)]), np.array([pitman_yor.word_hash(w)]))
            before = state[u]["tables"][k - 1], state[w]["probability"][k - 1]
            drawn = pitman_yor.seats(np.array([n]), np.array([before[1]]), strength, less, np.array([before[0]]), key, samples[0].seed - 1 + k)[0]
            assert 1 <= drawn <= n
            tables[u] += drawn
        assert tables == {u: state[u]["tables"][k] for u in follow}
    assert sum(follow.values()) < sum(tables.values()) < sum(pairs.values())


def test_cells_hold_every_pair_of_words():
    for frequent, tokens in ((1, 0), (300_000, 0), (299_999, 10 ** 9), (65_536, 7)):
        cells = pitman_yor.Cells(frequent, tokens)
        pair = frequent * frequent - 1
        assert pair // cells.cells < 1 << 31
        assert [x.item() for x in cells.words(pair % cells.cells, np.array([pair // cells.cells]))] == [frequent - 1, frequent - 1]


def shuffled():
    return set(glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*.data"))


def test_shuffles_of_stored_rows_are_gone(spark):
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.format("noop").mode("overwrite").save()
    settings, before = [spark.conf.get(k) for k in pitman_yor.WRITING], shuffled()
    kept = pitman_yor.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "kept")
    assert kept.count() == 7 and sum(r["count"] for r in kept.collect()) == 1000
    assert not [f for f in shuffled() - before if os.path.getsize(f) > 200]
    assert settings == [spark.conf.get(k) for k in pitman_yor.WRITING]


def test_words_are_those_between_white_space():
    texts = [b"", b" A\tb\x0b\x0cC \r\n", "Ä b X".encode(), b"\x1c\x1dx\x85", b"one"]
    for kind in (pa.binary(), pa.large_binary()):
        owner, words = pitman_yor.words_of(pa.array([b"cut", *texts], kind)[1:])
        want = [(k, w) for k, t in enumerate(texts) for w in bytes(b + 32 if 65 <= b <= 90 else b for b in t).split()]
        assert list(zip(owner.tolist(), words.to_pylist(), strict=True)) == want


def test_frequent_words_are_taken_without_a_sort(spark):
    words = [(f"w{k}".encode(), 9 + k) for k in range(10)] + [(f"t{k}".encode(), 2) for k in range(2000)] + [(f"held{k}".encode(), 0) for k in range(50)]
    found = []
    for parts in (1, 5):
        top, n, v = pitman_yor.most_frequent(spark.createDataFrame(words, "word binary, count long").repartition(parts), 500)
        assert (n, v) == (sum(c for _, c in words), 2010)
        assert top.column("count").to_pylist()[:11] == [*range(18, 8, -1), 2] and 420 < top.num_rows < 580
        found.append(top.column("word").to_pylist())
    assert found[0] == found[1]
    for asked, got in ((0, 0), (10, 10), (2010, 2010), (10 ** 6, 2010)):
        assert pitman_yor.most_frequent(spark.createDataFrame(words, "word binary, count long"), asked)[0].num_rows == got


def test_rare_pairs_move_packed(spark, rows):
    """A row for each part and some documents, not for each pair, and every pair is there as often as in the texts."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", F.lit(False)).coalesce(1)
    names = [b"", b"w1", b"w3", b"w7"]
    known = spark.sparkContext.broadcast({w: k for k, w in enumerate(names)})
    coded, numbers, want = scratch(pitman_yor.coded(docs, known), "coded"), pitman_yor.Numbers(known.value), collections.Counter()
    for _, t in rows:
        ids = numbers.of(pa.array([b"", *(t or "").lower().encode().split(), b""], pa.binary())).tolist()
        want.update(p for p in zip(ids, ids[1:], strict=False) if max(p) >= len(names))
    for kinds in ((None,), (False, True)):
        found, parts = collections.Counter(), 5
        for both in kinds:
            table = pitman_yor.rare_pairs(coded, len(names), parts, both).toArrow()
            assert 0 < table.num_rows <= parts
            found.update(zip(*(pitman_yor.unpacked(table.column(c), np.int64).tolist() for c in ("before", "word")), strict=True))
        assert found == want


def test_no_broadcast_stays_in_the_driver(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = set(os.listdir(spark.sparkContext._temp_dir))
    assert pitman_yor.score(docs, 7).count() == len(rows)
    assert not set(os.listdir(spark.sparkContext._temp_dir)) - before
