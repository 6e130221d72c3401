"""Ranked search, conversation repair and language identification against brute force, SQL and odd tables."""

import hashlib
import itertools
import random

import duckdb
import numpy as np
import pytest
from ledgerloom.llm import ball_search, byte_cnn, conversations
from pyspark.sql import functions as F

DIR, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, item long, score long, rank int, terms string, draw string, place int"
ITEMS = "item_id long, text string, doc_id long, term string, score int"
TALKS = "conv_id long, turn long, role string, text string, copies int, digest string, kind int, part int, n int, blank string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def by_sql(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return sorted(con.sql(sql).fetchall(), key=repr)


# --- 11 ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def odd_docs(spark):
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(60)] + ["É", "tE", "Kelvin"]
    texts = [" ".join(rnd.choice(words[: rnd.randint(2, 63)]) for _ in range(rnd.randint(1, 80))) for _ in range(160)]
    texts += [None, "", " \n.,", "w1", "w1", "W1 w1", "w2 " * 60_000, texts[0], texts[0]]
    rows = [(None if k == 7 else k // 2 if k > 150 else k, t, "en", 1, 2, 3, "x", "y", 4) for k, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[3], rows[3]], DOCS).repartition(3)


@pytest.fixture(scope="module")
def odd_items(spark):
    texts = ["w1 w2 w3", "W1", "nothing here", "", None, " ".join(f"w{k}" for k in range(60)), "w1 w1 w1 é KELVIN", "w9 w8"]
    rows = [(k if k < 7 else 0, t, 1, "t", 2) for k, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "w5 w6", 1, "t", 2), rows[1]], ITEMS)


def test_search_equals_sql(spark, odd_docs, odd_items):
    docs, items = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    for d, i in ((docs, items), (odd_docs, odd_items), (odd_docs.limit(0), odd_items), (odd_docs, odd_items.limit(0))):
        assert rows_of(ball_search.rank(d, i)) == by_sql(ball_search.oracle_sql(), documents=d.select("doc_id", "text"), benchmark=i.select("item_id", "text"))


def test_search_in_blocks_is_the_same(odd_docs, odd_items):
    whole, cut = ball_search.rank(odd_docs, odd_items), ball_search.rank(odd_docs.repartition(7), odd_items, terms=3)
    assert len(list(ball_search.blocks(odd_items, 3))) > 3
    assert rows_of(whole) == rows_of(cut)


@pytest.mark.parametrize("leaf", [1, 4, 200])
def test_tree_bounds_and_pruned_search_are_exact(leaf):
    rng = np.random.default_rng(leaf)
    impacts = (rng.integers(1, 10**6, (300, 40)) * (rng.random((300, 40)) < 0.15)).astype(np.int32)
    impacts[50:90] = impacts[50]
    weight = rng.integers(0, 20_000, 40)
    tree = ball_search.Tree(impacts, weight, leaf)
    items = [rng.choice(40, rng.integers(1, 12), replace=False) for _ in range(20)]
    best = [ball_search.Best(10) for _ in items]
    visited = ball_search.search(tree, impacts, list(range(300)), weight, items, best)
    for terms, top in zip(items, best, strict=True):
        scores = impacts[:, terms].astype(np.int64) @ weight[terms]
        for (low, high), bound in zip(tree.ranges, tree.bounds(terms), strict=True):
            assert scores[tree.order[low:high]].max() <= bound
        wanted = sorted(((int(s), -k) for k, s in enumerate(scores) if s > 0), reverse=True)[:10]
        assert sorted(top.heap, reverse=True) == wanted
    assert leaf > 1 or visited < len(items) * sum(c is None for c in tree.children) / 2


# --- 12 ----------------------------------------------------------------------------

def plain_cheapest(kinds):
    """All states and edits, one row after the other; no tables."""
    best = {0: (0, "")}
    for kind in [*kinds, None]:
        for _ in range(2):
            for q, (cost, edits) in list(best.items()):
                to, new = conversations.INSERTED[q], (cost + 2, edits + "I")
                best[to] = min(best.get(to, new), new)
        if kind is None:
            break
        after = {}

        def offer(q, cost, edits, after=after):
            after[q] = min(after.get(q, (cost, edits)), (cost, edits))

        for q, (cost, edits) in best.items():
            offer(q, cost + 3, edits + "D")
            if kind < 8:
                offer(conversations.INSERTED[q], cost + 2 + (kind >= 4), edits + "R")
                if (q, kind % 4) in conversations.KEPT:
                    offer(conversations.KEPT[q, kind % 4], cost + (kind >= 4), edits + "K")
        best = after
    return min(best[q] for q in (0, 3) if q in best)


def test_block_tables_equal_the_plain_way():
    rnd = random.Random(5)
    every = [bytes(k) for n in range(4) for k in itertools.product(range(9), repeat=n)]
    drawn = [bytes(rnd.choices(range(9), k=rnd.randint(4, 40))) for _ in range(800)]
    for kinds in every + drawn:
        assert conversations.cheapest(kinds) == plain_cheapest(kinds)


def test_no_cheaper_or_lesser_edits_by_full_search():
    """Every string of edits up to length 6 over short conversations."""
    rnd = random.Random(6)
    for _ in range(40):
        kinds = bytes(rnd.choices(range(9), k=rnd.randint(0, 4)))
        found = []
        for n in range(7):
            for edits in itertools.product("DIKR", repeat=n):
                q, at, cost = 0, 0, 0
                for e in edits:
                    if e != "I":
                        if at == len(kinds) or (e != "D" and kinds[at] == 8):
                            break
                        kind, at = kinds[at], at + 1
                        cost += 3 if e == "D" else (kind >= 4) + 2 * (e == "R")
                        if e == "K" and (q, kind % 4) not in conversations.KEPT:
                            break
                        q = q if e == "D" else conversations.KEPT[q, kind % 4] if e == "K" else conversations.INSERTED[q]
                    else:
                        cost, q = cost + 2, conversations.INSERTED[q]
                else:
                    if at == len(kinds) and q in (0, 3):
                        found.append((cost, "".join(edits)))
        cost, edits = conversations.cheapest(kinds)
        assert len(edits) > 6 or (cost, edits) == min(found)


@pytest.fixture(scope="module")
def odd_talks(spark):
    rnd = random.Random(8)
    texts = [None, "", " \t", "Yes.", "No", "Why? \n", "é!", "same.", "a\nb", "long " * 20_000]
    roles = ["user", "assistant", "system", None, "", "tool", "ußer", "admin"]
    rows = [(rnd.choice([None, *range(40)]), rnd.choice([None, None, -3, *range(12)]), rnd.choice(roles), rnd.choice(texts), 9, "d", 1, 0, 5, "b")
            for _ in range(700)]
    return spark.createDataFrame([*rows, *rows[:60], *[(99, 5, "user", "copy.", 0, "", 0, 0, 0, "")] * 300], TALKS).repartition(5)


def test_repair_equals_sql(spark, odd_talks):
    for talks in (spark.read.parquet(f"{MIDDLE}/conversations.parquet"), odd_talks, odd_talks.limit(0)):
        want = by_sql(conversations.oracle_sql(), conversations=talks.select("conv_id", "turn", "role", "text"))
        assert rows_of(conversations.audit(conversations.damage(talks))) == want


def test_dropped_conversations_stay(spark):
    talks = spark.range(2000).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("Hi.").alias("text"))
    got = conversations.audit(conversations.damage(talks))
    empty = got.where("audit = ''")
    assert got.count() == 2000 and 50 < empty.count() < 200
    assert {tuple(r)[1:] for r in empty.collect()} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_repaired_rows_have_the_audited_digest(odd_talks):
    damaged = conversations.damage(odd_talks)
    rows = {}
    for r in sorted(conversations.repair(damaged).collect(), key=lambda r: r["position"]):
        rows.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in conversations.audit(damaged).collect():
        text = "\n".join(rows.get(r["conv_id"], []))
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]


def test_repair_of_plain_rows(spark):
    rows = [("a", 0, "system", "S."), ("a", 1, "assistant", "cut"), ("b", 0, "user", "Hi."), ("b", 1, "user", "Hi.")]
    got = conversations.audit(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"))
    # a: a user is put between (2, and 1 for the cut end). b: the copy goes (3), an answer comes (2).
    assert [tuple(r)[:-1] for r in got.orderBy("conv_id").collect()] == [("a", 0, 0, 0, 1, 1, 3, "KIK"), ("b", 0, 0, 1, 0, 1, 5, "KDI")]


# --- 13 ----------------------------------------------------------------------------

def test_pair_tables_equal_the_convolution():
    network = byte_cnn.Network(["x", "y", "z"])
    x = np.random.default_rng(1).integers(0, 256, (300, byte_cnn.WINDOW)).astype(np.uint8)
    pooled = []
    for tables in network.filters:
        out = [[sum(tables[j][row[p + j]].astype(np.float64) for j in range(len(tables))) for p in range(byte_cnn.REACH)] for row in x[:20]]
        pooled.append(np.array(out).max(axis=1))
    scores = np.maximum(np.concatenate(pooled, axis=1) + network.bias, 0) @ network.dense + network.offset
    want = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
    assert np.allclose(network.scorer()(x)[:20], want, atol=1e-4)


def test_gradients_equal_differences():
    network = byte_cnn.Network(["x", "y"])
    x = np.random.default_rng(2).integers(97, 123, (4, byte_cnn.WINDOW)).astype(np.uint8)
    targets = np.array([0, 1, 1, 0])
    values = [*network.filters, network.bias, network.dense, network.offset]
    for v, g in zip(values, network._gradients(x, targets), strict=True):
        spot = np.unravel_index(np.abs(g).argmax(), g.shape)
        loss = []
        for move in (1e-2, -1e-2):
            v[spot] += move
            loss.append(-network.scorer()(x)[np.arange(4), targets].mean())
            v[spot] -= move
        assert abs((loss[0] - loss[1]) / 2e-2 - g[spot]) < 0.05 * abs(g[spot]) + 1e-3


def test_windows_cover_every_place_once():
    for n in (0, 1, 253, 254, 255, 256, 257, 505, 506, 507, 508, 509, 5000):
        text = "".join(chr(97 + k % 26) for k in range(n))
        cut = byte_cnn.windows(text)
        plain = " " + text + " "
        joined = b"".join(row[:byte_cnn.REACH].tobytes() for row in cut) + cut[-1][byte_cnn.REACH:].tobytes()
        assert joined.decode().rstrip() == plain.rstrip() and len(joined) >= len(plain)
        assert len(cut) == 1 or cut[-1].tobytes().strip()


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    network = byte_cnn.train(docs)
    got = byte_cnn.predict(docs, network).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("lang = lang_pred").count() >= 0.98 * got.count()
    # The end of a text counts like its beginning: German after a page of English.
    english, german = (docs.where(f"lang = '{x}' and length(text) > 2000").orderBy("doc_id").first()["text"] for x in ("en", "de"))
    mixed = spark.createDataFrame([(1, english[:600] + "\n" + german[:2000] * 3)], "doc_id long, text string")
    assert byte_cnn.predict(mixed, network).first()["lang_pred"] == "de"


def test_language_of_odd_rows(spark, odd_docs):
    rows = [(1, None, "a"), (2, "", "a"), (3, "123 .!?", "b"), (4, "Straße " * 50_000, "b"), (5, "abc", None), (None, "abc abc", "b"), (7, "xyz " * 9, "c"), (7, "xyz " * 9, "c")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = byte_cnn.train(odd)
    got = byte_cnn.predict(odd, network).collect()
    assert len(got) == len(rows) and {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in got) and {r["lang_pred"] for r in got} <= {"a", "b", "c", "und"}
    assert byte_cnn.predict(odd.limit(0), network).count() == 0
    nothing = byte_cnn.train(odd.limit(0))
    assert {(r["lang_pred"], r["score"]) for r in byte_cnn.predict(odd, nothing).collect()} == {("und", 0.0)}
    assert byte_cnn.predict(odd_docs, byte_cnn.train(odd_docs)).count() == odd_docs.count()


def test_language_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    network = byte_cnn.train(docs)
    assert rows_of(byte_cnn.predict(docs.coalesce(1), network)) == rows_of(byte_cnn.predict(docs.repartition(7), network))


def test_session_settings_stay(spark, odd_docs):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    byte_cnn.predict(odd_docs, byte_cnn.Network(["x"])).count()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
