"""Reproducible seating, stages over any column names, and long or deep inputs in linear time."""

import math
import random
import time

import numpy as np
import pytest
from ledgerloom.llm import contamination, html_text, neardup, pitman_yor, rules, samples, secret_scan, toxicity

DIR = "/root/testdata/sf0.001"


def scores(df):
    return sorted(((r["doc_id"], round(r["score"], 7)) for r in df.collect()), key=repr)


def test_scores_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        found = []
        for parts, shuffle in ((1, "4"), (7, "3")):
            spark.conf.set("spark.sql.shuffle.partitions", shuffle)
            found.append(scores(pitman_yor.score(docs.repartition(parts), 500)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_drawn_numbers_are_binomial():
    keys = np.random.default_rng(5).integers(0, 1 << 62, 40_000)
    for trials, chance in ((1, 0.3), (9, 0.02), (40, 0.7), (3000, 0.2)):
        got = pitman_yor.successes(keys, 7, np.full(len(keys), trials), np.full(len(keys), chance))
        assert got.min() >= 0 and got.max() <= trials
        assert got.mean() == pytest.approx(trials * chance, abs=4 * np.sqrt(trials * chance * (1 - chance) / len(keys)) + 1e-3)
        assert got.var() == pytest.approx(trials * chance * (1 - chance), rel=0.05)
    assert np.array_equal(pitman_yor.uniforms(keys, 3)[5:9], pitman_yor.uniforms(keys[5:9], 3))


def test_scored_tables_are_those_of_the_sweep(spark):
    """With one word restaurant, the shares of all its dishes and of a new table sum to one."""
    words = [(f"w{k}".encode(), 1 + k * k) for k in range(40)]
    vocabulary = spark.createDataFrame(words, "word binary, count long").repartition(3)
    tokens = sum(c for _, c in words)
    for sample in pitman_yor.gibbs(vocabulary, tokens, 1, 0):
        names, counts = [w for w, _ in words], np.array([c for _, c in words])
        spelled = np.exp(sample.spelling.logs(names))
        old = sample.predict(names, counts).sum() - (pitman_yor.STRENGTH + sample.less * sample.tables) * spelled.sum() / (pitman_yor.STRENGTH + tokens)
        assert old + (pitman_yor.STRENGTH + sample.less * sample.tables) / (pitman_yor.STRENGTH + tokens) == pytest.approx(1)


ODD = "doc_id long, text string, lang string, source string, n_chars long, `_row` long, `a.b` string, `c``d e` int, `_Row_` string, band int, hub long, id int, component_id long"


def test_stages_keep_columns_of_any_name(spark):
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(30)) + f" password: abcdefgh{k}zz"
    rows = [(k, text(k // 2), "en", "s", 9, 100 + k, f"dot{k}", k, "r", k, k, k, k) for k in range(8)]
    docs = spark.createDataFrame(rows, ODD).repartition(3)
    same = lambda df, ids: sorted(tuple(r)[2:4] + tuple(r)[5:] for r in df.collect()) == sorted(r[2:4] + r[5:] for r in rows if r[0] in ids)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, text(0))], "item_id long, text string")
    for out, ids in ((rules.keep(docs, labels), range(8)), (neardup.keep_one(docs, 5, 80), (0, 2, 4, 6)), (contamination.decontaminate(docs, bench), range(2, 8)),
                     (secret_scan.redact(docs), range(8))):
        assert out.columns == docs.columns and same(out, ids)


@pytest.mark.parametrize("text", ["0123456789abcdef" * 62_500, "eyJ" * 330_000, "abcdefghij" * 100_000 + " https://u:p@h.org", "a://" * 250_000, "password " * 110_000])
def test_a_megabyte_is_scanned_in_a_moment(text):
    start = time.process_time()
    secret_scan.scanner()([text, text[:100]])
    assert time.process_time() - start < 2


def test_url_passwords_are_found_wherever_they_stand():
    scan = secret_scan.scanner()
    for text in ("https://me:word@host.org/x", "(ftp://me:word@host)", "x=postgres+ssl://me:word@host.org:5/db", "aHTTPS git+ssh://me:word@h"):
        (spans,) = scan([text])
        assert [text[a:b] for k, a, b in spans if k == "url_password"][0].split("://")[1].startswith("me:word@h")


def test_deep_and_unmatched_tags_take_linear_time():
    def seconds(n):
        start = time.process_time()
        html_text.Page("<p>a<div>" * n + "x" + "</span></b></section>" * n + "</div>" * n)
        html_text.Page("<div>" * n + "<li>y" + "</p></li></td>" * n)
        return time.process_time() - start

    seconds(500)
    assert seconds(20_000) < 12 * max(seconds(4_000), 0.05)


def plain(source):
    return [t for t in html_text.Page(source).text if t is not None]


def test_controls_and_nested_raw_elements_are_no_text():
    assert plain("<p>a <svg><svg></svg><text>leak</text></svg>b <template><template>x</template>y</template>c</p>") == ["a b c"]
    assert plain("<p>Send <button>Buy now</button>it <label for=x>Name</label>today</p>") == ["Send it today"]
    assert plain("<p>left <label>open for ever</p><p>rest</p>") == ["left open for ever", "rest"]
    assert plain("<p>a<svg/>b <svg><path/><svg/></svg>c</p><script>if (a</script>") == ["ab c"]


def test_scanners_are_known_by_their_items(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "doc_id long, text string")
    for item, hit in ((("one two three four five six seven eight nine ten"), True), ("ten nine eight seven six five four three two one", False)):
        bench = spark.createDataFrame([(1, item)], "item_id long, text string")
        assert contamination.digest(contamination.find(docs, bench)).first()["contaminated"] is hit


def test_labels_of_pairs_alone_are_learnt():
    """Toxic if both or neither of two words is there; neither word says anything by itself."""
    rng = random.Random(4)
    examples = []
    for _ in range(4000):
        one, two = rng.random() < 0.5, rng.random() < 0.5
        words = {f"noise{rng.randrange(3000)}" for _ in range(20)} | ({"alpha"} if one else set()) | ({"beta"} if two else set())
        examples.append((int(one == two), toxicity.terms(" ".join(words).encode())))
    machine = toxicity.Machine(examples)
    low, high = machine.score([b"alpha noise1", b"beta noise2", b"alpha beta noise1", b"noise2 noise9"])[:2], machine.score([b"alpha beta noise1", b"noise2 noise9"])
    assert max(low) < 0.3 < 0.7 < min(high)


def brute_raw(machine, text):
    """All pairs of the text's terms, one after the other."""
    slots = [int(machine.slot[t]) for t in toxicity.terms(text) if machine.slot[t]]
    pairs = sum(float(machine.factor[a] @ machine.factor[b]) for i, a in enumerate(slots) for b in slots[:i])
    return machine.bias + sum(float(machine.weight[s]) for s in slots) + pairs


def test_scores_equal_all_pairs_and_do_not_depend_on_partitions(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    machine = toxicity.train(docs, labels)
    texts = [(r["text"] or "").encode() for r in docs.limit(50).collect()]
    for text, score in zip(texts, machine.score(texts), strict=True):
        assert score == pytest.approx(1 / (1 + math.exp(-brute_raw(machine, text))), rel=1e-6, abs=1e-12)
    again = toxicity.train(docs.repartition(5), labels.repartition(2))
    assert np.array_equal(machine.slot, again.slot) and np.allclose(machine.weight, again.weight)


def test_many_texts_of_one_id_are_one_example(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(300)] + [(2, "b"), (None, "c")], "doc_id long, text string")
    ids = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, grade int")
    assert samples.examples(docs, ids, toxicity.terms, "array<int>").count() == 2
