"""Each stage of the corpus pipeline against brute force on its own input, and the whole of it."""

import re

import corpus_pipeline
from ledgerloom.llm import contamination, neardup, rules, secret_scan
from test_operators import brute_components, brute_counts, brute_hits, brute_spans

DIR = "/root/testdata/sf0.001"


def brute_kept(text, lang, chosen):
    """The base rule, and no statistic above the cutoff of the language, or of the pooled ones where it has none of its own."""
    n, chars, symbols, dup, repeated = brute_counts(text)
    if n < 10 or 100 * repeated > 20 * n:
        return False
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    values = {"symbols_per_word": symbols / n, "bangs_per_word": text.count("!") / n, "upper_share": len(re.findall("[A-Z]", text)) / chars,
              "duplicate_lines_per_line": dup / len(lines), "repeated_words_per_word": repeated / n}
    stratum = (lang or "") if any(c["stratum"] == (lang or "") for c in chosen) else None
    cutoffs = {c["statistic"]: c["cutoff"] for c in chosen if c["stratum"] == stratum}
    assert set(cutoffs) <= set(values)
    return all(cutoffs.get(k) is None or v <= cutoffs[k] for k, v in values.items())


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = corpus_pipeline.scratch(stage(spark, docs, DIR), "test")
        after = {r["doc_id"]: r for r in out.collect()}
        texts = {i: r["text"] or "" for i, r in before.items()}
        if name == "quality_rules":
            chosen = rules.cutoffs(rules.scratch(rules.counts(docs), "counts"), spark.read.parquet(f"{DIR}/labels.parquet")).collect()
            assert set(after) == {i for i, r in before.items() if brute_kept(r["text"] or "", r["lang"], chosen)} < set(before)
        elif name == "near_dedup":
            assert set(after) == {i for i, _, _, keep in brute_components(list(texts.items()), 5, 80) if keep} < set(before)
        elif name == "decontamination":
            assert set(after) == {i for i, t in texts.items() if not brute_hits(t, items, contamination.WINDOW)[1]} < set(before)
        elif name == "secret_masking":
            assert {i: r["text"] for i, r in after.items()} == {i: secret_scan.masked(t, brute_spans(t)) for i, t in texts.items()}
        else:
            assert set(after) == set(before) and all(r["n_tokens"] == len(r["token_ids"]) for r in after.values())
            break
        assert out.columns == columns
        docs = out
    assert neardup.SHINGLE == corpus_pipeline.SHINGLE


def test_stages_decide_row_by_row(spark, tmp_path):
    """Repeated and null ids: each row stays or goes by its own text."""
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    good, other, copy = text(1), text(2), text(3)
    rows = [(1, good), (1, good), (1, "too short"), (None, "too short"), (None, copy), (None, copy), (5, copy), (4, copy + " end"), (6, other), (6, good + " " + text(4)),
            (None, None), (7, text(5)), (7, text(6))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    of = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    ruled = rules.keep(docs, labels)
    assert ruled.columns == docs.columns and ruled.schema.simpleString() == docs.schema.simpleString()
    assert of(ruled) == sorted(((i, t) for i, t in rows if t and t != "too short"), key=repr)
    assert of(neardup.keep_one(docs, 5, 80)) == sorted([(1, good), (1, "too short"), (4, copy + " end"), (6, other), (6, good + " " + text(4)), (None, None),
                                                        (7, text(5)), (7, text(6))], key=repr)
    bench = spark.createDataFrame([(None, text(5)), (1, other), (None, copy), (2, None)], "item_id long, text string")
    for block in (1 << 20, 40):
        clean = contamination.decontaminate(docs, bench, block_bytes=block)
        assert clean.columns == docs.columns
        assert of(clean) == sorted(((i, t) for i, t in rows if t not in (text(5), other, copy, copy + " end")), key=repr)
        found = contamination.digest(contamination.find(docs, bench, block_bytes=block)).where("contaminated").collect()
        assert sorted(((r["doc_id"], r["n_items"]) for r in found), key=repr) == sorted([(7, 0), (6, 1), (None, 0), (None, 0), (5, 0), (4, 0)], key=repr)


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{DIR}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
