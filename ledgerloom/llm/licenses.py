"""License scans by a positional index of rare words (operator 1), in DataFrame functions only.

Each template is a passage with mandatory key phrases. The index holds, for each template,
the postings (word -> template, position) of the rarest words of its key phrases: those
with the highest IDF over all documents, rarest first; equal ones by word, then position.
A file is looked up by its own words. Where one of its words is a template's rarest, at
word p for a posting at position q, the template is proposed at p - q. If there are any
proposals, the file's next words by IDF are looked up likewise, and the postings are
intersected by template and relative position. What is left is verified word by word
against all key phrases. As a template stands only where all words of its key phrases do,
the intersection holds every place.

score is the largest share of a template's words found at their positions (0 without a
match). Base phrases are templates that consist of their key phrase.

Scale: one scan counts in how many documents the few dozen licence words occur (a partial
aggregate of one row per word and task), one scan finds the places, row by row inside
array functions. Nothing else is shuffled; the index is a literal.

Defined cases: null or empty text has no words, no places, empty labels and score 0;
repeated rows are scanned each; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NO_WORD

# Base labels and phrases (fixed values).
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
# label: passage, key phrases. Wording of public licences (fixed values).
NOTICES = {
    "agpl": ("gnu affero general public license", ("affero general public license",)),
    "apache-2.0": ("licensed under the apache license version 2 0", ("apache license version 2 0",)),
    "boost-1.0": ("distributed under the boost software license version 1 0", ("boost software license",)),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted",
            ("source and binary forms", "with or without modification")),
    "cc-by-nc": ("licensed under cc by nc 4 0", ("cc by nc",)),
    "cc-by-nd": ("licensed under cc by nd 4 0", ("cc by nd",)),
    "cc-by-sa": ("licensed under cc by sa 4 0", ("cc by sa",)),
    "cc0": ("cc0 1 0 universal", ("cc0 1 0",)),
    "epl": ("eclipse public license v 2 0", ("eclipse public license",)),
    "gpl-2": ("licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    "gpl-3": ("licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
            ("use copy modify and or distribute", "with or without fee")),
    "lgpl": ("gnu lesser general public license", ("lesser general public license",)),
    "mit": ("released under the mit license", ("mit license",)),
    "mit-notice": ("permission is hereby granted free of charge to any person obtaining a copy of this software",
                   ("hereby granted free of charge", "person obtaining a copy")),
    "mpl-2.0": ("mozilla public license v 2 0", ("mozilla public license",)),
    "unlicense": ("this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
}
# Postings of a template that are intersected.
DEPTH = 2
# Starts are stored from here, as a passage may begin before the text does.
SHIFT = 1024
STEP = 1 << 40


@dataclass(frozen=True)
class Template:
    """A passage and the positions of its key phrases."""

    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[int, tuple[str, ...]], ...]
    base: bool = False


def template(label: str, passage: str, phrases: tuple[str, ...], base: bool = False) -> Template:
    words = tuple(passage.split())
    keys = []
    for phrase in phrases:
        parts = tuple(phrase.split())
        keys.append((next(i for i in range(len(words)) if words[i:i + len(parts)] == parts), parts))
    return Template(label, words, tuple(keys), base)


TEMPLATES = [template(label, phrase, (phrase,), True) for label, phrase in BASE.items()] + [template(k, *v) for k, v in NOTICES.items()]


def words_of(text: Column) -> Column:
    """Array of the words of a text, A-Z lowered.

    lower() knows one letter beyond A-Z that becomes an ASCII one, the Kelvin sign; it is
    replaced by another non-ASCII letter, which no template has either.
    """
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ"))
    return F.array_remove(F.split(F.lower(plain), NO_WORD), "")


def rarity(docs: DataFrame, templates: list[Template] = TEMPLATES) -> dict[str, float]:
    """IDF over all documents of each word of the key phrases; as many rows as such words reach the driver."""
    vocabulary = sorted({w for t in templates for _, phrase in t.keys for w in phrase})
    present = F.array_intersect(words_of(F.col("text")), F.array(*map(F.lit, vocabulary)))
    rows = docs.select(F.explode(F.array_append(present, F.lit(""))).alias("word")).groupBy("word").count().collect()
    count = {r["word"]: r["count"] for r in rows}
    return {w: log((1 + count.get("", 0)) / (1 + count.get(w, 0))) for w in vocabulary}


def index(templates: list[Template], idf: dict[str, float], depth: int = DEPTH) -> list[dict[str, list[tuple[int, int]]]]:
    """Postings word -> (template, position), first of each template's rarest key word, then of the next ones."""
    out: list[dict[str, list[tuple[int, int]]]] = [{} for _ in range(depth)]
    for number, t in enumerate(templates):
        rarest = sorted(((w, at + k) for at, phrase in t.keys for k, w in enumerate(phrase)), key=lambda x: (-idf[x[0]], *x))
        for level, postings in enumerate(out):
            word, at = rarest[min(level, len(rarest) - 1)]
            postings.setdefault(word, []).append((number, at))
    return out


def find(docs: DataFrame, templates: list[Template] = TEMPLATES, idf: dict[str, float] | None = None) -> DataFrame:
    """doc_id, n_words and places (template, start) with all key phrases, of every row."""
    first, *others = index(templates, rarity(docs, templates) if idf is None else idf)
    rows = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "words", _hits(first).alias("hits"))
    nowhere = F.array().cast("array<bigint>")
    met = F.when(F.size("hits") > 0, reduce(F.array_intersect, [_proposed(F.col("hits"), first), *(_proposed(_hits(p), p) for p in others)])).otherwise(nowhere)
    rows = rows.select("doc_id", "words", met.alias("met"))
    verified = F.filter("met", lambda c: reduce(lambda a, b: a | b, [(_number(c) == number) & _stands(t, _start(c)) for number, t in enumerate(templates)]))
    places = F.when(F.size("met") > 0, verified).otherwise(nowhere)
    return rows.select("doc_id", "words", F.size("words").cast("long").alias("n_words"), places.alias("places"))


def _hits(postings: dict[str, list[tuple[int, int]]]) -> Column:
    """Where the file has words with postings."""
    return F.filter(F.transform("words", lambda w, i: F.when(w.isin(*postings), i)), lambda i: i.isNotNull())


def _proposed(hits: Column, postings: dict[str, list[tuple[int, int]]]) -> Column:
    """Templates and starts, as one number each, that the postings of the words there name."""
    lookup = F.create_map(*(x for word, entries in postings.items() for x in (
        F.lit(word), F.array(*(F.lit(number * STEP + SHIFT - at).cast("long") for number, at in entries)))))
    return F.flatten(F.transform(hits, lambda i: F.transform(F.element_at(lookup, _word(i)), lambda base: base + i)))


def _word(at: Column) -> Column:
    return F.get("words", at)


def _number(place: Column) -> Column:
    return F.shiftright(place, 40)


def _start(place: Column) -> Column:
    return (place.bitwiseAND(F.lit(STEP - 1)) - SHIFT).cast("int")


def _stands(t: Template, start: Column) -> Column:
    """Every word of the key phrases is there."""
    checks = [(at + k, w) for at, phrase in t.keys for k, w in enumerate(phrase)]
    return reduce(lambda a, b: a & b, [F.coalesce(_word(start + at) == F.lit(w), F.lit(False)) for at, w in checks])


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """Counts, base places, labels and score of every row."""
    found = find(docs, templates)
    label = lambda base: F.array_join(F.array_sort(F.array_distinct(F.transform(
        F.filter("places", lambda c: _number(c) < len(BASE)) if base else F.col("places"),
        lambda c: F.element_at(F.array(*(F.lit(t.label) for t in templates)), (_number(c) + 1).cast("int"))))), ",")
    starts = F.transform(F.filter("places", lambda c: _number(c) < len(BASE)), _start)

    def share(c: Column) -> Column:
        each = F.lit(0.0)
        for number, t in enumerate(templates):
            here = reduce(lambda a, b: a + b, [F.coalesce((_word(_start(c) + k) == F.lit(w)).cast("int"), F.lit(0)) for k, w in enumerate(t.words)])
            each = F.when(_number(c) == number, here / F.lit(float(len(t.words)))).otherwise(each)
        return each

    score = F.when(F.size("places") > 0, F.array_max(F.transform("places", share))).otherwise(F.lit(0.0))
    return found.select("doc_id", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
                        F.array_max(starts).cast("long").alias("last_word"), label(True).alias("base_labels"), label(False).alias("labels"),
                        F.round(score, 6).alias("score"))


def oracle_sql(templates: list[Template] = TEMPLATES) -> str:
    """DuckDB SQL of scan() over documents."""
    stands = lambda t: " AND ".join(f"w[i+{at + k}] = '{x}'" for at, phrase in t.keys for k, x in enumerate(phrase))
    # i is the place of the passage's first word, from 1; it may lie before the text.
    places = " || ".join(f"[{{'n': {n}, 's': i}} FOR i IN range({1 - t.keys[0][0]}, len(w) + 1) IF {stands(t)}]" for n, t in enumerate(templates))
    lookup = "[" + ", ".join(f"'{t.label}'" for t in templates) + "]"
    share = "CASE x.n " + " ".join(f"WHEN {n} THEN (" + " + ".join(f"CASE WHEN w[x.s+{k}] = '{v}' AND x.s+{k} > 0 THEN 1 ELSE 0 END" for k, v in enumerate(t.words))
                                   + f") / {float(len(t.words))}" for n, t in enumerate(templates)) + " END"
    return f"""
WITH texts AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
found AS (SELECT doc_id, w, {places} AS p FROM texts),
base AS (SELECT *, [x.s - 1 FOR x IN p IF x.n < {len(BASE)}] AS b FROM found)
SELECT doc_id, len(w)::BIGINT AS n_words, len(b)::BIGINT AS n_base, list_min(b)::BIGINT AS first_word, list_max(b)::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(list_distinct([{lookup}[x.n + 1] FOR x IN p IF x.n < {len(BASE)}])), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct([{lookup}[x.n + 1] FOR x IN p])), ','), '') AS labels,
  round(coalesce(list_max([{share} FOR x IN p]), 0.0), 6)::DOUBLE AS score FROM base"""
