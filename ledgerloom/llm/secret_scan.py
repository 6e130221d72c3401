"""Secret scans by a trigram index (operator 10).

From the parse of each rule's regex a Boolean query over mandatory trigrams is derived:
a literal run asks for all its trigrams, a sequence for all of its parts, alternatives
for one of them, what may be absent for nothing. Each batch of documents gets an
inverted index of the trigrams that any query names; queries intersect and unite its
postings, and the regex runs on the candidates only. A rule without mandatory trigrams
runs on every text.

The index is built per batch inside the map: postings never leave a task, no shuffle.

Defined cases: null text is empty and has no spans; repeated rows are scanned each;
other columns are ignored. Spans count code points, end exclusive. The span
of a private key is its whole block; of one without an END line, what looks like its body.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, pieces, rows_mapped, shipped, texts

# A private key: its BEGIN line and all up to the END line; without that, header lines and lines of base64 (line ends may be written \\n) that follow.
_KEY = r"[A-Z0-9 ]{0,20}PRIVATE KEY(?: BLOCK)?-----"
_GAP = r"(?:\s|\\[nrt])*+"
_HEADERS = rf"(?:{_GAP}(?:Proc-Type|DEK-Info|Key-Info|Content-Domain|Version|Comment|Hash|Charset|MessageID):[^\r\n\\]*+)*+"
_RUN = rf"{_GAP}[A-Za-z0-9+/]{{16,}}+={{0,2}}+"
_LAST = rf"(?:{_GAP}[A-Za-z0-9+/]++={{1,2}}+(?!\S)|(?:[\r\n]|\\[nr]){_GAP}[A-Za-z0-9+/]++={{0,2}}+(?=[ \t]*+(?:[\r\n\\\"'`]|\Z)))"
_LINES = rf"{_RUN}(?:{_RUN})*+{_LAST}?+"
PRIVATE_KEY = rf"-----BEGIN {_KEY}(?:(?:[^-]|-(?!----))*+-----END {_KEY}|{_HEADERS}(?:{_LINES})?+)"
# kind, regex, least length, group the length is of. The first three are the base; the order breaks ties of spans.
# Rules with a repeated class before what they require begin only where its run begins, so that a long run is read once.
RULES = [
    ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    ("access", r"AKIA[A-Z0-9]+", 16, 0),
    ("hex", r"[0-9a-f]+", 32, 0),
    ("private_key", PRIVATE_KEY, 0, 0),
    ("source_host_token", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36}", 0, 0),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("maps_key", r"AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("payment_key", r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}", 0, 0),
    ("bearer", r"(?ai)authorization: bearer [A-Za-z0-9._~+/=-]{16,}", 0, 0),
    ("url_password", r"(?<![a-z0-9+.-])[a-z0-9+.-]++://[^\s/:@]+:[^\s/:@]+@[^\s/]+", 0, 0),
]
BASE = ("assign", "access", "hex")
MASK = "[SECRET]"
FOUND = "doc_id long, spans array<struct<kind:string,start:int,end:int>>"
# A query is True (no condition), a trigram, or ("and" | "or", queries).
Query = bool | str | tuple


def trigrams(pattern: str) -> Query:
    """The Boolean trigram query that every text with a match fulfils; trigrams are ASCII-lower-cased."""
    return _query(parser.parse(pattern))


def _join(kind: str, parts: list[Query]) -> Query:
    if kind == "or":
        return True if any(p is True for p in parts) else parts[0] if len(parts) == 1 else ("or", tuple(dict.fromkeys(parts)))
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _query(nodes) -> Query:
    parts, run = [], ""

    def close() -> None:
        nonlocal run
        parts.extend(run[i:i + 3] for i in range(len(run) - 2))
        run = ""

    for op, value in nodes:
        if op is C.LITERAL and value < 128:
            run += chr(value).lower()
            continue
        close()
        if op is C.SUBPATTERN:
            parts.append(_query(value[3]))
        elif op is C.BRANCH:
            parts.append(_join("or", [_query(x) for x in value[1]]))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and value[0] >= 1:
            parts.append(_query(value[2]))
    close()
    return _join("and", parts)


def _named(query: Query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(_named, query[1]))


def _candidates(query: Query, postings: dict[str, set[int]], everyone: set[int]) -> set[int]:
    if query is True:
        return everyone
    if isinstance(query, str):
        return postings[query]
    sets = [_candidates(q, postings, everyone) for q in query[1]]
    return set.intersection(*sets) if query[0] == "and" else set.union(*sets)


def scanner(rules: list[tuple] = RULES):
    """A function from a list of texts to their spans, each a list of (kind, start, end) by start and then kind."""
    ready = [(k, kind, re.compile(pattern), _longer(pattern, least), least, group, trigrams(pattern)) for k, (kind, pattern, least, group) in enumerate(rules)]
    grams = sorted(set().union(*(_named(r[6]) for r in ready)))
    lower = {c: c + 32 for c in range(65, 91)}

    def scan(batch: list[str]) -> list[list[tuple[str, int, int]]]:
        lowered = [t.lower() if t.isascii() else t.translate(lower) for t in batch]
        postings = {g: {k for k, t in enumerate(lowered) if g in t} for g in grams}
        everyone = set(range(len(batch)))
        found: list[list] = [[] for _ in batch]
        for rank, kind, full, quick, least, group, query in ready:
            for k in _candidates(query, postings, everyone):
                text = batch[k]
                if quick is not None and not quick.search(text):
                    continue
                found[k] += [(m.start(), rank, kind, m.end()) for m in full.finditer(text) if m.end(group) - m.start(group) >= least]
        return [[(kind, start, end) for start, _, kind, end in sorted(f)] for f in found]

    return scan


def _longer(pattern: str, least: int) -> re.Pattern | None:
    """For a rule that is one repeated class: a search for a long enough run, so that the many short matches need not be listed."""
    tree = parser.parse(pattern)
    return re.compile(f"{pattern[:-1]}{{{least},}}") if least and len(tree) == 1 and tree[0][0] is C.MAX_REPEAT and pattern[-1] == "+" else None


def find(docs: DataFrame, rules: list[tuple] = RULES) -> DataFrame:
    """doc_id and spans (kind, start, end) of every row."""

    def rows():
        scan = scanner(rules)
        return lambda b: [(i, [{"kind": k, "start": s, "end": e} for k, s, e in spans]) for i, spans in zip(b["doc_id"], scan(b["text"]), strict=True)]

    return mapped(texts(docs, "doc_id"), rows, FOUND)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the sha256 of their spans, and all spans as text."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [of(kind) for kind in BASE]
    base = _joined(F.filter("spans", lambda s: s["kind"].isin(*BASE)))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by the mask."""
    out, done = [], 0
    for _, start, end in spans:
        if end <= done:
            continue
        if start >= done:
            out += [text[done:start], MASK]
        done = end
    return "".join(out) + text[done:]


def redact(docs: DataFrame, rules: list[tuple] = RULES) -> DataFrame:
    """The documents with masked secrets and n_chars of the new text; rows without secrets, and null texts, stay as they are."""
    shipped(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        scan = scanner(rules)
        for batch in pieces(batches):
            text = batch.column("text").to_pylist()
            spans = scan([t or "" for t in text])
            if any(spans):
                new = [masked(t, s) if s else t for t, s in zip(text, spans, strict=True)]
                batch = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(new, pa.string()))
                if "n_chars" in batch.schema.names:
                    old = batch.column("n_chars").to_pylist()
                    counts = [len(t) if s else n for t, s, n in zip(new, spans, old, strict=True)]
                    at = batch.schema.get_field_index("n_chars")
                    batch = batch.set_column(at, "n_chars", pa.array(counts, batch.schema.field(at).type))
            yield batch

    return rows_mapped(docs, run)
