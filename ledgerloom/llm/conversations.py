"""Cheapest repair of damaged conversations by block tables (the method of the Four Russians).

A conversation should have the role initials ``(s?(ua)+)?``. Rows may be kept (0), given the role
user or assistant (2), deleted (3; blank and repeated rows must be), and rows without text may be
inserted (2); a row that stays and ends in no ``[.!?]`` costs 1 more. The cost of all that is still
to come is a vector over the four states of that pattern. Less its least entry it is one of a few
vectors, so the step over every block of BLOCK row kinds is tabled once for each of them. A
conversation is read from its end in such blocks, one look-up each; then it is read from its start,
every block expanded backward again into its inner vectors, and of all cheapest edits the ASCII-least
is taken. That is safe for ties because each choice is made on the exact cost of the rest.

Rows of one conversation stand by turn, null first; rows of one turn by role and the SHA-256 of their
text, equal rows are copies. Null conv_ids are one conversation, null roles and texts one space.
Conversations whose rows were all dropped have zeros and the empty audit; an empty table gives none.
Other columns are not read, so none can clash. Whether a row repeats an earlier one is an aggregate
over digests, so no task holds the texts of a conversation. The audit is one cell, so the task that
makes it holds a byte for each row. Texts pass that task once, sorted on disk, for their digest: SHA-256
of a whole conversation is sequential, however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, WHITE, pieces, shipped

# Costs of the edits, states of the pattern (0 start, 1 after s, 2 after u, 3 after a).
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
INSERTED = [2, 2, 3, 2]  # the only role that may be inserted or given in a state leads here
KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}  # (state, initial) -> state; initials: s 0, u 1, a 2, others 3
NAMES = {2: "user", 3: "assistant"}
BLOCK = 4
# A row is a byte: initial + 4 * fault (none 0, blank 1, duplicate 2, truncated 3), and 16 for a further copy of the row before.
COPY = 16
KINDS = 9  # kept kinds 0-3, truncated 4-7, to be deleted 8
TO_KIND = bytes(8 if (b >> 2) & 3 in (1, 2) else (b & 3) + 4 * ((b >> 2) & 3 == 3) for b in range(256))
FAR = 1 << 20


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of every row: by crc32 of ``conv_id:turn`` modulo 20, 0 drops a row
    (no copies), 1 empties its text, 2 removes its ``[.!?]``, 3 doubles it, 4 makes it the user's."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    named = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"),
                        F.coalesce("text", blank).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("d"))
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return named.select("conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                        F.when(F.col("d") == 0, 0).when(F.col("d") == 3, 2).otherwise(1).alias("copies"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Every conversation's row kinds, then its texts, in order, in one partition.

    ``part`` 0 are the kinds: equal rows once with their number and whether an earlier row has
    the same role and text. ``part`` 1 are the texts of the same rows, copies included.
    """
    there = F.col("copies") > 0
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    rows = rows.withColumns({"role": F.when(there, F.col("role")).otherwise(""), "text": F.when(there, F.col("text")).otherwise("")})
    marked = rows.withColumns({
        "digest": F.unhex(F.sha2("text", 256)), "blank": body == "",
        "cut": (body != "") & ~F.substring(body, -1, 1).isin(".", "!", "?")})
    same = ["conv_id", "turn", "role", "digest"]
    counts = marked.groupBy(*same, "blank", "cut").agg(F.sum("copies").alias("n"))
    turn = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = counts.where("n > 0").groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("t")).select(
        "conv_id", F.col("t.turn").alias("turn"), "role", "digest", F.lit(False).alias("blank"), F.lit(False).alias("cut"),
        F.lit(0).cast("long").alias("n"), F.lit(1).alias("first"))
    kinds = counts.withColumn("first", F.lit(0)).unionByName(firsts).groupBy(*same).agg(
        F.max("blank").alias("blank"), F.max("cut").alias("cut"), F.sum("n").alias("n"), F.max("first").alias("first"))
    fault = F.when(F.col("blank"), 1).when(F.col("first") == 0, 2).when(F.col("cut"), 3).otherwise(0)
    initial = _initial(F.substring("role", 1, 1))
    kinds = kinds.select(*same, F.lit(0).alias("part"), (initial + 4 * fault).alias("kind"), "blank", "n",
                         F.lit(None).cast("string").alias("text"))
    kept = F.when(F.col("blank"), "").otherwise(F.col("text"))
    texts = marked.where(there).select(*same, F.lit(1).alias("part"), F.lit(0).alias("kind"), "blank", F.lit(1).cast("long").alias("n"),
                                       kept.alias("text"))
    both = kinds.unionByName(texts).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "part", "turn", "role", "digest")


def _initial(letter: Column) -> Column:
    return F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3)


# --- tables ------------------------------------------------------------------------


def _closed(f: list[int]) -> list[int]:
    for _ in range(3):
        f = [min(f[q], INSERT + f[INSERTED[q]]) for q in range(4)]
    return f


def _step(kind: int, f: tuple[int, ...]) -> list[int]:
    """Costs before a row of this kind, of the costs after it."""
    out = [DELETE + f[q] for q in range(4)]
    if kind < 8:
        more, initial = CUT * (kind >= 4), kind % 4
        for q in range(4):
            out[q] = min(out[q], REROLE + more + f[INSERTED[q]], more + f[KEPT[q, initial]] if (q, initial) in KEPT else FAR)
    return _closed(out)


@cache
def tables() -> tuple:
    """Vectors; next vector and cost by vector and kind; the same by vector and block of kinds."""
    end = tuple(_closed([0, FAR, FAR, 0]))
    vectors, number, rows, costs = [end], {end: 0}, [], []
    for v in vectors:  # grows while it is read
        row, cost = [], []
        for kind in range(KINDS):
            f = _step(kind, v)
            least = min(f)
            normal = tuple(x - least for x in f)
            if normal not in number:
                number[normal] = len(vectors)
                vectors.append(normal)
            row.append(number[normal])
            cost.append(least)
        rows.append(row)
        costs.append(cost)
    following, cost = np.array(rows), np.array(costs)
    block_next, block_cost, width = following, cost, KINDS
    for _ in range(BLOCK - 1):  # one more row in front of the blocks so far
        one = np.arange(KINDS)
        ahead = block_next[:, None, :]
        block_next, block_cost = following[ahead, one[None, :, None]], cost[ahead, one[None, :, None]] + block_cost[:, None, :]
        width *= KINDS
        block_next, block_cost = block_next.reshape(len(vectors), width), block_cost.reshape(len(vectors), width)
    return vectors, rows, costs, block_next.tolist(), block_cost.tolist()


_EXPANDED: dict[tuple, tuple[str, int]] = {}


def _expand(q: int, kinds: bytes, v: int) -> tuple[str, int]:
    """ASCII-least cheapest edits of a block, from state q, with vector v after it; and the state they lead to.

    Kept for each state, block and vector, of which there are only so many.
    """
    known = _EXPANDED.get((q, kinds, v))
    if known:
        return known
    vectors, following, costs = tables()[:3]
    start, after = q, [v]
    for kind in reversed(kinds):
        after.append(following[after[-1]][kind])
    edits, at = [], len(kinds)
    while at:
        kind, rest, now = kinds[len(kinds) - at], vectors[after[at - 1]], vectors[after[at]]
        shift = costs[after[at - 1]][kind]
        wanted, initial, more = now[q] + shift, kind % 4, CUT * (kind >= 4)
        if DELETE + rest[q] == wanted:
            edits.append("D")
        elif INSERT + now[INSERTED[q]] + shift == wanted:
            edits.append("I")
            q = INSERTED[q]
            continue
        elif kind < 8 and (q, initial) in KEPT and more + rest[KEPT[q, initial]] == wanted:
            edits.append("K")
            q = KEPT[q, initial]
        else:
            edits.append("R")
            q = INSERTED[q]
        at -= 1
    _EXPANDED[start, kinds, v] = "".join(edits), q
    return _EXPANDED[start, kinds, v]


def cheapest(kinds: bytes) -> tuple[int, str]:
    """Least cost and ASCII-least cheapest edits of a conversation of these row kinds."""
    vectors, following, costs, block_next, block_cost = tables()
    whole = len(kinds) // BLOCK * BLOCK
    v, total = 0, 0
    for kind in reversed(kinds[whole:]):
        total += costs[v][kind]
        v = following[v][kind]
    after = []
    for at in range(whole - BLOCK, -1, -BLOCK):
        code = 0
        for kind in kinds[at:at + BLOCK]:
            code = code * KINDS + kind
        after.append(v)
        total += block_cost[v][code]
        v = block_next[v][code]
    total += vectors[v][0]
    out, q = [], 0
    for at in range(0, whole, BLOCK):
        edits, q = _expand(q, kinds[at:at + BLOCK], after.pop())
        out.append(edits)
    edits, q = _expand(q, kinds[whole:], 0) if whole < len(kinds) else ("", q)
    tail = {0: "", 1: "II", 2: "I", 3: ""}[q]
    return total, "".join([*out, edits, tail])


# --- conversations -----------------------------------------------------------------


class _Conversation:
    """One conversation while its sorted rows pass: kinds first, then texts, of which none is kept."""

    def __init__(self, conv_id):
        self.conv_id, self.rows, self.turns, self.last = conv_id, bytearray(), 0, None
        self.low = self.high = self.audit = self.cost = None

    def add_kind(self, turn, kind: int, n: int) -> None:
        if not n:
            return
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        self.rows.append(kind)
        later = kind if (kind >> 2) == 1 else (kind & 3) + 8  # copies of a blank row are blank, of others duplicates
        self.rows += bytes([later + COPY]) * (n - 1)

    def solve(self) -> None:
        self.rows = bytes(self.rows)
        self.cost, self.audit = cheapest(self.rows.translate(TO_KIND))
        self.at = self.row = self.state = 0

    def add_text(self, key, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the rows that stay, up to this one and its copies."""
        if key == self.last:
            return
        self.last = key
        while True:
            yield from self._inserted()
            edit, kind = self.audit[self.at], self.rows[self.row]
            self.at, self.row = self.at + 1, self.row + 1
            if edit == "K":
                self.state = KEPT[self.state, kind & 3]
                yield edit, role, text
            elif edit == "R":
                self.state = INSERTED[self.state]
                yield edit, NAMES[self.state], text
            if self.row == len(self.rows) or self.rows[self.row] < COPY:
                return

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at, self.state = self.at + 1, INSERTED[self.state]
            yield "I", NAMES[self.state], ""

    def finish(self) -> Iterator[tuple[str, str, str]]:
        if self.audit is None:
            self.solve()
        yield from self._inserted()

    def counts(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit."""
        faults = [0, 0, 0, 0]
        for byte in range(2 * COPY):
            faults[(byte >> 2) & 3] += self.rows.count(byte)
        initials = self.rows.translate(bytes(b & 3 for b in range(256)))
        legal = sum(initials.count(pair) for pair in (b"\0\1", b"\1\2", b"\2\1"))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, *faults[1:], max(len(initials) - 1, 0) - legal, self.cost, self.audit


def _pass(rows: Iterator[tuple]) -> Iterator[tuple[_Conversation, tuple[str, str, str] | None]]:
    """The rows that stay of each conversation, and after its last one the conversation with None."""
    now = None
    for conv_id, turn, role, digest, part, kind, n, text in rows:
        if now is None or conv_id != now.conv_id:
            if now is not None:
                yield from ((now, row) for row in now.finish())
                yield now, None
            now = _Conversation(conv_id)
        if part == 0:
            now.add_kind(turn, kind, n)
        else:
            if now.audit is None:
                now.solve()
            yield from ((now, row) for row in now.add_text((turn, role, digest), role, text))
    if now is not None:
        yield from ((now, row) for row in now.finish())
        yield now, None


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    columns = ["conv_id", "turn", "role", "digest", "part", "kind", "n", "text"]
    for batch in pieces(batches):
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _batches(rows: Iterator[tuple], columns: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    size = 0
    for row in rows:
        waiting.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if len(waiting) == BATCH_ROWS or size > 1 << 24:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*waiting, strict=True), kinds, strict=True)], columns)
            waiting, size = [], 0
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*waiting, strict=True), kinds, strict=True)], columns)


def _mapped(rows: DataFrame, make, schema: str, kinds: list[pa.DataType]) -> DataFrame:
    shipped(rows.sparkSession)
    ordered = _ordered(rows if "copies" in rows.columns else rows.withColumn("copies", F.lit(1))).drop("blank")
    key = ordered.schema["conv_id"].dataType.simpleString()
    columns = ["conv_id", *(field.split()[0] for field in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            types = [first.schema.field("conv_id").type, *kinds]
            yield from _batches(make(_pass(_each(_chain(first, batches)))), columns, types)

    return ordered.mapInArrow(run, f"conv_id {key}, {schema}")


def _chain(first, rest):
    yield first
    yield from rest


def audit(rows: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` has conv_id, turn, role and text without nulls in the last two, and perhaps ``copies`` (damage()).
    """
    def make(passed):
        digest, empty = hashlib.sha256(), True
        for conversation, row in passed:
            if row is None:
                yield conversation.conv_id, *conversation.counts(), digest.hexdigest()
                digest, empty = hashlib.sha256(), True
            else:
                digest.update(f"{'' if empty else chr(10)}{row[1]}:{row[2]}".encode())
                empty = False

    return _mapped(rows, make, "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string",
                   [*[pa.int64()] * 6, pa.string(), pa.string()])


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), edit (K, R or I), role and text of every row that stays."""
    def make(passed):
        position = 0
        for conversation, row in passed:
            if row is None:
                position = 0
            else:
                yield conversation.conv_id, position, *row
                position += 1

    return _mapped(rows, make, "position long, edit string, role string, text string", [pa.int64(), *[pa.string()] * 3])


def oracle_sql() -> str:
    """DuckDB SQL of audit(damage(conversations)): crc32 by table, and one step for each row with the best edits of every state."""
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE crc AS (SELECT [list_reduce([0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)
    FOR b IN range(256)] AS t),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    [ascii(ch)::BIGINT FOR ch IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')] AS b FROM conversations),
drawn AS (SELECT conv_id, turn, role, text, xor(list_reduce(b, lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1]), 4294967295), 4294967295) % 20 AS d
    FROM keyed, crc),
damaged AS (SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM drawn),
ids AS (SELECT conv_id, row_number() OVER () AS k FROM (SELECT DISTINCT conv_id FROM conversations)),
stood AS (SELECT k, turn, role, text, rtrim(text, {white}) AS body, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
    FROM damaged JOIN ids ON damaged.conv_id IS NOT DISTINCT FROM ids.conv_id),
faulty AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, left(role, 1) AS initial,
    lag(left(role, 1)) OVER (PARTITION BY k ORDER BY i) || left(role, 1) AS pair FROM stood),
counted AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faulty GROUP BY k),
keeps(q, initial, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
inserts(q, more, text, edits, q2) AS (VALUES (0, 0, '', '', 0), (1, 0, '', '', 1), (2, 0, '', '', 2), (3, 0, '', '', 3),
    (0, 2, chr(10) || 'user:', 'I', 2), (1, 2, chr(10) || 'user:', 'I', 2), (3, 2, chr(10) || 'user:', 'I', 2), (2, 2, chr(10) || 'assistant:', 'I', 3),
    (0, 4, chr(10) || 'user:' || chr(10) || 'assistant:', 'II', 3), (1, 4, chr(10) || 'user:' || chr(10) || 'assistant:', 'II', 3)),
best(k, i, q, cost, audit, said) AS (
    SELECT k, 0::BIGINT, q2, more, edits, text FROM ids, inserts WHERE q = 0
  UNION ALL
    SELECT k, i, q, cost, audit, said FROM (
      SELECT c.k, c.i, n.q2 AS q,
        arg_min(c.cost + n.more, printf('%012d', c.cost + n.more) || c.audit || n.edits) AS cost,
        arg_min(c.audit || n.edits, printf('%012d', c.cost + n.more) || c.audit || n.edits) AS audit,
        arg_min(c.said || n.text, printf('%012d', c.cost + n.more) || c.audit || n.edits) AS said
      FROM (
        SELECT b.k, f.i, e.q2 AS q, b.cost + e.more + CASE WHEN e.edit <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END AS cost, b.audit || e.edit AS audit,
          b.said || CASE e.edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text
            ELSE chr(10) || CASE e.q2 WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || f.text END AS said
        FROM best b JOIN faulty f ON f.k = b.k AND f.i = b.i + 1
        JOIN (SELECT 'D' AS edit, q, q AS q2, 3 AS more, NULL AS initial FROM (VALUES (0), (1), (2), (3)) s(q)
          UNION ALL SELECT 'R', q, q2, 2, NULL FROM (VALUES (0, 2), (1, 2), (2, 3), (3, 2)) r(q, q2)
          UNION ALL SELECT 'K', q, q2, 0, initial FROM keeps) e
          ON e.q = b.q AND (e.edit = 'D' OR (f.fault NOT IN ('blank', 'duplicate') AND (e.edit = 'R' OR e.initial = f.initial)))) c
      JOIN inserts n ON n.q = c.q GROUP BY c.k, c.i, n.q2))
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, b.cost::BIGINT AS cost, b.audit AS audit,
  sha256(substr(b.said, 2)) AS repaired_sha256
FROM ids LEFT JOIN counted ON counted.k = ids.k
JOIN (SELECT k, i, arg_min(cost, printf('%012d', cost) || audit) AS cost, arg_min(audit, printf('%012d', cost) || audit) AS audit,
    arg_min(said, printf('%012d', cost) || audit) AS said FROM best WHERE q IN (0, 3) GROUP BY k, i) b
  ON b.k = ids.k AND b.i = coalesce(counted.n, 0)"""
