"""Joins, ranking, totals and set operations with skew-safe plans.

Rules followed here: no operator puts an unbounded group into one task, no cross
join except against one-row or calendar-bounded sides, and no hint broadcasts a
side whose size grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

NULL_SPREAD = 1024


def spread_nulls(key: str, by: str | Sequence[str]) -> Column:
    """A text join key whose nulls are replaced by many never-matching values.

    Null keys of an outer join all hash to one shuffle partition. The replacement
    starts with a control character no identifier has, and depends on the row, so
    the rows spread evenly and still match nothing. The hash is deterministic, so a
    retried task sends each row to the same partition.
    """
    columns = ", ".join(f"`{c}`" for c in ([by] if isinstance(by, str) else by))
    filler = f"concat(char(1), cast(pmod(xxhash64({columns}), {NULL_SPREAD}) as string))"
    return F.expr(f"coalesce(cast(`{key}` as string), {filler})")


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, spread_by: str | Sequence[str] | None = None) -> DataFrame:
    """Left join to a dimension on one text key; the dimension's key column is dropped.

    ``dim`` rows with a null key are ignored. ``spread_by`` names a column (or several) with many
    values and is given when ``key`` is often null. The spread key is made before the
    shuffle, so that ``spread_by`` and ``key`` are sent along only where they are read later.
    """
    if spread_by is None:
        return df.join(_dimension(dim, dim_key), F.col(key) == F.col("__dim_key"), "left").drop("__dim_key")
    rows = df.withColumn("__on", spread_nulls(key, spread_by))
    return rows.join(_dimension(dim, dim_key), F.col("__on") == F.col("__dim_key"), "left").drop("__on", "__dim_key")


def _dimension(dim: DataFrame, dim_key: str) -> DataFrame:
    """Keyed rows of a dimension, with the key under a name no other column has."""
    return dim.filter(F.col(dim_key).isNotNull()).select(
        F.col(dim_key).alias("__dim_key"), *[c for c in dim.columns if c != dim_key])


def attribute(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Join to a dimension and keep only the matched rows.

    Null keys never match, so they are filtered before the shuffle.
    """
    left = df.filter(F.col(key).isNotNull())
    return left.join(_dimension(dim, dim_key), F.col(key) == F.col("__dim_key"), "inner").drop("__dim_key")


# Words of 64 bits of a key filter. It is broadcast: with all words in use it takes some 15 MB, however many keys there are.
FILTER_WORDS = 1 << 18


def _filter_bits(key: str) -> tuple[Column, Column]:
    """The word of a key in a filter, and its three bits there."""
    code = F.xxhash64(F.col(key).cast("string"))
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(code, 18 + 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(3)]
    return F.pmod(code, F.lit(FILTER_WORDS)), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def with_may_match(df: DataFrame, dim: DataFrame, key: str, dim_key: str, name: str) -> DataFrame:
    """Add whether ``dim`` may have a row's key: false is certain, also for null keys, true is not.

    The keys of ``dim`` become bits of a fixed number of words, so that rows that a later join would not
    match can leave, or be told apart, before they are shuffled. With very many keys more rows may match; none is lost.
    """
    word, bits = _filter_bits(dim_key)
    words = dim.filter(F.col(dim_key).isNotNull()).groupBy(word.alias("__filter_word")).agg(F.bit_or(bits).alias("__filter_bits"))
    word, bits = _filter_bits(key)
    met = df.withColumn("__word", word).join(F.broadcast(words), F.col("__word") == F.col("__filter_word"), "left")
    may = F.col(key).isNotNull() & F.coalesce(F.col("__filter_bits").bitwiseAND(bits) == bits, F.lit(False))
    return met.withColumn(name, may).drop("__word", "__filter_word", "__filter_bits")


def unmatched(df: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """Rows of ``df`` with a non-null key that ``other`` does not have (NOT EXISTS)."""
    keys = other.select(F.col(other_key).alias("__other_key")).filter(F.col("__other_key").isNotNull())
    return df.filter(F.col(key).isNotNull()).join(keys, F.col(key) == F.col("__other_key"), "left_anti")


def or_join(left: DataFrame, right: DataFrame, left_key: str, right_keys: Sequence[tuple[str, int]],
            right_id: str, score: str = "match_score", spread_by: str | None = None) -> DataFrame:
    """Left join where ``left_key`` may equal any of several right columns.

    A disjunctive condition plans a nested-loop join. The right side is exploded to
    (key, id, score) instead, keeping the best score per (key, id) pair, and joined
    by equality. ``right_keys`` lists (column, score); the best score wins. ``spread_by``
    is as in :func:`lookup`.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.col(c).cast("string").alias("__key"), F.lit(s).alias(score)) for c, s in right_keys]))
    exploded = (right.select(F.col(right_id), pairs.alias("p"))
                .select(right_id, "p.*").filter(F.col("__key").isNotNull())
                .groupBy("__key", right_id).agg(F.max(score).alias(score)))
    on = spread_nulls(left_key, spread_by) if spread_by else F.col(left_key)
    joined = left.join(exploded, on == F.col("__key"), "left").drop("__key")
    return joined.withColumn(score, F.coalesce(score, F.lit(0)))


def top1(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Catalyst turns the rank filter into a group limit before the shuffle, so a hot
    key sends one row per task. Give an order that ends in unique columns.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("__rank", F.row_number().over(window))
            .filter(F.col("__rank") == 1).drop("__rank"))


def with_grand_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add the sum over all rows; a one-row aggregate instead of a single-task window."""
    total = df.agg(F.sum(value).alias(name))
    return df.crossJoin(F.broadcast(total))


def with_calendar_total(df: DataFrame, period: str, value: str, name: str) -> DataFrame:
    """Add the sum per calendar period (a DATE column).

    A window would put every customer of a month into one task. The totals have one
    row per period, bounded by the calendar, so they are broadcast.
    """
    if not isinstance(df.schema[period].dataType, T.DateType):
        raise TypeError(f"{period} must be a DATE column")
    totals = df.groupBy(F.col(period).alias("__period")).agg(F.sum(value).alias(name))
    return df.join(F.broadcast(totals), F.col(period).eqNullSafe(F.col("__period")), "left").drop("__period")


def with_distinct_over(df: DataFrame, keys: Sequence[str], distinct: dict[str, Column]) -> DataFrame:
    """``count(distinct x) over (partition by keys)``, which Spark has no window form for."""
    counts = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
        *[F.count_distinct(expr).alias(name) for name, expr in distinct.items()])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(counts, condition, "left").drop(*[f"__{k}" for k in keys])


def distinct_deltas(events: DataFrame, key: str, member: str, day: str, days: int, name: str) -> DataFrame:
    """Daily change of the number of members seen in the trailing ``days`` days, per key.

    A member seen on day d counts on [d, d + days - 1], cut short at its next sighting.
    Those intervals never overlap for one member, so +1 at the start and -1 past the
    end, summed per day and accumulated, is the exact distinct count. The work is
    linear in the distinct (key, member, day) rows; a range join would repeat each
    row ``days`` times. The sums combine on the map side, so a key with very many
    members leaves one small row per day.
    """
    seen = events.select(key, member, day).filter(
        F.col(key).isNotNull() & F.col(member).isNotNull() & F.col(day).isNotNull()).distinct()
    per_member = Window.partitionBy(key, member).orderBy(day)
    stop = F.least(F.date_add(day, days), F.lead(day).over(per_member))
    deltas = F.explode(F.array(F.struct(F.col(day).alias(day), F.lit(1).alias("n")),
                               F.struct(F.col("__stop").alias(day), F.lit(-1).alias("n"))))
    return (seen.select(key, day, stop.alias("__stop")).select(key, deltas.alias("d"))
            .groupBy(key, F.col(f"d.{day}").alias(day)).agg(F.sum("d.n").alias(name)))


def rolling_distinct(events: DataFrame, grid: DataFrame, key: str, member: str, day: str, days: int,
                     name: str) -> DataFrame:
    """Distinct members seen in the trailing ``days`` days, per (key, day) of ``grid``."""
    deltas = distinct_deltas(events, key, member, day, days, "__delta").withColumn("__on_grid", F.lit(False))
    rows = grid.select(key, day, F.lit(0).cast("bigint").alias("__delta"), F.lit(True).alias("__on_grid"))
    # One shuffle by key serves the sum per day and the running sum: a key has few days left.
    daily = (deltas.unionByName(rows).repartition(F.col(key)).groupBy(key, day)
             .agg(F.sum("__delta").alias("__delta"), F.bool_or("__on_grid").alias("__on_grid")))
    running = Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (daily.withColumn(name, F.sum("__delta").over(running))
            .filter("__on_grid").select(key, day, name))


def _day_number(column: str) -> Column:
    return F.unix_date(F.col(column).cast("date"))


def band_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, first: int, last: int) -> DataFrame:
    """Pairs with equal keys whose right day is ``first`` to ``last`` days after the left day.

    Days are cut into stretches as long as the band, so that a left row's band meets two of
    them at most: the left rows go to both, a right row to its own, and the join is an
    equality join on keys and stretch, whose rest decides on the exact days. A key with
    many rows is spread over its stretches. Null keys and days match nothing. All columns
    of both sides are kept but the right side's keys.
    """
    width = last - first + 1
    if width < 1:
        raise ValueError("a band ends at or after its first day")
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))
    start = F.floor((F.col("__day") + first) / width)
    met = F.array_distinct(F.array(start, F.floor((F.col("__day") + last) / width)))
    lefts = left.filter(known & F.col(left_at).isNotNull()).withColumn("__day", _day_number(left_at)).withColumn("__stretch", F.explode(met))
    renamed = right.filter(known & F.col(right_at).isNotNull()).withColumn("__to", _day_number(right_at)).withColumn(
        "__right_stretch", F.floor(F.col("__to") / width)).withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [F.col(k) == F.col(f"__r_{k}") for k in keys] + [F.col("__stretch") == F.col("__right_stretch")]
    far = F.col("__to") - F.col("__day")
    pairs = lefts.join(renamed, reduce(lambda a, b: a & b, on)).filter(far.between(first, last))
    return pairs.drop("__day", "__to", "__stretch", "__right_stretch", *[f"__r_{k}" for k in keys])


# Parts of an aggregate that can be merged, and how: kind -> [(partial, merge)].
_MERGED = {"sum": [(F.sum, F.sum)], "min": [(F.min, F.min)], "max": [(F.max, F.max)], "count": [(F.count, F.sum)],
           "avg": [(F.sum, F.sum), (F.count, F.sum)]}


def band_aggregate(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, first: int, last: int,
                   measures: dict[str, tuple[str, str]]) -> DataFrame:
    """Left rows with aggregates of the right rows whose day is ``first`` to ``last`` days after theirs.

    ``measures`` names (kind, column); kinds are sum, min, max, count and avg. The right rows
    are reduced to one row a key and day first, so a left row meets as many rows as the
    band has days, however many there are behind them. Left rows without any get nulls, and 0 for counts; equal left rows
    stay as many as they are. Decimals keep sums exact.
    """
    day = "__at"
    partial = {f"__{name}_{i}": part(column) for name, (kind, column) in measures.items() for i, (part, _) in enumerate(_MERGED[kind])}
    daily = right.groupBy(*keys, F.col(right_at).cast("date").alias(day)).agg(*[c.alias(n) for n, c in partial.items()])
    asked = left.groupBy(*left.columns).agg(F.count(F.lit(1)).alias("__copies"))
    pairs = band_join(asked, daily, keys, left_at, day, first, last).drop(day)
    both = asked.unionByName(pairs, allowMissingColumns=True)
    merged = {f"__{name}_{i}": merge(f"__{name}_{i}") for name, (kind, _) in measures.items() for i, (_, merge) in enumerate(_MERGED[kind])}
    rows = both.groupBy(*asked.columns).agg(*[c.alias(n) for n, c in merged.items()])

    def value(name: str, kind: str) -> Column:
        if kind == "avg":
            return F.try_divide(F.col(f"__{name}_0").cast("double"), F.col(f"__{name}_1"))
        return F.coalesce(f"__{name}_0", F.lit(0)) if kind == "count" else F.col(f"__{name}_0")

    out = rows.select(*left.columns, *[value(name, kind).alias(name) for name, (kind, _) in measures.items()], "__copies")
    return out.withColumn("__copies", F.explode(F.sequence(F.lit(1), F.col("__copies")))).drop("__copies")


def first_values(df: DataFrame, keys: Sequence[str], value: str, count: int, name: str, delimiter: str = ",",
                 order: Sequence[Column] | None = None) -> DataFrame:
    """Delimited text of the first ``count`` values per key, in value order or the given one; a key without any has none.

    The rank filter becomes a group limit before the shuffle, so a task gets at most
    ``count`` values of a key from each task before, not the whole group.
    """
    rows = df.filter(F.col(value).isNotNull())
    window = Window.partitionBy(*keys).orderBy(*(order or [F.col(value)]))
    ranked = rows.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") <= count)
    few = F.sort_array(F.collect_list(F.struct("__rank", F.col(value).cast("string").alias("text"))))
    return ranked.groupBy(*keys).agg(F.array_join(F.transform(few, lambda x: x["text"]), delimiter).alias(name))


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def intersect_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)
