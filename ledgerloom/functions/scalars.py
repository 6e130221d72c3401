"""Scalar expressions whose null, sign or zero rules differ from Spark's defaults."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,6)"


def _col(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def _any_null(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def least_or_null(*values) -> Column:
    """Smallest value, null when any argument is null (Spark's ``least`` skips nulls)."""
    cols = [_col(v) for v in values]
    return F.when(~_any_null(cols), F.least(*cols))


def greatest_or_null(*values) -> Column:
    """Largest value, null when any argument is null."""
    cols = [_col(v) for v in values]
    return F.when(~_any_null(cols), F.greatest(*cols))


def clamp(value, low, high) -> Column:
    """``value`` limited to [low, high]; null stays null."""
    col = _col(value)
    return F.when(col.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), col)))


def money(value) -> Column:
    """Amounts as DECIMAL(28,6): sums are exact and independent of row order."""
    return _col(value).cast(MONEY)


def ratio(numerator, denominator) -> Column:
    """Double division; null on a zero or null denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def flag(condition: Column) -> Column:
    """1 when the condition holds, else 0 (also when it is null)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def is_true(condition: Column) -> Column:
    """True when the condition holds, else false (also when it is null)."""
    return F.coalesce(condition, F.lit(False))


def zero_if_null(value) -> Column:
    """Null as 0 in the column's own type."""
    return F.coalesce(_col(value), F.lit(0))


def contains_any_ci(column, words: list[str]) -> Column:
    """Case-insensitive ``LIKE '%word%'`` for any of the words."""
    return reduce(lambda a, b: a | b, [_col(column).ilike(f"%{w}%") for w in words])


def right_text(text, length) -> Column:
    """Last ``length`` characters; empty text for length 0."""
    n = _col(length) if not isinstance(length, int) else F.lit(length)
    return F.when(n == 0, F.lit("")).otherwise(F.right(_col(text), n))


def split_part(text, delimiter: str, part: int) -> Column:
    """1-based part of a split text; negative parts count from the end."""
    return F.split_part(_col(text), F.lit(delimiter), F.lit(part))


def position(needle: str, text) -> Column:
    """1-based position of ``needle``, 0 when absent."""
    return F.locate(needle, _col(text))


def string_literal(value: str) -> Column:
    return F.lit(value)


def escape_single_quotes(value: str) -> str:
    """Double every single quote, for use inside a SQL text literal."""
    return value.replace("'", "''")


def safe_cast(value, type_name: str) -> Column:
    """Cast, or null when the value does not fit."""
    return _col(value).try_cast(type_name)


def bool_to_text(value) -> Column:
    return _col(value).cast("string")


def equals(left, right, null_safe: bool = False) -> Column:
    """Equality; with ``null_safe`` two nulls are equal."""
    l, r = _col(left), _col(right)
    return l.eqNullSafe(r) if null_safe else l == r


def array_of(*values) -> Column:
    return F.array(*[_col(v) for v in values])


def array_with(array, value) -> Column:
    return F.array_append(_col(array), _col(value))


def array_join_up(left, right) -> Column:
    return F.concat(_col(left), _col(right))
