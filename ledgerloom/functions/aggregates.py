"""Aggregate expressions; all support partial (map-side) aggregation unless noted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import _col, ratio


def sum_where(condition: Column, value) -> Column:
    """``sum(case when condition then value else 0 end)``."""
    return F.sum(F.when(condition, _col(value)).otherwise(F.lit(0)))


def count_distinct_where(condition: Column, value) -> Column:
    """Distinct non-null values among the rows that satisfy the condition."""
    return F.count_distinct(F.when(condition, _col(value)))


def weighted_avg(weight, value) -> Column:
    """``sum(weight * value) / sum(weight)``, null when the weights sum to zero."""
    w, v = _col(weight), _col(value)
    return ratio(F.sum(w * v), F.sum(w))


def mean_of(value) -> Column:
    """Average as a double of exact sum and count, so the result does not depend on row order."""
    col = _col(value)
    return ratio(F.sum(col), F.count(col))


def any_value(value) -> Column:
    return F.any_value(_col(value), ignoreNulls=F.lit(False))


def bool_or(value) -> Column:
    return F.bool_or(_col(value))


def list_agg(value, delimiter: str = ",", descending: bool = False, limit: int | None = None,
             order_by=None) -> Column:
    """Delimited text of the values in value order, or in the order of another column (ties by value).

    The text of one group is built in one task by definition, so use it where the
    group's values are known to be few. With a ``limit`` on large groups use
    :func:`ledgerloom.operators.relational.first_values`, which never holds more of a group.
    """
    text = _col(value).cast("string")
    if order_by is None:
        items = F.sort_array(F.collect_list(text), asc=not descending)
    else:
        pairs = F.collect_list(F.when(text.isNotNull(), F.struct(_col(order_by).alias("key"), text.alias("text"))))
        items = F.transform(F.sort_array(pairs, asc=not descending), lambda pair: pair["text"])
    if limit is not None:
        items = F.slice(items, 1, limit)
    # An empty group gives null, as LISTAGG does over no rows with a value.
    return F.when(F.size(items) > 0, F.array_join(items, delimiter))
