"""Date rules: calendar-boundary differences, typed truncation, spines.

Spark's ``date_trunc`` returns a timestamp and ``datediff(MONTH, ..)`` counts
whole months; the functions here keep DATE in / DATE out and count calendar
boundaries, which is what the models need.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TRUNC_UNIT = {"year": "YEAR", "quarter": "QUARTER", "month": "MM", "week": "WEEK"}
_INTERVAL = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH",
             "quarter": "INTERVAL 3 MONTH", "year": "INTERVAL 1 YEAR"}


def _col(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def as_date(value: str | dt.date) -> dt.date:
    """Accept ``'YYYY-MM-DD'`` or a date; every model takes an explicit ``as_of``."""
    if isinstance(value, dt.datetime):
        return value.date()
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def date_lit(value: str | dt.date) -> Column:
    return F.lit(as_date(value)).cast("date")


def add_months_py(day: dt.date, months: int) -> dt.date:
    """First-of-month arithmetic for plan-time constants (``day`` must be a first of month)."""
    index = day.year * 12 + day.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, day.day)


def trunc_date(part: str, column: str | Column) -> Column:
    """Truncate to the start of ``part``; the result is a DATE."""
    col = _col(column).cast("date")
    return col if part == "day" else F.trunc(col, _TRUNC_UNIT[part])


def try_date(column: str | Column) -> Column:
    """Date of a text, or null when the text is not a date."""
    return _col(column).try_cast("date")


def try_timestamp(column: str | Column) -> Column:
    """Zone-less timestamp of a text, or null; a zone suffix is dropped, not applied."""
    return _col(column).try_cast("timestamp_ntz")


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Calendar days from start to end, also when the inputs are timestamps."""
    return F.datediff(_col(end).cast("date"), _col(start).cast("date"))


def month_diff(start: str | Column, end: str | Column) -> Column:
    """Calendar month boundaries crossed (31 Jan -> 1 Feb is 1)."""
    s, e = _col(start).cast("date"), _col(end).cast("date")
    return (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))


def year_diff(start: str | Column, end: str | Column) -> Column:
    return F.year(_col(end).cast("date")) - F.year(_col(start).cast("date"))


def quarter_diff(start: str | Column, end: str | Column) -> Column:
    s, e = _col(start).cast("date"), _col(end).cast("date")
    return (F.year(e) * 4 + F.quarter(e)) - (F.year(s) * 4 + F.quarter(s))


def week_diff(start: str | Column, end: str | Column) -> Column:
    return (day_diff(trunc_date("week", start), trunc_date("week", end)) / 7).cast("int")


# Seconds of the parts below a day.
_CLOCK = {"hour": 3600, "minute": 60, "second": 1}


def _seconds(column: str | Column) -> Column:
    """Whole seconds since 1970 by the clock of the value, whatever the session's time zone."""
    at = _col(column).cast("timestamp_ntz")
    days = F.datediff(at.cast("date"), F.lit(dt.date(1970, 1, 1))).cast("bigint")
    return days * 86400 + F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)


_DIFF = {"day": day_diff, "week": week_diff, "month": month_diff, "quarter": quarter_diff, "year": year_diff}


def date_diff(part: str, start: str | Column, end: str | Column) -> Column:
    """Boundary-counting difference for second, minute, hour, day, week, month, quarter or year."""
    if part in _CLOCK:
        unit = F.lit(_CLOCK[part])
        return F.floor(_seconds(end) / unit) - F.floor(_seconds(start) / unit)
    return _DIFF[part](start, end)


def add_days(column: str | Column, days: int | Column) -> Column:
    return F.date_add(_col(column).cast("date"), days)


def date_add_part(part: str, amount: int | Column, column: str | Column) -> Column:
    """Add ``amount`` of ``part``; month steps clamp to the last day of the month, parts below a day give a timestamp."""
    if part in _CLOCK:
        steps = amount if isinstance(amount, Column) else F.lit(amount)
        return _col(column).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), steps * _CLOCK[part])
    if part == "day":
        return add_days(column, amount)
    if part == "week":
        return add_days(column, amount * 7)
    months = {"month": 1, "quarter": 3, "year": 12}[part]
    return F.add_months(_col(column).cast("date"), amount * months)


def last_day_of(part: str, column: str | Column) -> Column:
    """Last day of the enclosing month, quarter or year (the week ends on Sunday)."""
    if part == "month":
        return F.last_day(_col(column).cast("date"))
    return F.date_sub(date_add_part(part, 1, trunc_date(part, column)), 1)


def make_date(year: Column | int, month: Column | int, day: Column | int) -> Column:
    def lit(v):
        return v if isinstance(v, Column) else F.lit(v)

    return F.make_date(lit(year), lit(month), lit(day))


def number_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """``generated_number`` 1..upper_bound."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def date_spine(spark: SparkSession, part: str, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row per ``part`` from start, end excluded, in column ``date_{part}``."""
    first, stop = date_lit(start), date_lit(end)
    days = F.sequence(first, stop, F.expr(_INTERVAL[part]))
    wanted = date_diff(part, first, stop)
    spine = F.when(wanted > 0, F.slice(days, F.lit(1), F.greatest(wanted, F.lit(1)))).otherwise(
        F.array().cast("array<date>"))
    return spark.range(1).select(F.explode(spine).alias(f"date_{part}"))


def trailing_days(spark: SparkSession, as_of: str | dt.date, days: int, name: str = "event_date") -> DataFrame:
    """The ``days`` dates that end at ``as_of`` (inclusive)."""
    last = date_lit(as_of)
    return spark.range(1).select(
        F.explode(F.sequence(F.date_sub(last, days - 1), last, F.expr("INTERVAL 1 DAY"))).alias(name))


def dates_in_range(spark: SparkSession, start: str, end: str | None = None, in_fmt: str = "yyyyMMdd",
                   out_fmt: str | None = "yyyyMMdd", name: str = "partition_date") -> DataFrame:
    """Inclusive list of dates between two formatted texts, formatted again unless ``out_fmt`` is None."""
    first = F.to_date(F.lit(start), in_fmt)
    last = F.to_date(F.lit(end if end is not None else start), in_fmt)
    checked = F.when(last < first, F.raise_error(F.lit("partition start date is after the end date"))).otherwise(
        F.sequence(first, last, F.expr("INTERVAL 1 DAY")))
    day = F.explode(checked.cast("array<date>"))
    frame = spark.range(1).select(day.alias(name))
    return frame if out_fmt is None else frame.select(F.date_format(name, out_fmt).alias(name))


def partition_range(spark: SparkSession, raw: str, fmt: str = "yyyyMMdd") -> DataFrame:
    """``'20240101'`` or ``'20240101,20240131'`` as a list of partition dates."""
    parts = raw.split(",")
    if len(parts) > 2:
        raise ValueError(f"expected '{{start}}[,{{end}}]', got {raw!r}")
    return dates_in_range(spark, parts[0].strip(), parts[1].strip() if len(parts) == 2 else None, in_fmt=fmt)


def utc_now() -> Column:
    """The current moment as UTC wall time, whatever the session's zone."""
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
