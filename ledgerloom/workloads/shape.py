"""Common output form of a query and of its oracle.

``spec`` is ``"column:type ..."`` with types s(tring) i(nteger) b(oolean) d(ate)
t(imestamp) and fN (double rounded to N digits). Dates and timestamps are printed
as text and integers that may be null are doubles (f0), so both engines return the
same values whatever client reads them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPARK = {"s": "string", "i": "bigint", "b": "boolean"}
_SQL = {"s": "VARCHAR", "i": "BIGINT", "b": "BOOLEAN"}


def _parse(spec: str) -> list[tuple[str, str]]:
    return [tuple(item.split(":")) for item in spec.split()]


def finish(df: DataFrame, spec: str) -> DataFrame:
    def col(name: str, kind: str) -> Column:
        if kind[0] == "f":
            return F.round(F.col(name).cast("double"), int(kind[1:])).alias(name)
        if kind == "d":
            return F.date_format(name, "yyyy-MM-dd").alias(name)
        if kind == "t":
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)
        return F.col(name).cast(_SPARK[kind]).alias(name)

    return df.select(*[col(n, k) for n, k in _parse(spec)])


def finish_sql(source: str, spec: str) -> str:
    def col(name: str, kind: str) -> str:
        if kind[0] == "f":
            return f"ROUND(CAST({name} AS DOUBLE), {kind[1:]}) AS {name}"
        if kind == "d":
            return f"STRFTIME(CAST({name} AS DATE), '%Y-%m-%d') AS {name}"
        if kind == "t":
            return f"STRFTIME(CAST({name} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS {name}"
        return f"CAST({name} AS {_SQL[kind]}) AS {name}"

    return f"SELECT {', '.join(col(n, k) for n, k in _parse(spec))} FROM {source}"
