"""Portable type names and the Spark types they stand for."""

from __future__ import annotations

from pyspark.sql import types as T

PORTABLE_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "float": T.DoubleType(),
    "numeric": T.DecimalType(28, 6),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}


def portable_type(name: str) -> T.DataType:
    """Spark type of a portable name; raises ``KeyError`` for unknown names."""
    return PORTABLE_TYPES[name.lower()]
