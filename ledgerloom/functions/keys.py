"""Surrogate keys, version hashes and prefixed identifiers.

Every helper returns a :class:`Column`, so keys are computed inside whole-stage
codegen and never need a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results must equal keys already stored by existing users.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
SCD_SEPARATOR = "|"

STRIPE_PREFIX = "STRIPE:"
INTACCT_PREFIX = "INTACCT:"
ZENDESK_PREFIX = "ZENDESK:"


def _col(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def surrogate_key(*columns: str | Column) -> Column:
    """MD5 over the columns as text, joined by ``-``; nulls become a fixed placeholder."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_PLACEHOLDER)) for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def scd_hash(*columns: str | Column) -> Column:
    """MD5 over the columns as text, joined by ``|``; nulls become the empty string."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(SCD_SEPARATOR, *parts))


def hash_value(column: str | Column) -> Column:
    """MD5 of one value as text (null stays null)."""
    return F.md5(_col(column).cast("string"))


def prefixed(prefix: str, column: str | Column) -> Column:
    """``prefix || column``; null when the column is null."""
    return F.concat(F.lit(prefix), _col(column))
