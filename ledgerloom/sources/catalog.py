"""Tenant-scoped sources and seeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SOURCE_GROUPS, STAGING, tables_of
from .landing import load_raw, raw_path
from .staging import stage


class Catalog:
    """Resolves (group, table) of one tenant to lazy landing or staged DataFrames.

    The database name is ``{TENANT}_{ENV}_RAW``. Tables are read from it when
    ``use_tables`` is set, else from the landing folders below ``base``.
    """

    def __init__(self, spark: SparkSession, tenant: str, env: str, base: str | None = None,
                 use_tables: bool = False, number_scale: int = 0, pattern: str = "*.jsonl.gz"):
        self.spark, self.tenant, self.env, self.base = spark, tenant, env, base
        self.use_tables, self.number_scale, self.pattern = use_tables, number_scale, pattern

    @property
    def database(self) -> str:
        return f"{self.tenant}_{self.env}_RAW".upper()

    def groups(self) -> list[str]:
        return list(SOURCE_GROUPS)

    def tables(self, group: str) -> list[str]:
        return tables_of(group)

    def source(self, group: str, table: str, run_date: str | None = None) -> DataFrame:
        """Landing rows of a table, or of one of its run dates (only that folder is listed)."""
        full = f"{SOURCE_GROUPS[group]}_{table}"
        if full not in STAGING:
            raise KeyError(f"no table {table!r} in source {group!r}")
        if self.use_tables:
            return self.spark.table(f"{self.database}.{full}")
        return load_raw(self.spark, raw_path(self.tenant, group, table, run_date, base=self.base or "."),
                        pattern=self.pattern)

    def staged(self, group: str, table: str, run_date: str | None = None) -> DataFrame:
        return stage(f"{SOURCE_GROUPS[group]}_{table}", self.source(group, table, run_date), self.number_scale)


# Types a seed column may get, narrowest first: type and the form all of its values must have.
SEED_TYPES = (
    ("boolean", r"(?i)(true|false)"),
    ("bigint", r"[+-]?(0|[1-9]\d{0,17})"),
    ("double", r"[+-]?(0|[1-9]\d{0,14})?(\.\d+)?([eE][+-]?\d+)?"),
    ("date", r"\d{4}-\d{2}-\d{2}"),
    ("timestamp_ntz", r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?"),
)


def infer_types(rows: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """For each text column the narrowest type that all of its values fit; text when none does or all are null.

    A value fits a type when it has its form and can be cast, so numbers with leading
    zeros or more than 18 digits, such as account codes, stay text. One aggregate over all rows decides on
    every column and type.
    """
    def fits(column: str, kind: str, form: str) -> Column:
        value = F.col(f"`{column}`")
        good = F.regexp_like(value, F.lit(f"^(?:{form})$")) & value.try_cast(kind).isNotNull()
        return F.bool_and(F.when(value.isNotNull(), good))

    if not columns:
        return {}
    found = rows.agg(F.struct(*[F.struct(*[fits(c, kind, form).alias(kind) for kind, form in SEED_TYPES]).alias(f"c{i}")
                                for i, c in enumerate(columns)]).alias("fit")).first()["fit"]
    return {c: next((kind for kind, _ in SEED_TYPES if found[f"c{i}"][kind]), "string") for i, c in enumerate(columns)}


def load_seed(spark: SparkSession, path: str, column_types: dict[str, str] | None = None, infer: bool = True) -> DataFrame:
    """Seed CSV with a header; columns without a declared type get the one that :func:`infer_types` finds.

    Empty fields are null. With ``infer=False`` undeclared columns stay text and the file is read once.
    """
    rows = spark.read.option("header", "true").option("escape", '"').csv(path)
    declared = column_types or {}
    types = (infer_types(rows, [c for c in rows.columns if c not in declared]) if infer else {}) | declared
    return rows.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in types.items() if t != "string"})
