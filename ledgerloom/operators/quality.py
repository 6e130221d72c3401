"""Data tests: failing rows per check, thresholds, declared suites, row assertions and contracts."""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .relational import union_all


def _subset(df: DataFrame, where: str | Column | None) -> DataFrame:
    return df if where is None else df.filter(where)


def check_unique(df: DataFrame, column: str, where: str | Column | None = None) -> DataFrame:
    """Repeated values with their counts; nulls are not compared.

    Counting combines on the map side, so one frequent value is no hot spot.
    """
    return (_subset(df, where).filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def check_not_null(df: DataFrame, column: str, where: str | Column | None = None) -> DataFrame:
    """Rows without a value."""
    return _subset(df, where).filter(F.col(column).isNull())


def check_accepted(df: DataFrame, column: str, values: Sequence[Any], where: str | Column | None = None) -> DataFrame:
    """Values outside the list, with their counts; null is neither in nor out."""
    return (_subset(df, where).groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records")).filter(~F.col("value_field").isin(list(values))))


def check_fk(child: DataFrame, column: str, parent: DataFrame, key: str,
             where: str | Column | None = None) -> DataFrame:
    """Child values that no parent row has, one row per child row."""
    values = _subset(child, where).select(F.col(column).alias("from_field")).filter(F.col("from_field").isNotNull())
    keys = parent.select(F.col(key).alias("to_field")).filter(F.col("to_field").isNotNull())
    return values.join(keys, F.col("from_field") == F.col("to_field"), "left_anti")


# --- thresholds ------------------------------------------------------------------

_OPERATORS: dict[str, Callable] = {"!=": operator.ne, "<>": operator.ne, "=": operator.eq, "==": operator.eq,
                                   ">=": operator.ge, "<=": operator.le, ">": operator.gt, "<": operator.lt}


def threshold(text: str) -> Callable[[Column], Column]:
    """``'!= 0'`` or ``'> 10'`` as a condition on a count."""
    match = re.fullmatch(r"\s*(!=|<>|>=|<=|==|=|>|<)\s*(\d+)\s*", text)
    if not match:
        raise ValueError(f"not a threshold: {text!r}")
    compare, bound = _OPERATORS[match[1]], int(match[2])
    return lambda count: compare(count, F.lit(bound))


def run_check(failing: DataFrame, warn_if: str = "!= 0", error_if: str = "!= 0", limit: int | None = None,
              fail_calc: Column | None = None, store_as: str | None = None) -> DataFrame:
    """One row: failures, should_warn, should_error. ``store_as`` keeps the failing rows as a table.

    ``limit`` bounds the failing rows that are looked at; it is an option of the check.
    """
    if store_as:
        failing.write.mode("overwrite").saveAsTable(store_as)
    rows = failing if limit is None else failing.limit(limit)
    counted = rows.agg((fail_calc if fail_calc is not None else F.count(F.lit(1))).alias("failures"))
    return counted.select("failures", threshold(warn_if)(F.col("failures")).alias("should_warn"),
                          threshold(error_if)(F.col("failures")).alias("should_error"))


# --- suites ----------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One declared test of a model column.

    ``fail_calc`` is an aggregate over the failing rows, of which ``limit`` are looked at.
    A check of severity ``warn`` never gives an error.
    """

    model: str
    column: str
    kind: str  # unique | not_null | accepted_values | relationships
    where: str | None = None
    values: tuple = ()
    to: str | None = None
    field: str | None = None
    warn_if: str = "!= 0"
    error_if: str = "!= 0"
    severity: str = "error"
    fail_calc: str = "count(*)"
    limit: int | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown check {self.kind!r}")
        if self.severity not in ("error", "warn"):
            raise ValueError(f"unknown severity {self.severity!r}")

    def failing(self, models: Mapping[str, DataFrame]) -> DataFrame:
        df = models[self.model]
        if self.kind == "unique":
            return check_unique(df, self.column, self.where)
        if self.kind == "not_null":
            return check_not_null(df, self.column, self.where)
        if self.kind == "accepted_values":
            return check_accepted(df, self.column, self.values, self.where)
        return check_fk(df, self.column, models[self.to], self.field, self.where)

    @property
    def is_plain(self) -> bool:
        """Whether the number of failures follows from the counts of failing values alone."""
        return self.limit is None and self.fail_calc.replace(" ", "").lower() == "count(*)"

    def verdict(self, failures: Column) -> list[Column]:
        return [failures.alias("failures"), threshold(self.warn_if)(failures).alias("should_warn"),
                (threshold(self.error_if)(failures) & F.lit(self.severity == "error")).alias("should_error")]


KINDS = ("unique", "not_null", "accepted_values", "relationships")


def failing_values(spec: Sequence[Check], models: Mapping[str, DataFrame]) -> DataFrame:
    """check (its place in the list), value and n_records of all values that fail, from one pass over each model.

    Every row gives one (check, value) pair for each check it is looked at by; the pairs are
    counted, with partial counts before the shuffle, so a frequent value is no hot spot.
    Repeated values, values outside a list and missing values follow from the counts;
    references are compared with the distinct keys of the models they point to.
    """
    def pairs(model: str, checks: list[tuple[int, Check]]) -> DataFrame:
        wanted = []
        for number, check in checks:
            value = F.col(check.column).cast("string")
            seen = F.col(check.column).isNull() if check.kind == "not_null" else value.isNotNull()
            if check.kind == "accepted_values":
                seen = seen & ~F.col(check.column).isin(list(check.values))
            if check.where:
                seen = seen & F.coalesce(F.expr(check.where), F.lit(False))
            wanted.append(F.when(seen, F.struct(F.lit(number).alias("check"), value.alias("value"))))
        rows = models[model].select(F.explode(F.array(*wanted)).alias("p")).filter("p is not null")  # compacting the array is not compiled
        return rows.groupBy("p.check", "p.value").agg(F.count(F.lit(1)).alias("n_records"))

    by_model: dict[str, list[tuple[int, Check]]] = {}
    for number, check in enumerate(spec):
        by_model.setdefault(check.model, []).append((number, check))
    counted = union_all(*[pairs(model, checks) for model, checks in by_model.items()])
    unique = [n for n, c in enumerate(spec) if c.kind == "unique"]
    references = [n for n, c in enumerate(spec) if c.kind == "relationships"]
    repeated = F.col("check").isin(unique) & (F.col("n_records") > 1) if unique else F.lit(False)
    if not references:
        return counted.filter(repeated | ~F.col("check").isin(unique)) if unique else counted
    targets = sorted({(spec[n].to, spec[n].field) for n in references})
    place = F.lit(None).cast("int")
    for n in references:
        place = F.when(F.col("check") == n, F.lit(targets.index((spec[n].to, spec[n].field)))).otherwise(place)
    keys = union_all(*[models[model].select(F.lit(i).alias("__to"), F.col(field).cast("string").alias("__key")).distinct()
                       for i, (model, field) in enumerate(targets)]).filter("__key is not null")
    marked = counted.withColumn("__place", place).filter(F.col("__place").isNotNull() | repeated | ~F.col("check").isin(unique))
    # An anti join would be pushed into every branch of the union, with the keys read again in each.
    found = marked.join(keys, (F.col("__place") == F.col("__to")) & (F.col("value") == F.col("__key")), "left").filter("__key is null")
    return found.select("check", "value", "n_records")


def run_suite(spec: Sequence[Check], models: Mapping[str, DataFrame], store_as: str | None = None) -> DataFrame:
    """One row per check: model, column, kind, failures and verdicts.

    All plain checks come from :func:`failing_values`: each model is read once, and once
    more if others refer to it. Checks with a limit or a ``fail_calc`` of their own have one plan each.
    ``store_as`` keeps the failing values of the plain checks as a table.
    """
    plain, own = [c for c in spec if c.is_plain], [c for c in spec if not c.is_plain]
    parts = [run_check(c.failing(models), c.warn_if, c.error_if, c.limit, F.expr(c.fail_calc)).select(
        *_named(c), *c.verdict(F.coalesce("failures", F.lit(0)))) for c in own]
    if plain:
        failing = failing_values(plain, models)
        if store_as:
            failing.join(F.broadcast(_listed(failing.sparkSession, plain)), "check").drop("check").write.mode("overwrite").saveAsTable(store_as)
        # A repeated or unknown value is one failure, a missing value or reference one for each row.
        per_row = F.col("check").isin([n for n, c in enumerate(plain) if c.kind in ("not_null", "relationships")])
        sums = failing.groupBy("check").agg(F.sum(F.when(per_row, F.col("n_records")).otherwise(1)).alias("__n"))
        one_row = sums.agg(F.map_from_entries(F.collect_list(F.struct("check", "__n"))).alias("n"))  # one entry a check
        verdicts = F.array(*[F.struct(*_named(c), *c.verdict(F.coalesce(F.try_element_at("n", F.lit(i)), F.lit(0)))) for i, c in enumerate(plain)])
        parts.append(one_row.select(F.inline(verdicts)))
    return union_all(*parts)


def _named(check: Check) -> list[Column]:
    return [F.lit(check.model).alias("model"), F.lit(check.column).alias("column"), F.lit(check.kind).alias("check")]


def _listed(spark: SparkSession, spec: Sequence[Check]) -> DataFrame:
    return spark.createDataFrame([(i, c.model, c.column, c.kind) for i, c in enumerate(spec)], "check int, model string, column string, kind string")


# --- unit tests and contracts ----------------------------------------------------


def fixture(spark: SparkSession, schema: T.StructType, rows: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Typed rows from dictionaries; missing columns are null, unknown ones are refused."""
    names = schema.fieldNames()
    for row in rows:
        unknown = set(row) - set(names)
        if unknown:
            raise ValueError(f"fixture columns not in the schema: {sorted(unknown)}")
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], nullable)


def diff_rows(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows that only one side has (as often as it has them more), marked actual or expected."""
    columns = expected.columns
    left, right = actual.select(*columns), expected
    return (left.exceptAll(right).withColumn("actual_or_expected", F.lit("actual"))
            .unionByName(right.exceptAll(left).withColumn("actual_or_expected", F.lit("expected"))))


def assert_rows(actual: DataFrame, expected: DataFrame) -> None:
    """Raise when the two sides differ on the expected columns; shows a few of the differing rows."""
    sample = diff_rows(actual, expected).limit(20).collect()
    if sample:
        raise AssertionError("rows differ:\n" + "\n".join(str(r) for r in sample))


def contract_violations(df: DataFrame, schema: T.StructType) -> list[str]:
    """How the schema differs from the declared one in names, types or number of columns."""
    actual = {f.name: f.dataType for f in df.schema}
    declared = {f.name: f.dataType for f in schema}
    problems = [f"missing column {n}" for n in declared if n not in actual]
    problems += [f"unexpected column {n}" for n in actual if n not in declared]
    problems += [f"{n}: {actual[n].simpleString()} instead of {t.simpleString()}"
                 for n, t in declared.items() if n in actual and actual[n] != t]
    return problems


def check_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame in declared column order, or ``ValueError`` with every difference."""
    problems = contract_violations(df, schema)
    if problems:
        raise ValueError("contract broken: " + "; ".join(problems))
    return df.select(*schema.fieldNames())
