"""Incremental writes as functions ``(target, source) -> new target``.

Each function returns the new rows of the part of a table that it is given;
:func:`run_incremental` gives it the touched buckets and replaces only these.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POLICIES = ("ignore", "fail", "append_new_columns", "sync_all_columns")


def _condition(predicate: str | Column | None) -> Column | None:
    return F.expr(predicate) if isinstance(predicate, str) else predicate


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _no_nulls(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target rows and source rows."""
    return target.unionByName(source.select(*target.columns))


def update_columns(columns: Sequence[str], include: Sequence[str] | None = None,
                   exclude: Sequence[str] | None = None) -> list[str]:
    """Columns an upsert changes: the included ones, all but the excluded ones, or all."""
    if include and exclude:
        raise ValueError("give columns to update or columns to exclude, not both")
    if include:
        return list(include)
    skipped = {c.lower() for c in exclude or []}
    return [c for c in columns if c.lower() not in skipped]


def unique_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows with all keys set; a repeated key makes the job fail.

    The check is part of the plan: the rows are grouped by key, which an equi join on
    the key needs anyway, and a group of more than one row raises.
    """
    rest = [c for c in source.columns if c not in keys]
    keyed = source.filter(_no_nulls([F.col(k) for k in keys]))
    grouped = keyed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*rest) if rest else F.lit(1)).alias("__row"))
    message = F.concat(F.lit("duplicate source key: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    # The check guards the key too, so it also runs when no other column is read.
    guarded = {k: F.when(F.col("__n") == 1, F.col(k)).otherwise(
        F.raise_error(message).cast(source.schema[k].dataType)) for k in keys}
    columns = [guarded[c].alias(c) if c in keys else F.col("__row")[c].alias(c) for c in source.columns]
    return grouped.select(*columns)


def merge_upsert(target: DataFrame, source: DataFrame, keys: str | Sequence[str] | None,
                 update_cols: Sequence[str] | None = None, exclude_cols: Sequence[str] | None = None,
                 predicate: str | Column | None = None) -> DataFrame:
    """Update matched rows, insert the others; without keys everything is inserted.

    ``predicate`` (over target columns) limits which target rows can match, as an extra
    part of the merge condition. The target side is the left side of its join, so
    adaptive execution can split a key that owns many target rows; the insert side
    needs only the distinct keys of the target.
    """
    if not keys:
        return append(target, source)
    keys = _keys(keys)
    columns = target.columns
    changed = set(update_columns(columns, update_cols, exclude_cols))
    limit = _condition(predicate)
    candidate = F.lit(True) if limit is None else F.coalesce(limit, F.lit(False))
    rows = unique_source(source.select(*columns), keys)
    incoming = rows.select(*[F.col(c).alias(f"__s_{c}") for c in columns], F.lit(True).alias("__hit"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__s_{k}") for k in keys])
    marked = target.withColumn("__candidate", candidate)
    joined = marked.join(incoming, on & F.col("__candidate"), "left")
    updated = joined.select(*[
        F.when(F.col("__hit"), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
        for c in columns])
    present = marked.filter("__candidate").select(*keys).distinct()
    inserted = rows.join(present, keys, "left_anti").select(*columns)
    without_key = source.select(*columns).filter(~_no_nulls([F.col(k) for k in keys]))
    return updated.unionByName(inserted).unionByName(without_key)


def delete_insert(target: DataFrame, source: DataFrame, keys: str | Sequence[str] | None,
                  predicate: str | Column | None = None) -> DataFrame:
    """Delete the target rows whose key occurs in the source, then insert the source.

    With ``predicate`` only target rows that satisfy it are deleted.
    """
    if not keys:
        return append(target, source)
    keys = _keys(keys)
    limit = _condition(predicate)
    doomed = source.select(*[F.col(k).alias(f"__d_{k}") for k in keys]).distinct()
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__d_{k}") for k in keys])
    if limit is not None:
        on = on & F.coalesce(limit, F.lit(False))
    return append(target.join(doomed, on, "left_anti"), source)


def insert_overwrite(target: DataFrame, source: DataFrame, predicate: str | Column | None = None) -> DataFrame:
    """Replace the whole target, or only its rows that satisfy the predicate."""
    limit = _condition(predicate)
    if limit is None:
        return source.select(*target.columns)
    return append(target.filter(~F.coalesce(limit, F.lit(False))), source)


def _moment(value: str | dt.date | dt.datetime | None, like: Column) -> Column | None:
    return None if value is None else F.lit(str(value)).cast("timestamp_ntz")


def microbatch(target: DataFrame, source: DataFrame, event_time: str, start: str | dt.datetime | None,
               end: str | dt.datetime | None, predicate: str | Column | None = None) -> DataFrame:
    """Replace the target rows with event time in [start, end) by the source rows.

    A narrow filter and a union: no shuffle, and on a table partitioned by day only the
    partitions of the window are rewritten by the writer.
    """
    at = F.col(event_time)
    parts = [p for p in (
        None if start is None else at >= _moment(start, at),
        None if end is None else at < _moment(end, at), _condition(predicate)) if p is not None]
    if not parts:
        raise ValueError("a microbatch needs a start, an end or a predicate")
    return insert_overwrite(target, source, reduce(lambda a, b: a & b, parts))


# --- schema changes --------------------------------------------------------------


def schema_changes(source: DataFrame, target: DataFrame) -> dict[str, list]:
    """Columns added, columns removed and columns whose type differs."""
    src = {f.name: f.dataType for f in source.schema}
    dst = {f.name: f.dataType for f in target.schema}
    return {
        "added": [c for c in src if c not in dst],
        "removed": [c for c in dst if c not in src],
        "retyped": [(c, src[c].simpleString()) for c in src if c in dst and src[c] != dst[c]],
    }


def reconcile_schema(source: DataFrame, target: DataFrame, policy: str = "ignore") -> tuple[DataFrame, DataFrame]:
    """(source, target) brought to one schema by the policy; unknown policies mean ignore.

    * ignore: the target's columns win, extra source columns are dropped
    * fail: any difference raises
    * append_new_columns: source columns are added to the target, none is dropped
    * sync_all_columns: the target takes the source's columns and types
    """
    policy = policy if policy in POLICIES else "ignore"
    changes = schema_changes(source, target)
    if policy == "fail" and any(changes.values()):
        raise ValueError(f"source and target schemas differ: {changes}")

    def conform(df: DataFrame, fields) -> DataFrame:
        return df.select(*[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])

    if policy == "sync_all_columns":
        kept = [f for f in source.schema if f.name in target.columns]
        new = [f for f in source.schema if f.name not in target.columns]
        order = sorted(kept, key=lambda f: target.columns.index(f.name)) + new
        return conform(source, order), conform(target, order)
    fields = list(target.schema)
    if policy == "append_new_columns":
        fields += [f for f in source.schema if f.name in changes["added"]]
    elif changes["removed"]:
        missing = ", ".join(changes["removed"])
        raise ValueError(f"source lacks target columns: {missing}")
    return conform(source, fields), conform(target, fields)


# --- first run, refresh or increment ---------------------------------------------


def is_incremental(exists: bool, full_refresh: bool = False) -> bool:
    return exists and not full_refresh


def merge_add(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the source's other columns to those of the target's row with the same keys; new keys become rows."""
    totals = [c for c in target.columns if c not in keys]
    summed = target.unionByName(source).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in totals))
    return summed.select(*(F.col(f.name).cast(f.dataType) for f in target.schema))


def run_incremental(spark: SparkSession, path: str, build: Callable[[bool], DataFrame],
                    strategy: Callable[[DataFrame, DataFrame], DataFrame], keys: str | Sequence[str] | None = None,
                    full_refresh: bool = False, on_schema_change: str = "ignore", buckets: int = 64) -> DataFrame:
    """Build the table on the first run or a full refresh, else apply the strategy to its stored rows.

    ``build`` is told whether the run is incremental, so it can read new rows only. A table
    with ``keys`` is dealt to buckets by them, and a run rewrites only the buckets of its
    rows; the strategy then gets the stored rows of these. Without keys, and when its
    schema changes, the whole table is rewritten.
    """
    from ..sources import partitions

    keys = _keys(keys) if keys else []
    current = partitions.read_table(spark, path)
    incremental = is_incremental(current is not None, full_refresh)
    source = build(incremental)
    rows = source
    if incremental:
        source, current_now = reconcile_schema(source, current, on_schema_change)
        if keys and current_now.schema == current.schema:
            partitions.merge_by_key(source, path, keys, strategy)
            return partitions.read_table(spark, path)
        rows = strategy(current_now, source)
    if keys:
        rows = partitions.with_bucket(rows, keys, buckets)
    partitions.replace(rows, path, partitions.bucket_column(rows) if keys else None, whole=True)
    return partitions.read_table(spark, path)
