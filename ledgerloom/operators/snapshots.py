"""Slowly changing dimensions: row versions with a validity interval.

``snapshot_apply(current, source) -> next`` joins only the open versions to the
source; closed versions pass through a narrow filter untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import scd_hash

# Names of the bookkeeping columns.
COLUMN_NAMES = {"valid_from": "dbt_valid_from", "valid_to": "dbt_valid_to", "scd_id": "dbt_scd_id",
                "updated_at": "dbt_updated_at", "is_deleted": "dbt_is_deleted"}
HARD_DELETES = ("ignore", "invalidate", "new_record")


@dataclass(frozen=True)
class Snapshot:
    """How versions of a table are kept.

    ``strategy`` is ``timestamp`` (a later ``updated_at`` is a change) or ``check`` (any
    of ``check_cols`` differs; ``all`` checks every source column). ``now`` is the run
    time, explicit so that runs can be repeated; the check strategy without
    ``updated_at`` stamps versions with it. ``valid_to_current`` is the open end, null
    by default. With ``match_history`` a version whose hash any version has, closed
    ones too, is not added again; without it only the open one counts.
    """

    key: str | Sequence[str]
    strategy: str = "timestamp"
    updated_at: str | None = None
    check_cols: str | Sequence[str] = "all"
    hard_deletes: str = "ignore"
    now: str | None = None
    valid_to_current: str | None = None
    match_history: bool = False
    columns: dict[str, str] = field(default_factory=lambda: dict(COLUMN_NAMES))

    def __post_init__(self):
        if self.strategy not in ("timestamp", "check"):
            raise ValueError(f"unknown strategy {self.strategy!r}")
        if self.hard_deletes not in HARD_DELETES:
            raise ValueError(f"unknown hard_deletes {self.hard_deletes!r}")
        if self.strategy == "timestamp" and not self.updated_at:
            raise ValueError("the timestamp strategy needs updated_at")
        if self.now is None and (self.hard_deletes != "ignore" or not self.updated_at):
            raise ValueError("now is needed to stamp checks and deletions")

    @property
    def keys(self) -> list[str]:
        return [self.key] if isinstance(self.key, str) else list(self.key)

    def stamp(self) -> Column:
        return F.lit(self.now).cast("timestamp_ntz")

    def changed_at(self) -> Column:
        return F.col(self.updated_at).cast("timestamp_ntz") if self.updated_at else self.stamp()

    def open_end(self) -> Column:
        return F.lit(self.valid_to_current).cast("timestamp_ntz")

    def is_open(self) -> Column:
        end = F.col(self.columns["valid_to"])
        return end.isNull() if self.valid_to_current is None else end.isNull() | (end == self.open_end())


def _version(df: DataFrame, spec: Snapshot, names: Sequence[str]) -> DataFrame:
    """Source rows as new open versions."""
    c = spec.columns
    stamp = [F.col(spec.updated_at)] if spec.updated_at else [spec.stamp()]
    added = [scd_hash(*spec.keys, *stamp).alias(c["scd_id"]), spec.changed_at().alias(c["updated_at"]),
             spec.changed_at().alias(c["valid_from"]), spec.open_end().alias(c["valid_to"])]
    if spec.hard_deletes == "new_record":
        added.append(F.lit("False").alias(c["is_deleted"]))
    return df.select(*names, *added)


def snapshot_init(source: DataFrame, spec: Snapshot) -> DataFrame:
    """First build: every source row is an open version."""
    return _version(source, spec, source.columns)


def _changed(spec: Snapshot, source: DataFrame, current: DataFrame) -> Column:
    """Whether an open version (``o_``) and its source row (``s_``) differ."""
    if spec.strategy == "timestamp":
        return F.coalesce(F.col(f"__o_{spec.columns['valid_from']}") < F.col("__s___changed_at"), F.lit(False))
    wanted = source.columns if spec.check_cols == "all" else list(spec.check_cols)
    if any(c not in current.columns for c in wanted):
        return F.lit(True)
    return reduce(lambda a, b: a | b, [~F.col(f"__o_{c}").eqNullSafe(F.col(f"__s_{c}")) for c in wanted])


def snapshot_changes(current: DataFrame, source: DataFrame, spec: Snapshot) -> DataFrame:
    """Open versions and source rows side by side, with the change of each key.

    ``change`` is insert, update, delete or keep. The join is a full outer join on the
    key, of which both sides have one row per key.
    """
    opened = current.filter(spec.is_open()).select(*[F.col(c).alias(f"__o_{c}") for c in current.columns])
    rows = source.withColumn("__changed_at", spec.changed_at())
    incoming = rows.select(*[F.col(c).alias(f"__s_{c}") for c in rows.columns])
    on = reduce(lambda a, b: a & b, [F.col(f"__o_{k}") == F.col(f"__s_{k}") for k in spec.keys])
    both = opened.join(incoming, on, "full_outer")
    has_open = F.col(f"__o_{spec.columns['scd_id']}").isNotNull()
    has_source = F.col("__s___changed_at").isNotNull() | reduce(
        lambda a, b: a | b, [F.col(f"__s_{k}").isNotNull() for k in spec.keys])
    change = (F.when(~has_open, "insert").when(~has_source, "delete")
              .when(_changed(spec, source, current), "update").otherwise("keep"))
    return both.withColumn("change", change)


def snapshot_apply(current: DataFrame, source: DataFrame, spec: Snapshot) -> DataFrame:
    """Close changed and deleted versions, add new ones, keep the rest.

    Every joined row is turned into its zero, one or two result rows by one explode, so
    the source and the open versions are read and shuffled once. A new version whose
    hash equals the open one is not added. With ``new_record`` a deletion is a version
    of its own with the deleted flag set; as in the model, a key that stays absent gets
    one per run.
    """
    c = spec.columns
    names = [n for n in source.columns]
    columns = list(current.columns) + [n for n in names if n not in current.columns]
    types = {f.name: f.dataType for f in source.schema} | {f.name: f.dataType for f in current.schema}
    changes = snapshot_changes(current, source, spec)
    delete_mode = spec.hard_deletes

    def row(values: dict[str, Column]) -> Column:
        return F.struct(*[values.get(n, F.lit(None)).cast(types[n]).alias(n) for n in columns])

    old = {n: F.col(f"__o_{n}") for n in current.columns}
    keep = row(old)
    stamp_col = F.col(f"__s_{spec.updated_at}") if spec.updated_at else spec.stamp()
    new_hash = scd_hash(*[F.col(f"__s_{k}") for k in spec.keys], stamp_col)
    changed_at = F.col("__s___changed_at")
    new_values = {n: F.col(f"__s_{n}") for n in names} | {
        c["scd_id"]: new_hash, c["updated_at"]: changed_at, c["valid_from"]: changed_at,
        c["valid_to"]: spec.open_end()}
    gone_values = {n: old[n] for n in names if n in old} | {
        c["scd_id"]: scd_hash(old[c["scd_id"]], spec.stamp()), c["updated_at"]: spec.stamp(),
        c["valid_from"]: spec.stamp(), c["valid_to"]: old[c["valid_to"]]}
    if delete_mode == "new_record":
        new_values[c["is_deleted"]] = F.lit("False")
        gone_values[c["is_deleted"]] = F.lit("True")
    closed = row(old | {c["valid_to"]: changed_at})
    ended = row(old | {c["valid_to"]: spec.stamp()})
    new, gone = row(new_values), row(gone_values)
    is_new_hash = ~new_hash.eqNullSafe(old[c["scd_id"]])
    if delete_mode == "ignore":
        on_delete = F.array(keep)
    elif delete_mode == "invalidate":
        on_delete = F.array(ended)
    else:
        on_delete = F.array(ended, gone)
    results = (F.when(F.col("change") == "insert", F.array(new))
               .when(F.col("change") == "delete", on_delete)
               .when(F.col("change") == "update", F.when(is_new_hash, F.array(closed, new)).otherwise(
                   F.array(closed)))
               .otherwise(F.array(keep)))
    history = current.filter(~spec.is_open())
    if spec.match_history:
        changes = _seen_before(changes, history, new_hash, c["scd_id"])
        results = F.when(F.col("__seen") & (F.col("change") == "insert"), F.array().cast(T.ArrayType(T.StructType(
            [T.StructField(n, types[n]) for n in columns])))).when(F.col("__seen") & (F.col("change") == "update"), F.array(closed)).otherwise(results)
    next_open = changes.select(F.inline(results))
    extra = {n: F.lit(None).cast(types[n]) for n in columns if n not in current.columns}
    return history.withColumns(extra).select(*columns).unionByName(next_open) if extra else (
        history.unionByName(next_open))


def _seen_before(changes: DataFrame, history: DataFrame, new_hash: Column, scd_id: str) -> DataFrame:
    """Changes with ``__seen``: whether a closed version has the hash of a new one.

    Only inserts and updates are looked up, so the few of them make a runtime filter for
    the ids of the history, which is read in this one column.
    """
    hashed = changes.withColumn("__hash", F.when(F.col("change").isin("insert", "update"), new_hash))
    wanted = hashed.filter("__hash is not null").select("__hash").distinct()
    old = history.select(F.col(scd_id).alias("__old")).join(wanted, F.col("__old") == F.col("__hash"), "left_semi").distinct()
    return hashed.join(old, F.col("__hash") == F.col("__old"), "left").withColumn("__seen", F.col("__old").isNotNull()).drop("__hash", "__old")


def snapshot_run(current: DataFrame | None, source: DataFrame, spec: Snapshot) -> DataFrame:
    """First build or next version of a snapshot table."""
    return snapshot_init(source, spec) if current is None else snapshot_apply(current, source, spec)
