"""Plain partitioned Parquet tables of which a change rewrites only the partitions it touches.

A table that changes by key is partitioned by a bucket of the key; one that changes by time, by
day. A change reads the touched partitions, writes their new rows to a folder beside the table and
then replaces them by dynamic partition overwrite, which drops the replaced files and leaves all
others alone. A run that ends in between leaves the complete rows beside the table: the next change
puts them in place first, so nothing is lost or applied twice. One change of a table runs at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.session import scratch_path
from .tables import child_folders, make_folder, path_exists, remove_path

# Name of a bucket column; the number of buckets follows it, so a table tells how it was dealt.
BUCKET = "bucket_of_"


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(f"{BUCKET}{buckets}", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def bucket_column(df: DataFrame) -> str:
    return next(c for c in df.columns if c.startswith(BUCKET))


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of a table without its bucket column, or None before its first run."""
    stored = read_parts(spark, path)
    return None if stored is None else stored.drop(*[c for c in stored.columns if c.startswith(BUCKET)])


def read_parts(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows with their partition columns; an unfinished change is put in place first."""
    _finish(spark, path)
    return spark.read.parquet(path) if path_exists(spark, f"{path}/_SUCCESS") else None


def touched(rows: DataFrame, by: str) -> list[Any]:
    """The partitions that some rows fall into: at most one value a bucket or a day."""
    return [r[0] for r in rows.select(by).distinct().collect()]


def within(stored: DataFrame, by: str, values: Sequence[Any]) -> DataFrame:
    """The stored rows of these partitions: a literal filter, so that other folders are not even listed."""
    known = [v for v in values if v is not None]
    wanted = F.col(by).isin(known) if known else F.lit(False)
    return stored.filter(wanted | F.col(by).isNull() if len(known) < len(values) else wanted)


def replace(rows: DataFrame, path: str, by: str | None, whole: bool = False, batch: tuple[str, int] | None = None) -> None:
    """Make ``rows`` the content of the partitions they fall into, or of the whole table.

    Tasks get rows of one partition, a large one is split. ``batch`` (stream, number) is
    remembered as applied together with the change. Without ``by`` the table has no
    partitions and changes as a whole.
    """
    stream, number = batch or ("", 0)
    waiting = "~".join([by or "", "whole" if whole or not by else "parts", stream, str(number)])
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}.pending/{waiting}")
    _finish(rows.sparkSession, path)


def _finish(spark: SparkSession, path: str) -> None:
    """Put complete rows that wait beside the table in place; doing so again changes nothing."""
    pending = f"{path.rstrip('/')}.pending"
    for folder in child_folders(spark, pending):
        if not path_exists(spark, f"{folder}/_SUCCESS"):
            continue
        by, extent, stream, number = folder.rsplit("/", 1)[-1].split("~")
        writer = spark.read.parquet(folder)
        writer = (writer.hint("rebalance", F.col(by)) if by else writer).write.mode("overwrite")
        keep = extent == "parts" and path_exists(spark, f"{path}/_SUCCESS")
        writer = writer.option("partitionOverwriteMode", "dynamic" if keep else "static")
        (writer.partitionBy(by) if by else writer).parquet(path)
        if stream:
            _remember(spark, path, stream, int(number))
    remove_path(spark, pending)


def applied(spark: SparkSession, path: str, stream: str) -> int:
    """Number of the last batch of a stream that the table includes; -1 for none."""
    _finish(spark, path)
    marks = [f.rsplit("/", 1)[-1] for f in child_folders(spark, f"{path.rstrip('/')}.applied")]
    return max((int(m.rpartition("=")[2]) for m in marks if m.rpartition("=")[0] == stream), default=-1)


def _remember(spark: SparkSession, path: str, stream: str, number: int) -> None:
    marks = f"{path.rstrip('/')}.applied"
    make_folder(spark, f"{marks}/{stream}={number}")
    for folder in child_folders(spark, marks):
        name, _, other = folder.rsplit("/", 1)[-1].rpartition("=")
        if name == stream and int(other) < number:
            remove_path(spark, folder)


def merge_by_key(source: DataFrame, path: str, keys: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame],
                 buckets: int = 64, batch: tuple[str, int] | None = None) -> None:
    """Merge rows into a table dealt by key: ``merge`` gets the stored rows of the touched buckets and the source.

    The first rows of a table are written as they are, in ``buckets`` buckets; later
    changes follow the number of the table. A merge keeps the keys of its rows and loses
    none of the source's. The source is computed once, whatever the merge reads of it.
    """
    spark = source.sparkSession
    stored = read_parts(spark, path)
    if stored is None:
        dealt = with_bucket(source, keys, buckets)
        return replace(dealt, path, bucket_column(dealt), whole=True, batch=batch)
    by = bucket_column(stored)
    buckets = int(by.removeprefix(BUCKET))
    once = scratch_path(spark, "change")
    with_bucket(source, keys, buckets).write.parquet(once)
    change = spark.read.parquet(once)
    values = touched(change, by)
    if values:
        part = within(stored, by, values).drop(by)
        replace(with_bucket(merge(part, change.drop(by)), keys, buckets), path, by, batch=batch)
    elif batch:
        _remember(spark, path, *batch)
    remove_path(spark, once)
