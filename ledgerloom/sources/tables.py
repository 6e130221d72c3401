"""Sinks: tables, views, JSON-lines batches, segment exports and clones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _clustered(df: DataFrame, cluster_by: Sequence[str] | None) -> DataFrame:
    if not cluster_by:
        return df
    return df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)


def write_table(df: DataFrame, name: str, cluster_by: Sequence[str] | None = None, fmt: str = "parquet",
                partition_by: Sequence[str] | None = None, buckets: tuple[int, Sequence[str]] | None = None,
                mode: str = "overwrite", path: str | None = None) -> DataFrame:
    """Materialize as a catalog table (at ``path`` when given) and read it back.

    ``cluster_by`` range-partitions and sorts, so readers skip row groups; ``buckets``
    co-locates later joins. Formats other than Parquet need their data source on the
    class path.
    """
    writer = _clustered(df, cluster_by).write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        count, keys = buckets
        writer = writer.bucketBy(count, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    try:
        writer.saveAsTable(name)
    except Exception as error:  # the missing source surfaces as a JVM error
        if "DATA_SOURCE_NOT_FOUND" in str(error):
            raise ValueError(f"table format {fmt!r} needs its data source on the class path") from error
        raise
    return df.sparkSession.table(name)


def write_path(df: DataFrame, path: str, cluster_by: Sequence[str] | None = None,
               partition_by: Sequence[str] | None = None, mode: str = "overwrite") -> DataFrame:
    """Materialize as Parquet files and read them back."""
    writer = _clustered(df, cluster_by).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a lazy DataFrame for SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_jsonl(df: DataFrame, path: str, run_date: str, force: bool = False) -> bool:
    """Write gzip JSON lines of one run date below ``path``; the job adds a completion marker.

    An existing run date is left alone unless ``force``. Returns whether rows were written.
    """
    target = f"{path.rstrip('/')}/run_date={run_date}"
    if not force and path_exists(df.sparkSession, f"{target}/_SUCCESS"):
        return False
    df.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", "false").json(target)
    return True


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on any file system Spark knows."""
    files, hadoop = _file_system(spark, path)
    return files.exists(hadoop)


def make_folder(spark: SparkSession, path: str) -> None:
    files, hadoop = _file_system(spark, path)
    files.mkdirs(hadoop)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder and what it holds; nothing happens when it does not exist."""
    files, hadoop = _file_system(spark, path)
    files.delete(hadoop, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path (none when it does not exist)."""
    files, hadoop = _file_system(spark, path)
    if not files.exists(hadoop):
        return []
    return [s.getPath().toString() for s in files.listStatus(hadoop) if s.isDirectory()]


def export_segment(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the activation segment for downstream readers."""
    df.write.format(fmt).mode("overwrite").save(path)


def clone_table(spark: SparkSession, src: str, dst: str, path: str | None = None) -> DataFrame:
    """Deep copy of a table under another name."""
    return write_table(spark.table(src), dst, path=path)


def with_loaded_at(df: DataFrame, name: str, at: str) -> DataFrame:
    """Add the load time of a run as an audit column; the caller names one time per run."""
    return df.withColumn(name, F.lit(at).cast("timestamp"))
