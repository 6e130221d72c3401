"""Session settings and lineage cuts the operators rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Joins on business keys may meet a key that holds a large share of the rows. Adaptive
# execution then splits that key's shuffle partition over many tasks.
# Moments are UTC wherever a session runs.
TUNING = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Tables of many keys and texts: hashed keys alone take half of the bytes that they do by default.
    "spark.sql.parquet.compression.codec": "zstd",
}

# Where every partition of a join's smaller side turns out this small, it is hashed and neither side is sorted.
HASHED = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


def tune(spark: SparkSession, hashed: bool = False) -> SparkSession:
    """Apply the runtime settings above; everything else is left to the cluster.

    With ``hashed``, as the models ask for, joins with small partitions on one side are not sorted.
    """
    for key, value in (TUNING | {HASHED: "64MB" if hashed else "0"}).items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only where none is named and the session is local.

    On a cluster without a named folder this raises: executors would write to their own
    disks, and reads would miss what others wrote.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named is None and current is None and not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if current is None:
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="ledgerloom-checkpoint-"))
    return named or context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet below the shared checkpoint folder and continue from there.

    Used where one result (the identity map, the user map) feeds many models: it is
    computed once, later joins read only the columns they need and know its size, and
    lost executors re-read files instead of recomputing. The quick codec is named, as the size
    of the files decides on broadcasts.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path, compression="snappy")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder, for tables and stream state of one run."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
