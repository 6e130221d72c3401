"""File-arrival ingestion: every landed file is loaded exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import Check, run_suite
from ..operators.session import scratch_path
from ..sources import landing
from ..sources.tables import remove_path


def land_files(spark: SparkSession, path: str, target: str, checkpoint: str, pattern: str = "*.jsonl.gz",
               max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Load the files that arrived since the last run into a Parquet landing table, then stop.

    The checkpoint is the load history. The text of a micro-batch is scanned and parsed
    once, into a scratch table of documents; the splits are judged and the lines numbered
    from its narrow columns. A file with a line that is not JSON contributes no row. The
    batch id is a partition of the target and replaced as a whole, so a retried batch does
    not load twice.
    """
    lines = landing.with_split(
        spark.readStream.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files_per_trigger).load(path))

    def load(batch: DataFrame, batch_id: int) -> None:
        session, parsed = batch.sparkSession, scratch_path(batch.sparkSession, "parsed")
        judged = landing.judged(batch.withColumn("seq", F.monotonically_increasing_id())).drop("value")
        judged.write.parquet(parsed)
        rows = landing.to_landing(session.read.schema(judged.schema).parquet(parsed))
        rows.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={batch_id}")
        remove_path(session, parsed)

    return (lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def landed(spark: SparkSession, target: str) -> DataFrame:
    """Landing rows of :func:`land_files`: file, row number, ingest time and parsed document."""
    return spark.read.parquet(target).drop("batch")


def quality_gate(batch: DataFrame, name: str, checks: list[Check]) -> bool:
    """Whether a micro-batch passes its declared checks (one small result row per check)."""
    return run_suite(checks, {name: batch}).filter("should_error").isEmpty()
