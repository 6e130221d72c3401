"""Continuously refreshed tables and event-time window replacement as streaming sinks."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.session import scratch_path
from ..sources import partitions
from ..sources.tables import remove_path


def _triggered(writer, lag: str | None):
    return writer.trigger(availableNow=True) if lag is None else writer.trigger(processingTime=lag)


def _stream_name(checkpoint: str) -> str:
    return f"s{zlib.crc32(checkpoint.encode()):08x}"


def maintain(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame],
             prepare: Callable[[DataFrame], DataFrame] = lambda df: df, lag: str | None = None,
             output_mode: str = "append", buckets: int = 64) -> StreamingQuery:
    """Keep the table at ``path`` up to date with a stream, at most ``lag`` behind.

    Each micro-batch is prepared (for example aggregated) and merged by ``keys`` into the
    buckets of the table that it touches; the other buckets' files stay. With
    ``output_mode='update'`` a stateful stream hands over changed rows only. The last batch
    of every stream is remembered with the table, so one that is retried after its commit
    is skipped, whoever changed the table in between, and merges may add
    (``merge_add``). Without ``lag`` the available input is processed once.
    """
    name = _stream_name(checkpoint)

    def apply(batch: DataFrame, batch_id: int) -> None:
        if partitions.applied(batch.sparkSession, path, name) < batch_id:
            partitions.merge_by_key(prepare(batch), path, keys, merge, buckets, (name, batch_id))

    writer = stream.writeStream.outputMode(output_mode).foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _triggered(writer, lag).start()


def latest_rows(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], event_time: str) -> DataFrame:
    """One row for each key: the one with the latest event time; of equal times the incoming one, then the one with the larger hash.

    A row with a null in its keys is told apart by all of its columns: as many equal ones
    stay as the side with more of them has, so that rows that come again add none.
    """
    columns = incoming.columns
    both = stored.select(*columns).withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    order = F.struct(event_time, "__new", F.xxhash64(*columns))
    last = both.filter(keyed).groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("__row")).select("__row.*")
    counts = both.filter(~keyed).groupBy(*columns, "__new").agg(F.count(F.lit(1)).alias("__n")).groupBy(*columns).agg(F.max("__n").alias("__n"))
    return last.unionByName(counts.select(*columns, F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("__n")).drop("__n"))


def replace_days(stream: DataFrame, path: str, checkpoint: str, event_time: str, keys: Sequence[str], day: str = "event_day",
                 lag: str | None = None) -> StreamingQuery:
    """Event-time window replacement: the days of a micro-batch are rebuilt from all of their rows.

    The table is partitioned by day. Only the days of the batch are read and rewritten,
    with the :func:`latest_rows` of what is stored and what comes. A day may come in any
    number of batches, and a retried batch changes nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, once = batch.sparkSession, scratch_path(batch.sparkSession, "days")
        batch.withColumn(day, F.to_date(event_time)).write.parquet(once)
        rows = spark.read.parquet(once)
        stored = partitions.read_parts(spark, path)
        part = rows.limit(0) if stored is None else partitions.within(stored, day, partitions.touched(rows, day))
        partitions.replace(latest_rows(part, rows, keys, event_time), path, day, whole=stored is None)
        remove_path(spark, once)

    return _triggered(stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint), lag).start()
