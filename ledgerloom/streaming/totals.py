"""Daily product-event totals kept current as events arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.aggregates import sum_where
from ..functions.scalars import contains_any_ci
from ..plans.params import THRESHOLDS, Thresholds

CUSTOMER = "master_customer_id"
PART_KEYS = ["event_date", CUSTOMER, "user_identifier", "event_name"]


def stream_user_days(events: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Event counts of a stream per day, customer, user and event name.

    ``events`` has customer, ``event_id``, ``event_name``, ``user_identifier`` and
    ``timestamp``. A repeated event id within the lateness is dropped first, so counting
    rows is counting distinct events. Every state row is one small count and a busy
    customer-day is spread over its users; the watermark bounds the state. Events later
    than it are not in the counts; :func:`late_events` tells how many. Start the query after
    :func:`keep_state_on_disk`, so that the state is not bound by the executors' memory.
    """
    unique = events.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["event_id"])
    parts = unique.groupBy(F.window("timestamp", "1 day").alias("w"), CUSTOMER, "user_identifier",
                           "event_name").agg(F.count("event_id").alias("n_events"))
    return parts.select(F.col("w.start").cast("date").alias("event_date"), *PART_KEYS[1:], "n_events")


def keep_state_on_disk(spark: SparkSession) -> None:
    """State of streams started from now on lives in RocksDB on the executors' disks, with its changes in the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def late_events(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """batch, watermark and late: the events that each batch of a :func:`stream_user_days` query left out, as its progress tells.

    The stream drops late events before anything else that keeps state, so that its first
    such step counts them all. A session keeps as many batches as
    ``spark.sql.streaming.numRecentProgressUpdates`` says; append the rows to a table to keep more.
    """
    rows = [(p.batchId, p.eventTime.get("watermark"), p.stateOperators[-1].numRowsDroppedByWatermark) for p in query.recentProgress if p.stateOperators]
    return spark.createDataFrame(rows, "batch long, watermark string, late long")


def totals_of(parts: DataFrame, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Daily totals per customer from the counts of :func:`stream_user_days`."""
    key_action = contains_any_ci("event_name", list(thresholds.key_action_words))
    return parts.groupBy(CUSTOMER, "event_date").agg(
        F.sum("n_events").alias("daily_events"), F.count_distinct("event_name").alias("daily_unique_event_types"),
        sum_where(key_action, "n_events").alias("daily_key_actions"),
        F.count_distinct("user_identifier").alias("daily_active_users"))
