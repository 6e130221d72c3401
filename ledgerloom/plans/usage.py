"""Product usage: daily activity, rolling 30-day metrics, stickiness and trend."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import as_date, trailing_days
from ..functions.keys import surrogate_key
from ..functions.scalars import contains_any_ci, flag, ratio, zero_if_null
from ..operators.relational import attribute, distinct_deltas, rolling_distinct
from .finance import CUSTOMER, with_customer_name
from .params import THRESHOLDS, Thresholds

DAY = "event_date"
TOTALS = ["daily_events", "daily_unique_event_types", "daily_key_actions", "daily_active_users"]


def customer_dates(customers: DataFrame, spine: DataFrame) -> DataFrame:
    """Dense customer x date grid; the spine is a fixed number of days, so it is broadcast."""
    return customers.select(CUSTOMER).distinct().crossJoin(F.broadcast(spine))


def mapped_events(events: DataFrame, users: DataFrame, start: str | dt.date) -> DataFrame:
    """Events from ``start`` on with the customer of their user.

    The date filter is on the raw timestamp, so it reaches the scan.
    """
    first = F.lit(as_date(start)).cast("timestamp_ntz")
    recent = events.filter(F.col("timestamp") >= first).select(
        F.col("distinct_id").alias("user_identifier"), "event_id", "event_name", "timestamp")
    owners = users.select(F.col("user_identifier").alias("__user"), CUSTOMER)
    return attribute(recent, owners, "user_identifier", "__user").withColumn(DAY, F.col("timestamp").cast("date"))


def daily_parts(mapped: DataFrame, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Distinct events, event types, key actions and users per customer and day, in two rows to be summed.

    Rows are reduced to events, and to pairs of user and event type, before anything is
    counted: a busy customer-day is spread over tasks by these values, and the distinct
    counts that are left read only the pairs.
    """
    key_action = contains_any_ci("event_name", list(thresholds.key_action_words))
    events = mapped.groupBy(CUSTOMER, DAY, "event_id").agg(F.bool_or(key_action).alias("is_key")).groupBy(CUSTOMER, DAY).agg(
        F.count("event_id").alias("daily_events"),
        F.count_if(F.col("is_key") & F.col("event_id").isNotNull()).alias("daily_key_actions"))
    pairs = mapped.select(CUSTOMER, DAY, "event_name", "user_identifier").distinct().groupBy(CUSTOMER, DAY).agg(
        F.count_distinct("event_name").alias("daily_unique_event_types"),
        F.count_distinct("user_identifier").alias("daily_active_users"))
    return events.unionByName(pairs, allowMissingColumns=True)


def daily_totals(mapped: DataFrame, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """The sums of :func:`daily_parts`: one row per customer and day."""
    return daily_parts(mapped, thresholds).groupBy(CUSTOMER, DAY).agg(*[zero_if_null(F.sum(c)).alias(c) for c in TOTALS])


def active_user_days(events: DataFrame, users: DataFrame, start: str | dt.date) -> DataFrame:
    """Distinct (customer, user, day) from ``start`` on.

    Events are reduced to user-days before the user map is joined; a user has one
    customer, so the rows stay distinct.
    """
    first = F.lit(as_date(start)).cast("timestamp_ntz")
    days = events.filter(F.col("timestamp") >= first).select(
        F.col("distinct_id").alias("user_identifier"), F.col("timestamp").cast("date").alias(DAY)).distinct()
    owners = users.select(F.col("user_identifier").alias("__user"), CUSTOMER)
    return attribute(days, owners, "user_identifier", "__user").select(CUSTOMER, DAY, "user_identifier")


def densify(grid: DataFrame, totals: DataFrame) -> DataFrame:
    """Daily totals on every grid day, zero where nothing happened."""
    rows = grid.join(totals, [CUSTOMER, DAY], "left")
    return rows.select(CUSTOMER, DAY, *[zero_if_null(c).alias(c) for c in TOTALS])


def rolling_metrics(dense: DataFrame, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Trailing and previous window sums; a customer has a fixed number of grid days."""
    return dense.withColumns(_rolling(thresholds.rolling_days))


def _rolling(days: int) -> dict[str, Column]:
    ordered = Window.partitionBy(CUSTOMER).orderBy(DAY)
    current, previous = ordered.rowsBetween(1 - days, 0), ordered.rowsBetween(1 - 2 * days, -days)
    return {
        "total_events_30d": F.sum("daily_events").over(current),
        "key_actions_30d": F.sum("daily_key_actions").over(current),
        "active_days_30d": F.sum(flag(F.col("daily_events") > 0)).over(current),
        "total_events_prev_30d": F.sum("daily_events").over(previous),
    }


def rolling_mau(active: DataFrame, grid: DataFrame, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Distinct users of the trailing window per customer and grid day, from active user-days."""
    return rolling_distinct(active, grid, CUSTOMER, "user_identifier", DAY, thresholds.rolling_days,
                            "monthly_active_users_30d")


def usage_windows(grid: DataFrame, totals: DataFrame, active: DataFrame,
                  thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Daily totals, window sums and rolling users on every grid day.

    Totals (or their parts) and user changes are reduced to a few rows per customer and day, united
    with the grid and shuffled once by customer: that one partitioning serves the sum per
    day, both kinds of window and later joins by customer. Parts are not summed before: a sum over a
    union without a shuffle of its own keeps the small partitions of all its inputs apart. Days after the grid sort
    behind it and so are outside every frame of a grid day.
    """
    deltas = distinct_deltas(active, CUSTOMER, "user_identifier", DAY, thresholds.rolling_days, "__delta")
    measures = [*TOTALS, "__delta"]
    rows = (grid.withColumn("__on_grid", F.lit(True))
            .unionByName(totals, allowMissingColumns=True).unionByName(deltas, allowMissingColumns=True))
    daily = rows.repartition(F.col(CUSTOMER)).groupBy(CUSTOMER, DAY).agg(
        F.bool_or("__on_grid").alias("__on_grid"), *[zero_if_null(F.sum(m)).alias(m) for m in measures])
    running = Window.partitionBy(CUSTOMER).orderBy(DAY).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    windows = _rolling(thresholds.rolling_days) | {"monthly_active_users_30d": F.sum("__delta").over(running)}
    return daily.withColumns(windows).filter("__on_grid").drop("__on_grid", "__delta")


def product_usage(events: DataFrame, users: DataFrame, idmap: DataFrame, as_of: str | dt.date,
                  thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Daily usage metrics per customer over the trailing spine."""
    last = as_date(as_of)
    start = last - dt.timedelta(days=thresholds.usage_spine_days - 1)
    grid = customer_dates(users, trailing_days(events.sparkSession, last, thresholds.usage_spine_days, DAY))
    rows = usage_windows(grid, daily_parts(mapped_events(events, users, start), thresholds),
                         active_user_days(events, users, start), thresholds)
    dau, mau = F.col("daily_active_users"), F.col("monthly_active_users_30d")
    before, now = F.col("total_events_prev_30d"), F.col("total_events_30d")
    stickiness = F.when(mau > 0, ratio(dau, mau)).otherwise(F.lit(0.0))
    per_day = F.when(F.col("active_days_30d") > 0, ratio(now, "active_days_30d")).otherwise(F.lit(0.0))
    trend = F.when(before > 0, ratio(now - before, before) * 100).otherwise(F.lit(0.0))
    return with_customer_name(rows, idmap).select(
        surrogate_key(CUSTOMER, DAY).alias("usage_metrics_id"), CUSTOMER, "customer_name", DAY,
        "daily_active_users", "monthly_active_users_30d", "active_days_30d", "daily_events", "total_events_30d",
        "daily_key_actions", "key_actions_30d", F.round(stickiness, 4).alias("stickiness_ratio"),
        F.round(per_day, 2).alias("avg_events_per_active_day_30d"),
        F.round(trend, 1).alias("usage_trend_pct_30d"), flag(dau > 0).alias("is_daily_active"),
        flag(mau > 0).alias("is_monthly_active"))
