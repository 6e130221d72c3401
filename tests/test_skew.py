"""One key that holds a third of all rows: same results, split or combined before it reaches one task."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import relational
from ledgerloom.operators.quality import check_unique
from ledgerloom.operators.session import tune
from ledgerloom.plans import usage

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def no_broadcast(spark):
    tune(spark)
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    tune(spark)


def hot(column, share=3, keys=200):
    """A third of the ids map to one key."""
    return F.when(F.col(column) % share == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col(column) % keys).cast("string")))


def test_a_hot_customer_is_split_by_the_join(no_broadcast):
    facts = no_broadcast.range(0, 200_000, 1, 8).select("id", hot("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    dim = no_broadcast.range(200).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k2"), F.col("id").alias("v")).unionByName(
        no_broadcast.sql("select 'hot' as k2, -1L as v"))
    joined = relational.attribute(facts, dim, "k", "k2")
    totals = joined.agg(F.count("*").alias("n"), F.count_if(F.col("v") == -1).alias("hot"), F.max("pad").alias("p"))
    row = totals.collect()[0]
    assert row.n == 200_000 and row.hot == 66_667
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_null_keys_do_not_meet_in_one_task(no_broadcast):
    facts = no_broadcast.range(0, 60_000, 1, 8).select("id", F.when(F.col("id") % 50 == 0, hot("id")).alias("k"))
    dim = no_broadcast.sql("select 'hot' as k2, 1 as v")
    joined = relational.lookup(facts, dim, "k", "k2", spread_by="id")
    sizes = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 60_000 and joined.filter("v = 1").count() == 400
    assert max(sizes) < 30_000


def test_rolling_users_of_a_hot_customer(no_broadcast):
    events = no_broadcast.range(0, 30_000, 1, 8).select(
        hot("id", keys=20).alias("c"), F.concat(F.lit("u"), (F.col("id") % 5000).cast("string")).alias("u"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 17).cast("int")).alias("d"))
    grid = events.select("c", "d").distinct()
    got = relational.rolling_distinct(events, grid, "c", "u", "d", 7, "n")
    seen = events.distinct().select(F.col("c").alias("c2"), "u", F.col("d").alias("d2"))
    want = (grid.join(seen, (F.col("c") == F.col("c2")) & F.col("d2").between(F.date_sub("d", 6), F.col("d")))
            .groupBy("c", "d").agg(F.count_distinct("u").alias("n")))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_hot_values_are_combined_before_the_shuffle(no_broadcast):
    rows = no_broadcast.range(0, 90_000, 1, 8).select(hot("id", keys=50).alias("k"))
    assert check_unique(rows, "k").filter("unique_field = 'hot'").first().n_records == 30_000
    best = relational.top1(rows.withColumn("v", F.rand(7)), ["k"], [F.col("v").desc_nulls_first()])
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_daily_totals_of_a_hot_customer_day(no_broadcast):
    mapped = no_broadcast.range(0, 30_000, 1, 8).select(
        hot("id").alias("master_customer_id"), F.lit("2024-01-01").cast("date").alias("event_date"),
        F.concat(F.lit("e"), (F.col("id") % 20_000).cast("string")).alias("event_id"),
        F.lit("Purchase").alias("event_name"), F.concat(F.lit("u"), (F.col("id") % 7).cast("string")).alias("user_identifier"))
    row = usage.daily_totals(mapped).filter("master_customer_id = 'hot'").first()
    distinct = mapped.filter("master_customer_id = 'hot'").select("event_id").distinct().count()
    assert (row.daily_events, row.daily_key_actions, row.daily_active_users) == (distinct, distinct, 7)
