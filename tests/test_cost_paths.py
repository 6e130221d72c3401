"""Delivery costs: each entry is sent once, to the one customer it takes, also where the filter of projects errs. Plans of the declared suite."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from ledgerloom.operators import relational
from ledgerloom.operators.quality import Check, failing_values
from ledgerloom.plans import ledgers
from ledgerloom.schemas import staged_schema
from ledgerloom.workloads.standins import StandIns

# Projects of a customer, of an owner without a customer (one of them twice), of both, of nobody.
PROJECTS = [("own", "c1"), ("twice", "c1"), ("twice", "c2"), ("null", "n1"), ("null2", "n2"), ("both", "b"), ("none", "x"), (None, "c1"), ("open", None)]
IDMAP = [("c1", "M1"), ("c2", "M2"), ("n1", None), ("n2", None), ("n2", None), ("b", "M3"), ("b", None), (None, "M4")]
ISSUES = [("i1", "M7"), ("i2", "M8"), ("i2", "M9"), ("i3", None)]


def old_costs(entries, projects, idmap, issues):
    """The rule in two lookups, one after the other."""
    owners = relational.attribute(projects.select("project_id", "client_id"), idmap.withColumnRenamed("master_customer_id", "m1"), "client_id", "harvest_client_id")
    owned = relational.lookup(entries, owners.select(F.col("project_id").alias("p"), "m1"), "project_id", "p", spread_by="entry_id")
    owned = owned.filter(F.coalesce("m1", "linked_jira_issue_id").isNotNull()).withColumn("fallback", F.when(F.col("m1").isNull(), F.col("linked_jira_issue_id")))
    both = relational.lookup(owned, issues.select(F.col("issue_id").alias("i"), F.col("master_customer_id").alias("m2")), "fallback", "i", spread_by="entry_id")
    return sorted((r.entry_id, str(r.m)) for r in both.select("entry_id", F.coalesce("m1", "m2").alias("m")).collect())


def frames(spark, count=1):
    kinds = [(p, i) for p in ("own", "twice", "null", "null2", "both", "none", "open", "unlisted", None) for i in ("i1", "i2", "i3", "gone", None)]
    typed = "entry_id string, project_id string, linked_jira_issue_id string"
    entries = spark.createDataFrame([(f"{p}/{i}/{n}", p, i) for p, i in kinds for n in range(count)], typed)
    fields = [f for f in staged_schema("harvest_time_entries", 2) if not f.name.startswith("_")]
    entries = entries.select(*[F.col(f.name) if f.name in entries.columns else F.lit(Decimal(2) if f.name in ("hours", "cost_rate_gbp_per_hour") else None).cast(
        f.dataType).alias(f.name) for f in fields])
    return (entries, spark.createDataFrame(PROJECTS, "project_id string, client_id string"),
            spark.createDataFrame(IDMAP, "harvest_client_id string, master_customer_id string"),
            spark.createDataFrame(ISSUES, "issue_id string, master_customer_id string"))


@pytest.mark.parametrize("words", [1, 1 << 18])
def test_entries_take_the_customer_that_two_lookups_give(spark, monkeypatch, words):
    monkeypatch.setattr(relational, "FILTER_WORDS", words)  # with one word the filter errs often
    given = frames(spark)
    rows = ledgers.delivery_costs(*given).collect()
    assert sorted((r.source_record_id, str(r.master_customer_id)) for r in rows) == old_costs(*given)
    assert {r.cost_gbp for r in rows} == {4}


def test_a_key_filter_loses_no_key(spark):
    dim = spark.range(0, 5000, 5).select(F.col("id").cast("string").alias("k2"))
    keys = spark.range(5000).select(F.col("id").cast("string").alias("k")).unionByName(spark.sql("select cast(null as string) k"))
    got = {r.k: r.may for r in relational.with_may_match(keys, dim, "k", "k2", "may").collect()}
    assert all(got[str(i)] for i in range(0, 5000, 5)) and got[None] is False
    assert sum(got[str(i)] for i in range(5000) if i % 5) < 40
    assert {r.may for r in relational.with_may_match(keys, dim.limit(0), "k", "k2", "may").collect()} == {False}


def test_entries_are_shuffled_once(spark):
    """One join shuffles the entries; the filter and the projects it errs on are broadcast."""
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")
        entries, projects, idmap, issues = frames(spark, 400)
        many = spark.range(5000).select(F.concat(F.lit("o"), F.col("id").cast("string")).alias("issue_id"), F.lit("M").alias("master_customer_id"))
        cost = ledgers.delivery_costs(entries, projects, idmap, issues.unionByName(spark.createDataFrame(many.collect(), many.schema)))
        sent = cost.filter("master_customer_id is not null").agg(F.count(F.lit(1)))
        sent.collect()
        plan = sent._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan.split("== Initial Plan ==")[0])
    assert keys.count("__owner") == 1 and "__on" not in keys


def test_feeds_are_dealt_without_a_sort(spark, tmp_path):
    """Rows of a feed go to many files by their hash; repeated and null rows stay as many as they are."""
    spark.range(400).selectExpr("if(id % 7 = 0, null, id % 90) c_custkey", "if(id % 5 = 0, null, 'c') c_name", "cast(id % 3 as double) c_acctbal", "'BUILDING' c_mktsegment").write.parquet(
        str(tmp_path / "customer.parquet"))
    source = StandIns(spark, str(tmp_path))
    texts = source.documents("stripe_customers")
    assert "RoundRobinPartitioning" not in texts._jdf.queryExecution().executedPlan().toString()
    assert texts.count() == 400 and texts.select(F.spark_partition_id()).distinct().count() > 1
    assert texts.distinct().count() == source.feed("stripe_customers").distinct().count()


def test_usage_parts_are_united_once(spark):
    """A sum over a union below the union would keep the small partitions of all its inputs apart."""
    plan = StandIns(spark, SF_DIR).usage_plan._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bUnion\b", plan)) == 1


def test_checks_and_revenue_branches_are_compiled(spark):
    """Functions with a lambda are interpreted for every row: none picks the pairs of a row."""
    rows = spark.createDataFrame([("a", None), ("a", "x"), (None, None)], "k string, v string")
    spec = [Check("m", "k", "unique"), Check("m", "k", "not_null"), Check("m", "v", "not_null")]
    found = failing_values(spec, {"m": rows})
    assert sorted(map(tuple, found.collect()), key=str) == [(0, "a", 2), (1, None, 1), (2, None, 2)]
    revrec = spark.createDataFrame([("r", "c", "2024-01", 1, 2, 3), ("s", "c", "2024-01", 1, None, 0)],
                                   "revrec_id string, customer_id string, month string, booked_arr_gbp int, recognized_revenue_gbp int, deferred_revenue_gbp int")
    events = ledgers.gaap_events(revrec)
    assert sorted((r.source_record_id, r.revenue_category) for r in events.collect()) == [("r", "RECOGNIZED"), ("r_deferred", "DEFERRED")]
    assert not any("lambda" in df._jdf.queryExecution().optimizedPlan().toString() for df in (found, events))
