"""Every registered query against its SQL in DuckDB, and the shape of its plan."""

import math
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_DIR
from ledgerloom.plans import build, finance, ledgers
from ledgerloom.plans.suite import MODEL_KEYS
from ledgerloom.schemas import STAGING
from ledgerloom.workloads import data_queries, model_queries, standins
from ledgerloom.workloads.standins import StandIns

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        return repr(v + 0.0) if isinstance(v, float) else str(v)

    return sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module", autouse=True)
def shared_standins():
    """One set of stand-ins for the module, so that shared maps are built once."""
    made = {}

    def shared(spark, sf_dir):
        return made.setdefault(sf_dir, StandIns(spark, sf_dir))

    patch = pytest.MonkeyPatch()
    patch.setattr(model_queries, "StandIns", shared)
    patch.setattr(data_queries, "StandIns", shared)
    yield
    patch.undo()


@pytest.mark.parametrize("name", sorted(entry.ALL))
def test_query_matches_its_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = canonical(df.columns, df.collect())
    relation = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert got == canonical(relation.columns, relation.fetchall())
    assert len(got) > 0


def test_every_staged_column_is_seen_with_values(duck):
    for table in STAGING:
        relation = duck.sql(entry.oracle_sql()[f"stg_{table}"])
        counts = relation.aggregate(", ".join(f"count({c})" for c in relation.columns)).fetchall()[0]
        assert all(counts), (table, [c for c, n in zip(relation.columns, counts, strict=True) if not n])


# Joins that may be nested loops: a one-row side or the fixed date spine.
@pytest.mark.parametrize("name", ["revenue_gap", "unified_revenue", "unified_cost", "customer_profitability", "customer_ltv",
                                  "product_usage", "issue_resolution", "customer_health_score", "fact_customer_health",
                                  "revenue_at_risk", "project_performance", "user_customer_map", "identity_map"])
def test_plans_have_no_cross_products_or_single_task_windows(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    allowed = {"customer_ltv": 1, "product_usage": 1}
    assert plan.count("BroadcastNestedLoopJoin") <= allowed.get(name, 0)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    windows = re.findall(r"Window \[.*", plan)
    assert all("windowspecdefinition(" in w for w in windows)
    # A window without partition keys would need all rows in one task.
    assert "Exchange SinglePartition" not in plan or name in allowed


# The ledgers' tables are read by what a query writes once and by its last plan; here are the scans of all of them.
SCANS = {"customer_profitability": {"lineitem": 4, "orders": 5}, "customer_ltv": {"lineitem": 4, "orders": 7}, "unified_cost": {"lineitem": 3, "orders": 2},
         "allocation_basis": {"lineitem": 4, "orders": 5}, "cost_month_pool": {"lineitem": 3, "orders": 2},
         "revenue_at_risk": {"events": 3, "lineitem": 1}, "fact_customer_health": {"events": 4}}


@pytest.mark.parametrize("name", sorted(SCANS))
def test_ledgers_are_planned_once(spark, name, monkeypatch):
    plans = []

    def note(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df)

    written = finance.cut_lineage
    for module in (finance, standins):
        monkeypatch.setattr(module, "cut_lineage", note)
    ready = StandIns(spark, SF_DIR)
    ready.idmap, ready.users  # noqa: B018  maps of every model, counted nowhere
    plans.clear()
    monkeypatch.setattr(model_queries, "StandIns", lambda *_: ready)
    df = entry.queries()[name](spark, SF_DIR)
    plans.append(df._jdf.queryExecution().executedPlan().toString())
    for table, most in SCANS[name].items():
        assert sum(len(re.findall(rf"FileScan parquet .*?/{table}\.parquet", plan)) for plan in plans) <= most


# Customers' counts come from rows reduced to invoices, tickets and events: no row is multiplied for distinct counts.
@pytest.mark.parametrize("name", ["customer_health_score", "customer_health_score_mapped"])
def test_health_plans_multiply_no_rows(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_declared_suite_parses_each_feed_once_and_writes_each_model_once(spark, monkeypatch):
    """What is written instead of run: documents are parsed for the staged tables alone, and shared models are not written again."""
    plans = []

    def note(df):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        return spark.createDataFrame([], df.schema)

    for module in (build, finance, model_queries, standins):
        monkeypatch.setattr(module, "cut_lineage", note)
    monkeypatch.setattr(model_queries, "run_suite", lambda checks, models: models)
    models = model_queries.declared_suite(StandIns(spark, SF_DIR))
    assert set(models) == set(MODEL_KEYS)
    parsed = [p for p in plans if "parse_json" in p]
    assert len(parsed) == len(set(STAGING) - model_queries.UNREAD)
    assert not any("parse_json" in m._jdf.queryExecution().analyzed().toString() for m in models.values())
    assert not any(p.startswith(("LocalRelation", "LogicalRDD")) for p in plans)  # what was written is not written again


def test_sums_of_the_cost_ledger_send_no_entry_ids(spark):
    """Entries are spread before their joins by what the sums read as well."""
    entries = spark.createDataFrame([], "entry_id string, project_id string, person string, role string, linked_jira_issue_id string, notes string, "
                                    "hours decimal(18,2), billable_rate_gbp_per_hour decimal(18,2), cost_rate_gbp_per_hour decimal(18,2), date date")
    entries = entries.unionByName(spark.range(3).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name != "entry_id" else F.col("id").cast("string").alias(
        "entry_id") for f in entries.schema]))
    projects = spark.range(3).selectExpr("cast(id as string) project_id", "cast(id as string) client_id")
    idmap = spark.range(3).selectExpr("cast(id as string) harvest_client_id", "cast(id as string) master_customer_id")
    issues = spark.range(3).selectExpr("cast(id as string) issue_id", "cast(id as string) master_customer_id")
    sums = finance.cost_monthly(ledgers.unified_cost(ledgers.delivery_costs(entries, projects, idmap, issues)))
    plan = sums._jdf.queryExecution().optimizedPlan().toString()
    joins = [i for i, line in enumerate(plan.splitlines()) if "Join LeftOuter" in line]
    assert joins and "entry_id" not in "".join(plan.splitlines()[:joins[-1] + 1])
