"""The model DAG of one tenant: staged feeds in, intermediate models and marts out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import as_date
from ..operators.models import Dag
from ..operators.session import cut_lineage, tune
from ..schemas import STAGING
from ..sources.tables import with_loaded_at, write_table
from . import activation, finance, health, identity, ledgers, support, usage
from .params import RATES, THRESHOLDS, Rates, Thresholds

# Models that several others read: materialized once per run.
SHARED = ("int_identity_map", "int_user_customer_map", "int_unified_revenue", "int_unified_cost",
          "int_issue_resolution_chain", "int_product_usage_metrics")

# Audit column of each model that has one.
AUDIT_COLUMNS = {
    "int_user_customer_map": "mapping_calculated_at",
    "int_mrr_arr_snapshot": "snapshot_calculated_at",
    "int_product_usage_metrics": "metrics_calculated_at",
    "fact_revenue_gap": "dbt_loaded_at",
    "fact_customer_profitability": "dbt_loaded_at",
    "fact_project_performance": "dbt_loaded_at",
    "fact_customer_health": "dbt_loaded_at",
    "fact_revenue_at_risk": "dbt_loaded_at",
    "dim_customer_360": "dbt_loaded_at",
    "mart_activation_customers": "segment_assigned_at",
}

MARTS = ("fact_revenue_gap", "fact_customer_profitability", "fact_project_performance", "fact_customer_health",
         "fact_revenue_at_risk", "dim_customer_360", "mart_activation_customers")


def build_dag(spark: SparkSession, staged: Mapping[str, DataFrame], seed: DataFrame, as_of: str | dt.date,
              loaded_at: str | None = None, rates: Rates = RATES, thresholds: Thresholds = THRESHOLDS,
              issue_key: str = "jira_account_key", map_usage: bool = False,
              materialize: bool = True) -> Dag:
    """All models over the staged feeds (named as in ``STAGING``) for one date.

    ``loaded_at`` stamps the audit columns and defaults to the date. ``issue_key`` and
    ``map_usage`` switch two quirks of the models off: issues matched to customers by
    account id, and usage mapped to customers in the health score.
    """
    tune(spark, hashed=True)
    day = as_date(as_of)
    stamp = loaded_at or f"{day} 00:00:00"
    dag = Dag(spark, dict(staged), {"as_of": day, "rates": rates, "thresholds": thresholds})
    missing = sorted(set(STAGING) - set(staged))
    s = dag.source

    def add(name: str, build) -> None:
        def model(_dag: Dag, _spark: SparkSession) -> DataFrame:
            df = build()
            if name in AUDIT_COLUMNS:
                df = with_loaded_at(df, AUDIT_COLUMNS[name], stamp)
            return cut_lineage(df) if materialize and name in SHARED else df

        dag.model(name)(model)

    idmap = lambda: dag.ref("int_identity_map")
    users = lambda: dag.ref("int_user_customer_map")
    revenue = lambda: dag.ref("int_unified_revenue")
    cost = lambda: dag.ref("int_unified_cost")
    mrr = lambda: dag.ref("int_mrr_arr_snapshot")
    chain = lambda: dag.ref("int_issue_resolution_chain")
    product = lambda: dag.ref("int_product_usage_metrics")

    add("int_identity_map", lambda: identity.identity_map(
        seed, s("sf_accounts"), s("stripe_customers"), s("intacct_customers"), s("zendesk_organizations")))
    add("int_user_customer_map", lambda: identity.user_customer_map(s("mixpanel_events"), idmap()))
    add("int_unified_customers", lambda: identity.unified_customers(s("stripe_customers")))
    add("int_unified_revenue", lambda: ledgers.unified_revenue(
        s("stripe_invoices"), s("stripe_charges"), s("stripe_refunds"), s("stripe_disputes"),
        s("intacct_revenue_recognition"), idmap()))
    add("int_mrr_arr_snapshot", lambda: ledgers.mrr_snapshot(s("stripe_subscriptions"), idmap()))

    @cache
    def owned() -> DataFrame:
        """Attributed issues: the cost ledger reads them twice."""
        rows = ledgers.owned_issues(s("jira_issues"), idmap(), issue_key)
        return cut_lineage(rows) if materialize else rows

    add("int_unified_cost", lambda: ledgers.unified_cost(
        ledgers.delivery_costs(s("harvest_time_entries"), s("harvest_projects"), idmap(),
                               ledgers.issue_customer(owned())),
        ledgers.support_costs(s("zendesk_time_entries"), s("zendesk_tickets"), idmap(), rates),
        ledgers.engineering_costs(owned(), rates)))
    add("int_issue_resolution_chain", lambda: support.issue_resolution(support.resolution_chain(
        s("zendesk_tickets"), s("zendesk_ticket_events"), s("jira_issues"), s("harvest_time_entries"),
        s("zendesk_time_entries"), idmap(), day, rates)))
    add("int_product_usage_metrics", lambda: usage.product_usage(s("mixpanel_events"), users(), idmap(), day,
                                                                 thresholds))
    add("int_customer_ltv", lambda: finance.customer_ltv(
        idmap(), revenue(), cost(), mrr(), s("sf_opportunities"), day, thresholds))
    add("int_customer_health_score", lambda: health.customer_health_score(health.health_components(
        idmap(), finance.commercial_mrr_monthly(mrr()), revenue(), s("stripe_invoices"), chain(), day,
        health.usage_trend(s("mixpanel_events"), day, users()) if map_usage else None, thresholds), day))
    add("fact_revenue_gap", lambda: finance.revenue_gap(
        s("sf_opportunities"), s("stripe_invoice_line_items"), s("stripe_invoices"), idmap(), thresholds))
    add("fact_customer_profitability", lambda: finance.customer_profitability(revenue(), cost(), idmap()))
    add("fact_project_performance", lambda: finance.project_performance(
        s("harvest_projects"), s("harvest_time_entries"), s("sf_opportunities"), idmap(), day, thresholds))
    add("fact_customer_health", lambda: health.fact_customer_health(
        idmap(), product(), s("mixpanel_events"), users(), s("zendesk_tickets"), s("stripe_invoices"), day,
        thresholds))
    add("fact_revenue_at_risk", lambda: health.revenue_at_risk(
        idmap(), s("sf_opportunities"), product(), cost(), day, thresholds))
    add("dim_customer_360", lambda: activation.dim_customer_360(dag.ref("int_unified_customers"), day))
    add("mart_activation_customers", lambda: activation.activation_customers(dag.ref("dim_customer_360"),
                                                                             thresholds))
    dag.config["missing_sources"] = missing
    return dag


def write_marts(dag: Dag, database: str | None = None) -> dict[str, DataFrame]:
    """Materialize every mart as a table clustered by customer where it has one."""
    prefix = f"{database}." if database else ""
    out = {}
    for name in MARTS:
        df = dag.ref(name)
        cluster = ["master_customer_id"] if "master_customer_id" in df.columns else None
        out[name] = write_table(df, prefix + name, cluster)
    return out
