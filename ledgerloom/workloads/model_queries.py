"""Registered queries of the business models, each with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import trailing_days
from ..operators import relational
from ..operators.quality import run_suite
from ..operators.session import cut_lineage
from ..plans import activation, finance, health, identity, usage
from ..plans.build import SHARED, build_dag
from ..plans.suite import MODEL_KEYS, declared_checks
from ..schemas import STAGING
from ..sources.staging import stage
from . import oracle
from .shape import finish
from .standins import AS_OF, StandIns


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def paired(build: Callable[[StandIns], DataFrame], body: str, spec: str) -> Query:
    """A query over the stand-ins and its oracle, in the same output form."""
    return Query(lambda spark, sf_dir: finish(build(StandIns(spark, sf_dir)), spec), oracle.sql(body, spec))


def table(name: str) -> str:
    return f"SELECT * FROM {name}"


ID_COLUMNS = " ".join(f"{c}:s" for c in identity.IDENTIFIERS)
GAP = ("revenue_gap_id:s master_customer_id:s customer_name:s revenue_month:d expected_monthly_booked_gbp:f6 "
       "actual_net_revenue_gbp:f6 revenue_gap_gbp:f6")
IDMAP = (f"master_customer_id:s {ID_COLUMNS} customer_name:s identity_source:s source_system_count:i "
         "has_ground_truth:b has_conflicts:b first_seen_at:d last_seen_at:d")
USERS = ("user_identifier:s company_id:s master_customer_id:s mapping_method:s mapping_confidence:s has_conflict:i "
         "mapped_customer_count:i company_id_count:i first_seen_at:t last_seen_at:t")
REVENUE = ("revenue_event_id:s master_customer_id:s revenue_date:d revenue_type:s revenue_category:s amount_gbp:f6 "
           "amount_gbp_signed:f6 event_direction:s cash_status:s mrr_gbp:f6 arr_gbp:f6 payment_status:s "
           "subscription_id:s invoice_id:s charge_id:s source_system:s source_record_id:s revenue_month:d "
           "revenue_quarter:d revenue_year:f0 is_cash_revenue:i is_gaap_revenue:i is_accounts_receivable:i "
           "is_cash_outflow:i is_cash_inflow:i is_recurring:i")
COST = ("cost_event_id:s master_customer_id:s activity_date:d person_name:s role_or_tier:s hours:f6 cost_gbp:f6 "
        "work_type:s work_category:s linked_ticket_id:s linked_issue_id:s source_system:s source_record_id:s notes:s "
        "activity_month:d activity_quarter:d activity_year:f0")
SNAPSHOT = ("mrr_arr_snapshot_id:s master_customer_id:s subscription_id:s subscription_status:s snapshot_date:d "
            "mrr_gbp:f6 arr_gbp:f6")
PROFIT = ("customer_profitability_id:s master_customer_id:s customer_name:s profitability_month:d "
          "gaap_recognized_revenue_gbp:f6 delivery_cost_gbp:f6 support_cost_gbp:f6 engineering_direct_cost_gbp:f6 "
          "total_direct_cost_gbp:f6 shared_engineering_pool_gbp:f4 allocated_shared_engineering_cost_gbp:f6 "
          "total_cost_gbp:f6 gross_margin_gbp:f6 gross_margin_pct:f4")
POOL = ("master_customer_id:s profitability_month:d total_direct_cost_gbp:f6 "
        "shared_engineering_cost_customer_month_gbp:f6 shared_engineering_pool_gbp:f4")
BASIS = ("master_customer_id:s profitability_month:d gaap_recognized_revenue_gbp:f6 total_revenue_in_month_gbp:f4")
LTV = ("master_customer_id:s customer_name:s gaap_total_revenue_gbp:f4 gaap_total_recognized_revenue_gbp:f4 "
       "gaap_total_deferred_revenue_gbp:f4 commercial_current_mrr_gbp:f4 commercial_avg_monthly_mrr_gbp:f8 "
       "total_direct_cost_gbp:f6 total_delivery_cost_gbp:f4 total_support_cost_gbp:f6 "
       "total_engineering_direct_cost_gbp:f4 total_engineering_shared_cost_gbp:f4 total_hours:f6 "
       "allocated_shared_engineering_cost_gbp:f6 total_cost_including_allocated_shared_engineering_gbp:f6 "
       "gross_margin_direct_cost_gbp:f6 margin_percent_direct_cost:f4 "
       "gross_margin_with_allocated_shared_engineering_gbp:f6 customer_tenure_months:f0 customer_since:d "
       "avg_monthly_revenue_gbp:f8 avg_monthly_cost_gbp:f8 avg_monthly_margin_gbp:f8 "
       "projected_commercial_ltv_gbp:f4 projected_gaap_ltv_gbp:f4 estimated_cac_gbp:i acquisition_date:d "
       "first_revenue_date:d last_revenue_date:d gaap_months_with_revenue:f0 ltv_to_cac_ratio:f6 "
       "cac_payback_months:f6 profitability_tier:s customer_status:s")
PROJECT = ("project_performance_id:s master_customer_id:s customer_name:s harvest_project_id:s project_name:s "
           "project_budget_gbp:f4 actual_cost_to_date_gbp:f4 budget_utilization_pct:f6 contract_start_date:d "
           "contract_end_date:d project_start_date:d project_last_activity_date:d project_completion_pct:f6 "
           "burn_rate_gbp_per_day:f6 projected_total_cost_gbp:f6 projected_overrun_gbp:f4 is_at_risk:b")
DAILY = ("master_customer_id:s event_date:d daily_events:i daily_unique_event_types:i daily_key_actions:i "
         "daily_active_users:i")
USAGE = ("usage_metrics_id:s master_customer_id:s customer_name:s event_date:d daily_active_users:i "
         "monthly_active_users_30d:i active_days_30d:i daily_events:i total_events_30d:i daily_key_actions:i "
         "key_actions_30d:i stickiness_ratio:f4 avg_events_per_active_day_30d:f2 usage_trend_pct_30d:f1 "
         "is_daily_active:i is_monthly_active:i")
CHAIN = ("resolution_chain_id:s zendesk_ticket_id:s master_customer_id:s ticket_created_at:t "
         "ticket_first_response_at:t ticket_last_agent_status_change_at:t ticket_solved_at:t ticket_closed_at:t "
         "ticket_status:s ticket_severity:s jira_issue_id:s issue_created_at:t issue_resolved_at:t "
         "support_handle_time_hours:f6 total_support_cost_gbp:f6 total_jira_hours:f4 total_jira_cost_gbp:f4 "
         "total_harvest_hours:f4 total_harvest_cost_gbp:f4 total_engineering_hours:f4 total_engineering_cost_gbp:f4 "
         "resolution_time_days:f0 ticket_to_issue_days:f0 issue_resolution_days:f0 ticket_age_days:f0 has_linked_issue:i "
         "has_delivery_work:i is_resolved:i total_cost_gbp:f6 resolution_speed_category:s impact_score:f6")
HEALTH = ("master_customer_id:s customer_name:s health_score:i revenue_health_score:i support_health_score:i "
          "payment_health_score:i usage_health_score:i risk_category:s churn_probability:f2 "
          "commercial_current_mrr:f4 commercial_mrr_change_pct:f4 gaap_recognized_current_month_gbp:f4 "
          "gaap_recognized_prev_month_gbp:f4 support_tickets_30d:f0 high_severity_tickets_30d:f0 support_cost_30d:f6 "
          "open_invoices_count:f0 open_invoices_amount_gbp:f4 open_invoices_30d_plus_count:f0 "
          "open_invoices_30d_plus_amount_gbp:f4 max_open_invoice_age_days:f0 avg_days_to_pay_90d:f6 "
          "late_paid_invoices_90d:f0 usage_events_30d:f0 usage_days_30d:f0 score_calculated_at:d")
FACT_HEALTH = ("customer_health_id:s master_customer_id:s customer_name:s as_of_date:d last_login_date:d "
               "active_users_l30d:i open_critical_tickets_count:i days_sales_outstanding:f1 usage_score:f4 "
               "tickets_score:f4 late_payment_score:f4 health_score:f4 open_invoices_30d_plus_count:f0 "
               "avg_days_to_pay_90d:f1 usage_trend_pct_30d:f1 health_category:s")
RISK = ("revenue_at_risk_id:s master_customer_id:s customer_name:s as_of_date:d booked_arr_gbp:f4 is_high_value:b "
        "active_days_30d_current:i active_days_30d_prev_3mo_avg:f6 active_days_change_ratio:f6 is_declining_usage:b "
        "support_hours_30d:f6 support_hours_prev_30d:f6 is_support_spike:b is_revenue_at_risk:b")
UNIFIED = ("email_domain:s first_name:s last_name:s company:s stripe_customer_id:s first_seen_at:t last_seen_at:t")
DIM360 = f"customer_key:s {UNIFIED} days_since_first_seen:f0"
SEGMENT = ("customer_key:s email_domain:s first_name:s last_name:s company:s segment:s recommended_action:s")
SCORED = (f"master_customer_id:s customer_name:s {ID_COLUMNS} identity_source:s identity_source_priority:i "
          "identifiers_populated:i")


def revenue_gap(s: StandIns) -> DataFrame:
    return finance.revenue_gap(s.opportunities, s.invoice_lines, s.invoices, s.idmap)


def health_score(s: StandIns, mapped: bool) -> DataFrame:
    trend = health.usage_trend(s.product_events, AS_OF, s.users) if mapped else None
    parts = health.health_components(s.idmap, finance.commercial_mrr_monthly(s.snapshots), s.revenue, s.invoices,
                                     s.chain, AS_OF, trend)
    return health.customer_health_score(parts, AS_OF)


def conflicts(s: StandIns) -> DataFrame:
    return s.idmap_plan.filter("has_conflicts").groupBy("identity_source").agg(
        F.count(F.lit(1)).alias("customers"), F.max("source_system_count").alias("most_systems"))


def scored(s: StandIns) -> DataFrame:
    return identity.score_identities(identity.all_identities(s.seed, s.accounts, s.billing, s.ledger, s.orgs))


def mapped(s: StandIns) -> DataFrame:
    return usage.mapped_events(s.product_events, s.users, "2023-10-23")


def active(s: StandIns) -> DataFrame:
    return usage.active_user_days(s.product_events, s.users, "2023-10-23")


def company_or_account(s: StandIns) -> DataFrame:
    activity = identity.user_company_activity(s.product_events)
    return relational.or_join(activity, s.idmap, "company_id", [("mixpanel_company_id", 2), ("account_id", 1)],
                              "master_customer_id", "mapping_score", "user_identifier")


def members_per_day(s: StandIns) -> DataFrame:
    """Distinct users of the trailing week per event type and day, on days with events."""
    events = s.table("events").select("event_type", F.col("user_id").cast("string").alias("member"),
                                      F.col("ts").cast("date").alias("day"))
    grid = events.select("event_type", "day").distinct()
    return relational.rolling_distinct(events, grid, "event_type", "member", "day", 7, "users_7d")


def rolling_value(s: StandIns) -> DataFrame:
    """Sum, largest, mean and number of the event values of the trailing 30 days, per event type and day with events."""
    events = s.table("events").select("event_type", F.col("ts").cast("date").alias("day"), F.col("value").cast("decimal(18,2)").alias("value"))
    grid = events.select("event_type", "day").distinct()
    return relational.band_aggregate(grid, events.withColumnRenamed("day", "at"), ["event_type"], "day", "at", -29, 0, {
        "total": ("sum", "value"), "largest": ("max", "value"), "mean": ("avg", "value"), "n": ("count", "value")})


# Known ids of five customers, given inline.
INLINE_TRUTH = [(f"Known {k}", f"HV_{k}", f"INTACCT_{k}", f"JIRA_{k}", f"mp_{k}", f"SF_{k}", f"cus_{k}", f"ZD_{k}") for k in range(1, 6)]


def inline_truth(s: StandIns) -> DataFrame:
    """Accounts that inline ground truth knows, with their ids."""
    known = identity.truth_identities(identity.ground_truth(s.spark, INLINE_TRUTH))
    return relational.attribute(s.accounts.select("account_id", "account_name"), known.drop("account_id"), "account_id", "master_customer_id").withColumn(
        "master_customer_id", F.col("account_id"))


# Staged tables that no model reads.
UNREAD = {"harvest_clients", "intacct_gl_entries", "sf_users", "stripe_balance_transactions"}


def declared_suite(s: StandIns) -> DataFrame:
    """All declared checks over the models that have them.

    Each staged table that models read and each model is written once: several models read
    a feed, and documents are not to be parsed again for every one of them and every filter.
    """
    staged = {t: stage(t, s.landing(t), number_scale=2) for t in STAGING}
    staged |= {t: cut_lineage(rows) for t, rows in staged.items() if t not in UNREAD}
    dag = build_dag(s.spark, staged, s.seed, AS_OF)
    models = {m: dag.ref(m) if m in SHARED else cut_lineage(dag.ref(m)) for m in MODEL_KEYS}  # shared ones are written by the DAG
    return run_suite(declared_checks(), models)


# Where the oracle keeps a model; audit columns are stamped and so never null.
ORACLE_OF = {
    "int_identity_map": "idmap", "int_unified_revenue": "revenue", "int_mrr_arr_snapshot": "snapshots", "int_unified_cost": "cost",
    "int_issue_resolution_chain": "chain", "int_customer_health_score": "scores", "int_customer_ltv": "ltv", "int_unified_customers": "unified",
    "int_product_usage_metrics": "usage", "int_user_customer_map": "users", "fact_customer_profitability": "profit",
    "fact_customer_health": "fact_health", "fact_project_performance": "project_perf", "fact_revenue_at_risk": "risk", "fact_revenue_gap": "gap"}


def declared_sql() -> str:
    """Each model reduced to one row of counts, then a row for each check."""
    parts = []
    for model, name in ORACLE_OF.items():
        table_of = f"({oracle.health_score_sql('no_usage')})" if name == "scores" else name
        for check in declared_checks([model]):
            stamped = check.column in ("metrics_calculated_at", "mapping_calculated_at")
            if stamped:
                n = "0"
            elif check.kind == "not_null":
                n = f"(SELECT COUNT(*) FILTER ({check.column} IS NULL) FROM {table_of})"
            elif check.kind == "unique":
                n = f"(SELECT COUNT(*) FROM (SELECT 1 FROM {table_of} WHERE {check.column} IS NOT NULL GROUP BY {check.column} HAVING COUNT(*) > 1))"
            else:
                n = f"(SELECT COUNT(*) FROM {table_of} x ANTI JOIN idmap m USING (master_customer_id) WHERE x.master_customer_id IS NOT NULL)"
            parts.append(f"SELECT '{model}' AS model, '{check.column}' AS col, '{check.kind}' AS kind, {n} AS failures")
    return f"SELECT *, failures <> 0 AS should_warn, failures <> 0 AS should_error FROM ({' UNION ALL '.join(parts)})"


MODEL_QUERIES: dict[str, Query] = {
    "revenue_gap": paired(revenue_gap, table("gap"), GAP),
    "contract_months": paired(
        lambda s: finance.expand_months(finance.contract_months(s.opportunities, s.idmap)),
        "SELECT master_customer_id, opportunity_id, revenue_month, expected AS expected_monthly_booked_gbp FROM "
        "contract_rows", "master_customer_id:s opportunity_id:s revenue_month:d expected_monthly_booked_gbp:f6"),
    "identity_map": paired(lambda s: s.idmap_plan, table("idmap"), IDMAP),
    "identity_candidates": paired(scored, table("scored"), SCORED),
    "identity_canonical": paired(
        lambda s: identity.canonical_identity(scored(s)), table("canonical"),
        "master_customer_id:s customer_name:s identity_source:s"),
    "identity_conflicts": paired(
        conflicts, "SELECT identity_source, COUNT(*) AS customers, MAX(source_system_count) AS most_systems FROM "
        "idmap WHERE has_conflicts GROUP BY 1", "identity_source:s customers:i most_systems:i"),
    "user_customer_map": paired(lambda s: identity.user_customer_map(s.product_events, s.idmap), table("users"),
                                USERS),
    "or_join_candidates": paired(
        company_or_account, "SELECT user_identifier, company_id, master_customer_id, COALESCE(score, 0) AS mapping_score "
        "FROM sightings", "user_identifier:s company_id:s master_customer_id:s mapping_score:i"),
    "unified_revenue": paired(lambda s: s.revenue, table("revenue"), REVENUE),
    "unified_cost": paired(lambda s: s.cost, table("cost"), COST),
    "mrr_snapshot": paired(lambda s: s.snapshots, table("snapshots"), SNAPSHOT),
    "customer_profitability": paired(
        lambda s: finance.customer_profitability(s.revenue, s.cost, s.idmap), table("profit"), PROFIT),
    "cost_month_pool": paired(lambda s: finance.with_month_pool(finance.cost_monthly(s.cost).drop(
        "delivery_cost_gbp", "support_cost_gbp", "engineering_direct_cost_gbp")), table("cost_with_pool"), POOL),
    "allocation_basis": paired(
        lambda s: finance.month_basis(s.revenue, s.cost), table("basis"), BASIS),
    "customer_ltv": paired(
        lambda s: finance.customer_ltv(s.idmap, s.revenue, s.cost, s.snapshots, s.opportunities, AS_OF),
        table("ltv"), LTV),
    "project_performance": paired(
        lambda s: finance.project_performance(s.projects, s.delivery_time, s.opportunities, s.idmap, AS_OF),
        table("project_perf"), PROJECT),
    "daily_event_totals": paired(lambda s: usage.daily_totals(mapped(s)), table("daily"), DAILY),
    "rolling_mau": paired(
        lambda s: usage.rolling_mau(active(s), usage.customer_dates(s.users, trailing_days(s.spark, AS_OF, 121))), table("mau"),
        "master_customer_id:s event_date:d monthly_active_users_30d:i"),
    "rolling_week_users": paired(
        members_per_day,
        "SELECT b.event_type, b.day, COUNT(DISTINCT a.user_id) AS users_7d FROM (SELECT DISTINCT event_type, CAST(ts "
        "AS DATE) AS day FROM events) b LEFT JOIN (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day, user_id FROM "
        "events) a ON a.event_type = b.event_type AND a.day BETWEEN b.day - 6 AND b.day GROUP BY 1, 2",
        "event_type:s day:d users_7d:i"),
    "rolling_value": paired(
        rolling_value,
        "SELECT b.event_type, b.day, SUM(v) AS total, MAX(v) AS largest, CAST(SUM(v) AS DOUBLE) / COUNT(v) AS mean, COUNT(v) AS n FROM (SELECT DISTINCT "
        "event_type, CAST(ts AS DATE) AS day FROM events) b JOIN (SELECT event_type, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(18,2)) AS v FROM "
        "events) a ON a.event_type = b.event_type AND a.day BETWEEN b.day - 29 AND b.day GROUP BY 1, 2",
        "event_type:s day:d total:f2 largest:f2 mean:f6 n:i"),
    "identity_inline_truth": paired(
        inline_truth, "SELECT account_id, account_name, account_id AS master_customer_id, 'Known ' || k AS customer_name, 'cus_' || k AS "
        "stripe_customer_id, 'mp_' || k AS mixpanel_company_id, 'GROUND_TRUTH' AS identity_source FROM (SELECT *, REPLACE(account_id, 'SF_', '') AS k "
        "FROM accounts) WHERE CAST(k AS INTEGER) BETWEEN 1 AND 5",
        "account_id:s account_name:s master_customer_id:s customer_name:s stripe_customer_id:s mixpanel_company_id:s identity_source:s"),
    "dq_declared": Query(
        lambda spark, sf_dir: finish(declared_suite(StandIns(spark, sf_dir)).withColumnsRenamed(
            {"column": "col", "check": "kind"}), "model:s col:s kind:s failures:i should_warn:b should_error:b"),
        oracle.sql(declared_sql(), "model:s col:s kind:s failures:i should_warn:b should_error:b")),
    "usage_windows": paired(
        lambda s: usage.rolling_metrics(usage.densify(usage.customer_dates(s.users, trailing_days(s.spark, AS_OF, 121)),
                                                      usage.daily_totals(mapped(s)))),
        "SELECT *, prev AS total_events_prev_30d FROM rolling",
        f"{DAILY} total_events_30d:i key_actions_30d:i active_days_30d:i total_events_prev_30d:f0"),
    "product_usage": paired(lambda s: s.usage_plan, table("usage"), USAGE),
    "issue_resolution": paired(lambda s: s.chain, table("chain"), CHAIN),
    "customer_health_score": paired(lambda s: health_score(s, False), oracle.health_score_sql("no_usage"), HEALTH),
    "customer_health_score_mapped": paired(lambda s: health_score(s, True), oracle.health_score_sql("usage_trend"),
                                           HEALTH),
    "fact_customer_health": paired(
        lambda s: health.fact_customer_health(s.idmap, s.usage, s.product_events, s.users, s.tickets, s.invoices,
                                              AS_OF), table("fact_health"), FACT_HEALTH),
    "revenue_at_risk": paired(
        lambda s: health.revenue_at_risk(s.idmap, s.opportunities, s.usage, s.support_cost, AS_OF), table("risk"), RISK),
    "unified_customers": paired(lambda s: identity.unified_customers(s.billing), table("unified"), UNIFIED),
    "customer_360": paired(
        lambda s: activation.dim_customer_360(identity.unified_customers(s.billing), AS_OF), table("dim360"), DIM360),
    "activation_segment": paired(
        lambda s: activation.activation_customers(
            activation.dim_customer_360(identity.unified_customers(s.billing), AS_OF)), table("segment"), SEGMENT),
}
