"""Hand-made rows for every branch of the business rules."""

import dataclasses
import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.quality import fixture
from ledgerloom.plans import activation, finance, health, identity, ledgers, params, support, usage
from ledgerloom.schemas import staged_schema

AS_OF = "2024-02-20"
TODAY = dt.date(2024, 2, 20)


def ago(days):
    return TODAY - dt.timedelta(days=days)


def at(day):
    return dt.datetime.combine(day, dt.time())


@pytest.fixture
def staged(spark):
    def make(table, *records, scale=2):
        def value(v):
            return Decimal(str(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

        return fixture(spark, staged_schema(table, scale), [{k: value(v) for k, v in r.items()} for r in records])

    return make


@pytest.fixture
def idmap(spark):
    """Two known customers: one in every system, one in billing only."""
    return spark.createDataFrame(
        [("M1", "A1", "cus1", "INT1", "ZD1", "HV1", "JK1", "mp1", "One", "GROUND_TRUTH", dt.date(2023, 12, 31)),
         ("M2", None, "cus2", None, None, None, None, None, "Two", "STRIPE_ONLY", dt.date(2024, 2, 1))],
        "master_customer_id string, account_id string, stripe_customer_id string, intacct_customer_id string, "
        "zendesk_organization_id string, harvest_client_id string, jira_account_key string, "
        "mixpanel_company_id string, customer_name string, identity_source string, first_seen_at date")


# --- identity --------------------------------------------------------------------


def test_identity_map(spark, staged):
    seed = identity.ground_truth(spark, [("One", "HV1", "INT1", "JK1", "mp1", "A1", "cus1", "ZD1")])
    accounts = staged("sf_accounts", {"account_id": "A1", "account_name": "one", "created_date": dt.date(2022, 5, 1)},
                      {"account_id": "A2", "account_name": "Two", "created_date": dt.date(2022, 6, 1)},
                      {"account_id": None, "account_name": "nobody"})
    billing = staged("stripe_customers", {"customer_id": "cus1", "created_at": dt.datetime(2023, 1, 1, 9)},
                     {"customer_id": "cus9", "company_name": "Nine"})
    ledger = staged("intacct_customers", {"customer_id": "INT1", "created_date": dt.date(2021, 1, 1)},
                    {"customer_id": "INT9", "customer_name": "Nine"})
    orgs = staged("zendesk_organizations", {"organization_id": "ZD1", "account_id": "A1", "name": "known"},
                  {"organization_id": "ZD2", "account_id": "A2", "name": "Two desk"},
                  {"organization_id": "ZD3", "account_id": "A2", "name": None},
                  {"organization_id": "ZD4", "account_id": None, "name": "Loose"})
    rows = {r.master_customer_id: r for r in identity.identity_map(seed, accounts, billing, ledger, orgs).collect()}
    assert set(rows) == {"A1", "A2", "STRIPE:cus9", "INTACCT:INT9", "ZENDESK:ZD4"}
    one, two = rows["A1"], rows["A2"]
    assert (one.identity_source, one.source_system_count, one.has_ground_truth, one.has_conflicts) == (
        "GROUND_TRUTH", 7, True, False)
    assert (one.first_seen_at, one.last_seen_at) == (dt.date(2021, 1, 1), dt.date(2023, 1, 1))
    # Two linked organisations beat the bare account; the named one comes first; they conflict.
    assert (two.identity_source, two.customer_name, two.has_conflicts) == ("ZENDESK_LINKED", "Two desk", True)
    assert two.zendesk_organization_id == "ZD3" and two.source_system_count == 2
    assert rows["ZENDESK:ZD4"].first_seen_at is None


def test_user_map(staged, idmap):
    t = lambda n: dt.datetime(2024, 1, n)
    events = staged(
        "mixpanel_events", {"distinct_id": "u1", "company_id": "A1", "timestamp": t(9)},
        {"distinct_id": "u1", "company_id": "mp1", "timestamp": t(1)},
        {"distinct_id": "u1", "company_id": None, "timestamp": t(2)},
        {"distinct_id": "u2", "company_id": "nowhere", "timestamp": t(3)},
        {"distinct_id": None, "company_id": "mp1", "timestamp": t(3)})
    (row,) = identity.user_customer_map(events, idmap).collect()
    assert (row.user_identifier, row.company_id, row.mapping_method, row.mapping_confidence) == (
        "u1", "mp1", "MIXPANEL_COMPANY_ID", "HIGH")
    assert (row.has_conflict, row.mapped_customer_count, row.company_id_count) == (0, 1, 2)


# --- ledgers ---------------------------------------------------------------------


def test_unified_revenue_branches(staged, idmap):
    day = dt.date(2024, 2, 1)
    invoices = staged(
        "stripe_invoices",
        {"invoice_id": "i1", "customer_id": "cus1", "status": "paid", "paid_at": at(day), "amount_paid_gbp": 10,
         "invoice_date": ago(40)},
        {"invoice_id": "i2", "customer_id": "cus2", "status": "open", "amount_due_gbp": 5, "invoice_date": day},
        {"invoice_id": "i3", "customer_id": "cus1", "status": "void", "amount_due_gbp": 5, "invoice_date": day},
        {"invoice_id": "i4", "customer_id": "cus1", "status": "paid", "paid_at": None, "amount_paid_gbp": 7},
        {"invoice_id": "i5", "customer_id": "other", "status": "open", "amount_due_gbp": 5, "invoice_date": day},
        {"invoice_id": "i6", "customer_id": None, "status": "open", "amount_due_gbp": 5, "invoice_date": day})
    charges = staged("stripe_charges", {"charge_id": "c1", "customer_id": "cus1", "invoice_id": "i1"})
    refunds = staged("stripe_refunds",
                     {"refund_id": "r1", "charge_id": "c1", "created_at": at(day), "amount_gbp": 3, "reason": None},
                     {"refund_id": "r2", "charge_id": None, "created_at": at(day), "amount_gbp": 3},
                     {"refund_id": "r3", "charge_id": "c1", "created_at": at(day), "amount_gbp": None})
    disputes = staged("stripe_disputes",
                      {"dispute_id": "d1", "charge_id": "c1", "created_at": at(day), "amount_gbp": -4, "status": "lost"},
                      {"dispute_id": "d2", "charge_id": "c1", "created_at": at(day), "amount_gbp": 4, "status": "won"})
    revrec = staged("intacct_revenue_recognition",
                    {"revrec_id": "g1", "customer_id": "INT1", "month": "2024-02", "booked_arr_gbp": 100,
                     "recognized_revenue_gbp": 8, "deferred_revenue_gbp": 2},
                    {"revrec_id": "g2", "customer_id": "INT1", "month": "2024-13", "recognized_revenue_gbp": 1,
                     "deferred_revenue_gbp": 0},
                    {"revrec_id": "g3", "customer_id": "INT1", "month": "2024-01", "recognized_revenue_gbp": None})
    rows = {r.source_record_id: r for r in
            ledgers.unified_revenue(invoices, charges, refunds, disputes, revrec, idmap).collect()}
    assert set(rows) == {"i1", "i2", "r1", "d1", "g1", "g1_deferred", "g2"}
    assert (rows["i1"].revenue_type, rows["i1"].cash_status, rows["i1"].revenue_date) == ("CASH", "PAID", day)
    assert (rows["i2"].revenue_type, rows["i2"].master_customer_id, rows["i2"].is_accounts_receivable) == ("AR", "M2", 1)
    assert (rows["r1"].amount_gbp, rows["r1"].amount_gbp_signed, rows["r1"].payment_status) == (3, -3, "REFUND")
    assert (rows["d1"].revenue_category, rows["d1"].amount_gbp_signed, rows["d1"].is_cash_outflow) == ("CHARGEBACK", -4, 1)
    assert (rows["g1"].mrr_gbp, rows["g1"].arr_gbp, rows["g1"].is_recurring) == (8, 100, 1)
    assert (rows["g1_deferred"].amount_gbp, rows["g1_deferred"].arr_gbp) == (2, None)
    assert rows["g2"].revenue_date is None
    assert rows["i1"].revenue_event_id == hashlib.md5(b"STRIPE-i1").hexdigest()
    assert {r.source_record_id for r in ledgers.invoice_cash(invoices).collect()} == {"i1"}
    assert ledgers.invoice_ar(invoices).count() == 3
    assert ledgers.refund_cash(refunds, charges).count() == 2 and ledgers.dispute_cash(disputes, charges).count() == 1
    assert ledgers.gaap_recognized(revrec).count() == 2 and ledgers.gaap_deferred(revrec).count() == 1


def test_unified_cost_branches(staged, idmap):
    projects = staged("harvest_projects", {"project_id": "p1", "client_id": "HV1"}, {"project_id": "p2", "client_id": "??"})
    issues = staged("jira_issues", {"issue_id": "j1", "account_id": "JK1", "time_spent_hours": 2},
                    {"issue_id": "j2", "account_id": "JK1", "zendesk_ticket_id": "t1", "time_spent_hours": None},
                    {"issue_id": "j3", "account_id": "A1", "time_spent_hours": 1})
    work = staged(
        "harvest_time_entries",
        {"entry_id": "h1", "project_id": "p1", "hours": 2, "cost_rate_gbp_per_hour": 30, "billable_rate_gbp_per_hour": 1},
        {"entry_id": "h2", "project_id": "p2", "linked_jira_issue_id": "j1", "hours": 1, "cost_rate_gbp_per_hour": 30,
         "billable_rate_gbp_per_hour": 0},
        {"entry_id": "h3", "project_id": "p2", "linked_jira_issue_id": None, "hours": 1, "cost_rate_gbp_per_hour": 30})
    tickets = staged("zendesk_tickets", {"ticket_id": "t1", "organization_id": "ZD1"})
    desk = staged("zendesk_time_entries", *[
        {"time_entry_id": f"z{tier}", "ticket_id": "t1", "time_spent_minutes": 30, "tier": tier}
        for tier in (1, 2, 3, 4, None)], {"time_entry_id": "lost", "ticket_id": "t9", "time_spent_minutes": 30}, scale=0)
    owned = ledgers.owned_issues(issues, idmap)
    owner = ledgers.issue_customer(owned)
    cost = ledgers.unified_cost(ledgers.delivery_costs(work, projects, idmap, owner),
                                ledgers.support_costs(desk, tickets, idmap),
                                ledgers.engineering_costs(owned))
    rows = {r.source_record_id: r for r in cost.collect()}
    assert set(rows) == {"h1", "h2", "z1", "z2", "z3", "z4", "zNone", "j1", "j2"}
    assert (rows["h1"].cost_gbp, rows["h1"].work_category) == (60, "BILLABLE")
    assert (rows["h2"].master_customer_id, rows["h2"].work_category) == ("M1", "NON_BILLABLE")
    assert [rows[f"z{t}"].cost_gbp for t in (1, 2, 3, 4, None)] == [
        Decimal("12.5"), Decimal("17.5"), 25, 15, 15]
    assert rows["zNone"].role_or_tier == "Support Tier Unknown" and rows["z1"].role_or_tier == "Support Tier 1"
    assert rows["z1"].work_category == "GENERAL_SUPPORT"
    assert (rows["j1"].cost_gbp, rows["j2"].cost_gbp, rows["j2"].linked_ticket_id) == (120, 0, "t1")
    # The switch matches issues by account id instead.
    assert {r.issue_id for r in ledgers.issue_customer(ledgers.owned_issues(issues, idmap, "account_id")).collect()} == {"j3"}


def test_mrr_snapshot(staged, idmap):
    subs = staged("stripe_subscriptions",
                  {"subscription_id": "s1", "customer_id": "cus1", "mrr_gbp": 7.5, "current_period_start": TODAY},
                  {"subscription_id": None, "customer_id": "cus1"}, {"subscription_id": "s2", "customer_id": "?"})
    (row,) = ledgers.mrr_snapshot(subs, idmap).collect()
    assert (row.mrr_gbp, row.arr_gbp, row.snapshot_date) == (Decimal("7.5"), 90, TODAY)
    assert row.mrr_arr_snapshot_id == hashlib.md5(b"s1-2024-02-20").hexdigest()


# --- finance ---------------------------------------------------------------------


def test_revenue_gap(staged, idmap):
    opps = staged(
        "sf_opportunities",
        {"opportunity_id": "o1", "account_id": "A1", "stage": "Closed Won", "arr_booked_gbp": 120,
         "contract_start_date": dt.date(2023, 1, 15), "contract_end_date": None},
        {"opportunity_id": "o2", "account_id": "A1", "stage": "Closed Won", "arr_booked_gbp": 12,
         "contract_start_date": dt.date(2000, 1, 1), "contract_end_date": dt.date(2030, 1, 1)},
        {"opportunity_id": "o3", "account_id": "A1", "stage": "Open", "arr_booked_gbp": 12,
         "contract_start_date": dt.date(2023, 1, 1)},
        {"opportunity_id": "o4", "account_id": "A1", "stage": "Closed Won", "arr_booked_gbp": 12,
         "contract_start_date": dt.date(2023, 5, 1), "contract_end_date": dt.date(2023, 1, 1)})
    months = finance.expand_months(finance.contract_months(opps, idmap))
    per = {r.opportunity_id: r.n for r in months.groupBy("opportunity_id").agg(F.count("*").alias("n")).collect()}
    assert per == {"o1": 13, "o2": 240}  # an open end runs 13 months; the generator stops at 240
    lifted = dataclasses.replace(params.THRESHOLDS, contract_months_cap=None)
    every = finance.expand_months(finance.contract_months(opps, idmap, lifted), lifted)
    assert every.filter("opportunity_id = 'o2'").count() == 361
    invoices = staged("stripe_invoices", {"invoice_id": "i1", "customer_id": "cus1", "invoice_date": dt.date(2023, 1, 20)},
                      {"invoice_id": "i2", "customer_id": "cus2", "invoice_date": dt.date(2023, 3, 20)},
                      {"invoice_id": "i3", "customer_id": "cus2", "invoice_date": None})
    lines = staged("stripe_invoice_line_items", {"invoice_id": "i1", "amount_gbp": 4}, {"invoice_id": "i1", "amount_gbp": None},
                   {"invoice_id": "i2", "amount_gbp": 6}, {"invoice_id": "i3", "amount_gbp": 6})
    gap = {(r.master_customer_id, str(r.revenue_month)): r for r in
           finance.revenue_gap(opps.filter("opportunity_id = 'o1'"), lines, invoices, idmap).collect()}
    assert len(gap) == 14
    assert gap[("M1", "2023-01-01")].revenue_gap_gbp == 6 and gap[("M2", "2023-03-01")].revenue_gap_gbp == -6
    assert gap[("M2", "2023-03-01")].customer_name == "Two"


LEDGER_COST = ("master_customer_id string, activity_date date, cost_gbp decimal(28,6), hours decimal(28,6), "
               "work_type string, source_system string, linked_ticket_id string")
LEDGER_REVENUE = ("master_customer_id string, revenue_date date, revenue_month date, revenue_type string, "
                  "revenue_category string, amount_gbp decimal(28,6)")


def cost_row(customer, cost, kind="DELIVERY", ticket=None, day=dt.date(2024, 1, 5), hours=1):
    system = {"DELIVERY": "HARVEST", "SUPPORT": "ZENDESK", "ENGINEERING": "JIRA"}[kind]
    return (customer, day, Decimal(cost), Decimal(hours), kind, system, ticket)


def revenue_row(customer, amount, category="RECOGNIZED", day=dt.date(2024, 1, 1), kind="GAAP"):
    return (customer, day, day.replace(day=1), kind, category, Decimal(amount))


def test_profitability_pool_and_margin(spark, idmap):
    cost = spark.createDataFrame([cost_row("M1", 40), cost_row("M1", 100, "ENGINEERING"),
                                  cost_row("M1", 7, "ENGINEERING", ticket="t")], LEDGER_COST)
    revenue = spark.createDataFrame([revenue_row("M1", 300), revenue_row("M2", 100), revenue_row("M2", 9, "DEFERRED")],
                                    LEDGER_REVENUE)
    rows = {r.master_customer_id: r for r in finance.customer_profitability(revenue, cost, idmap).collect()}
    one, two = rows["M1"], rows["M2"]
    assert (one.total_direct_cost_gbp, one.engineering_direct_cost_gbp, one.shared_engineering_pool_gbp) == (47, 7, 100)
    assert one.allocated_shared_engineering_cost_gbp == pytest.approx(75)
    assert one.gross_margin_gbp == pytest.approx(178) and one.gross_margin_pct == pytest.approx(178 / 3)
    # No cost rows in the month: the customer sees no pool, so the shares need not add up.
    assert (two.shared_engineering_pool_gbp, two.allocated_shared_engineering_cost_gbp, two.gross_margin_pct) == (0, 0, 100)


def test_month_basis_is_the_allocation_basis(spark, rows):
    """Null customers earn nothing, rows without a date have no month, repeated rows add up."""
    cost = spark.createDataFrame([cost_row("M1", 40), cost_row("M3", 5), cost_row(None, 2)], LEDGER_COST)
    cost = cost.unionByName(cost.limit(1).withColumn("activity_date", F.lit(None).cast("date")))
    revenue = spark.createDataFrame([revenue_row("M1", 300), revenue_row("M1", 300), revenue_row("M2", 100), revenue_row(None, 7),
                                     revenue_row("M2", 9, "DEFERRED"), revenue_row("M2", 4, day=dt.date(2024, 2, 2))], LEDGER_REVENUE)
    months = finance.revenue_monthly(revenue)
    expected = finance.allocation_basis(finance.active_spine(months, finance.cost_monthly(cost)), months)
    got = finance.month_basis(revenue, cost)
    assert rows(got, *expected.columns) == rows(expected) and got.schema["total_revenue_in_month_gbp"] == expected.schema["total_revenue_in_month_gbp"]
    assert {r.master_customer_id: r.gaap_recognized_revenue_gbp for r in got.filter("profitability_month < date'2024-02-01'").collect()} == {
        "M1": 600, "M2": 100, "M3": 0, None: 0}


def test_ltv(spark, staged, idmap):
    cost = spark.createDataFrame([cost_row("M1", 500), cost_row("M1", 50, "ENGINEERING")], LEDGER_COST)
    revenue = spark.createDataFrame([revenue_row("M1", 2000), revenue_row("M1", 100, "DEFERRED"),
                                     revenue_row("M2", 10, day=dt.date(2023, 12, 1))], LEDGER_REVENUE)
    snapshots = spark.createDataFrame(
        [("M1", "s1", dt.date(2024, 2, 1), Decimal(10)), ("M1", "s1", dt.date(2024, 2, 9), Decimal(30)),
         ("M1", "s1", dt.date(2024, 1, 9), Decimal(50))],
        "master_customer_id string, subscription_id string, snapshot_date date, mrr_gbp decimal(28,6)")
    opps = staged("sf_opportunities", {"opportunity_id": "o", "account_id": "A1", "stage": "Closed Won",
                                       "close_date": dt.date(2023, 3, 1)})
    rows = {r.master_customer_id: r for r in
            finance.customer_ltv(idmap, revenue, cost, snapshots, opps, AS_OF).collect()}
    one, two = rows["M1"], rows["M2"]
    assert (one.commercial_current_mrr_gbp, one.commercial_avg_monthly_mrr_gbp) == (30, 40)  # latest snapshot wins
    assert one.customer_tenure_months == 2 and one.avg_monthly_margin_gbp == pytest.approx(800)
    assert one.allocated_shared_engineering_cost_gbp == pytest.approx(50)
    assert (one.projected_commercial_ltv_gbp, one.ltv_to_cac_ratio, one.cac_payback_months) == (1080, 1.08, 1.25)
    assert (one.profitability_tier, one.customer_status) == ("SILVER", "ACTIVE")
    assert (two.customer_tenure_months, two.customer_status, two.profitability_tier) == (0, "RECENTLY_CHURNED", "BRONZE")
    assert two.avg_monthly_revenue_gbp == 10 and two.acquisition_date is None
    assert one.projected_gaap_ltv_gbp is None


@pytest.mark.parametrize("margin, tier", [(10001, "PLATINUM"), (10000, "GOLD"), (5000, "SILVER"), (1000, "BRONZE"),
                                          (0, "UNPROFITABLE"), (None, "UNPROFITABLE")])
def test_tiers(spark, margin, tier):
    assert spark.range(1).select(finance._tier(F.lit(margin).cast("double")).alias("t")).first().t == tier


def test_project_performance(staged, idmap):
    projects = staged("harvest_projects", {"project_id": "p1", "client_id": "HV1", "name": "Build"},
                      {"project_id": "p2", "client_id": "HV1", "name": "Idle"})
    work = staged("harvest_time_entries",
                  {"entry_id": "1", "project_id": "p1", "hours": 9, "cost_rate_gbp_per_hour": 10, "date": ago(10)},
                  {"entry_id": "2", "project_id": "p1", "hours": None, "cost_rate_gbp_per_hour": 10, "date": ago(5)})
    opps = staged("sf_opportunities",
                  {"opportunity_id": "old", "account_id": "A1", "stage": "Closed Won", "arr_booked_gbp": 1,
                   "contract_start_date": ago(400), "close_date": ago(400)},
                  {"opportunity_id": "new", "account_id": "A1", "stage": "Closed Won", "arr_booked_gbp": 100,
                   "contract_start_date": ago(20), "contract_end_date": ago(-80), "close_date": ago(30)})
    rows = {r.harvest_project_id: r for r in
            finance.project_performance(projects, work, opps, idmap, AS_OF).collect()}
    busy, idle = rows["p1"], rows["p2"]
    assert (busy.budget_utilization_pct, busy.project_completion_pct, busy.burn_rate_gbp_per_day) == (0.9, 0.2, 9.0)
    assert (busy.projected_total_cost_gbp, busy.projected_overrun_gbp, busy.is_at_risk) == (900.0, 800.0, True)
    assert (idle.actual_cost_to_date_gbp, idle.burn_rate_gbp_per_day, idle.is_at_risk) == (0, None, False)


# --- usage -----------------------------------------------------------------------


def test_product_usage(spark, staged, idmap):
    users = spark.createDataFrame([("u1", "M1"), ("u2", "M1")], "user_identifier string, master_customer_id string")
    stamp = lambda n: at(ago(n)) + dt.timedelta(hours=3)
    events = staged(
        "mixpanel_events", {"event_id": "1", "event_name": "Purchase Done", "distinct_id": "u1", "timestamp": stamp(0)},
        {"event_id": "1", "event_name": "Purchase Done", "distinct_id": "u1", "timestamp": stamp(0)},
        {"event_id": "2", "event_name": "view", "distinct_id": "u2", "timestamp": stamp(29)},
        {"event_id": "3", "event_name": "view", "distinct_id": "u2", "timestamp": stamp(30)},
        {"event_id": "4", "event_name": "view", "distinct_id": "u1", "timestamp": stamp(59)},
        {"event_id": "5", "event_name": "view", "distinct_id": "u2", "timestamp": stamp(121)},
        {"event_id": "6", "event_name": "view", "distinct_id": "nobody", "timestamp": stamp(0)})
    rows = {r.event_date: r for r in usage.product_usage(events, users, idmap, AS_OF).collect()}
    assert len(rows) == 121
    last = rows[TODAY]
    assert (last.daily_events, last.daily_key_actions, last.daily_active_users) == (1, 1, 1)
    assert (last.monthly_active_users_30d, last.total_events_30d, last.active_days_30d) == (2, 2, 2)
    assert (last.stickiness_ratio, last.avg_events_per_active_day_30d, last.usage_trend_pct_30d) == (0.5, 1.0, 0.0)
    assert rows[ago(1)].monthly_active_users_30d == 1 and rows[ago(61)].is_monthly_active == 0


# --- support ---------------------------------------------------------------------


@pytest.fixture
def chain(staged, idmap):
    tickets = staged(
        "zendesk_tickets",
        {"ticket_id": "t1", "organization_id": "ZD1", "created_at": at(ago(20)), "status": "solved", "severity": "Critical"},
        {"ticket_id": "t2", "organization_id": "ZD1", "created_at": at(ago(50)), "status": "open", "severity": None},
        {"ticket_id": "t3", "organization_id": "??", "created_at": at(ago(5)), "status": "open"})
    events = staged(
        "zendesk_ticket_events",
        {"ticket_id": "t1", "event_type": "comment", "actor": "requester", "timestamp": at(ago(19))},
        {"ticket_id": "t1", "event_type": "comment", "actor": "agent", "timestamp": at(ago(18))},
        {"ticket_id": "t1", "event_type": "status_change", "actor": "agent", "timestamp": at(ago(17))},
        {"ticket_id": "t1", "event_type": "status_change", "actor": "agent", "timestamp": at(ago(11))},
        {"ticket_id": "t2", "event_type": "status_change", "actor": "agent", "timestamp": at(ago(11))})
    issues = staged(
        "jira_issues",
        {"issue_id": "j1", "zendesk_ticket_id": "t1", "time_spent_hours": 10, "created_at": at(ago(18)),
         "resolved_at": at(ago(13))},
        {"issue_id": "j2", "zendesk_ticket_id": "t1", "time_spent_hours": None, "created_at": at(ago(18))},
        {"issue_id": "j3", "zendesk_ticket_id": None, "time_spent_hours": 99})
    work = staged("harvest_time_entries", {"entry_id": "1", "linked_jira_issue_id": "j1", "hours": 2,
                                           "cost_rate_gbp_per_hour": 50})
    desk = staged("zendesk_time_entries", {"time_entry_id": "1", "ticket_id": "t1", "time_spent_minutes": 60, "tier": 1})
    return support.issue_resolution(support.resolution_chain(tickets, events, issues, work, desk, idmap, AS_OF))


def test_resolution_chain(chain):
    rows = {(r.zendesk_ticket_id, r.jira_issue_id): r for r in chain.collect()}
    assert set(rows) == {("t1", "j1"), ("t1", "j2"), ("t2", None)}
    done, pending, plain = rows[("t1", "j1")], rows[("t1", "j2")], rows[("t2", None)]
    assert done.ticket_first_response_at == at(ago(18)) and done.ticket_solved_at == at(ago(11))
    assert (done.resolution_time_days, done.ticket_to_issue_days, done.issue_resolution_days, done.ticket_age_days) == (7, 2, 5, 9)
    assert (done.total_support_cost_gbp, done.total_engineering_cost_gbp, done.total_cost_gbp) == (25, 700, 725)
    assert done.resolution_speed_category == "FAST" and done.impact_score == pytest.approx(100 + 72.5 + 7)
    # Support cost repeats on each issue of the ticket; an unresolved row has no impact score.
    assert pending.total_support_cost_gbp == 25 and pending.impact_score is None
    assert pending.resolution_speed_category == "VERY_SLOW" and pending.is_resolved == 0
    assert plain.ticket_solved_at is None and plain.ticket_age_days == 50 and plain.has_linked_issue == 0
    assert plain.resolution_chain_id == hashlib.md5(b"t2-NO_JIRA").hexdigest()


@pytest.mark.parametrize("days, label", [(7, "FAST"), (8, "NORMAL"), (31, "SLOW"), (91, "VERY_SLOW"), (None, "VERY_SLOW")])
def test_speed_classes(spark, days, label):
    assert spark.range(1).select(support._speed(F.lit(days).cast("int")).alias("s")).first().s == label


# --- health and risk -------------------------------------------------------------


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def n(v):
    return F.lit(v).cast("double")


def test_component_scores(spark):
    assert [value(spark, health.revenue_score(n(v))) for v in (20, 10, 0, -10, -11, None)] == [30, 25, 20, 10, 0, 0]
    cases = {(0, 5, 0): 25, (3, 5, 1): 5, (6, 5, 0): 10, (4, 5, 0): 20, (5, 5, 0): 15, (None, None, None): 15}
    assert {k: value(spark, health.support_score(*map(n, k))) for k in cases} == cases
    cases = {(0, 0): 25, (0, 2): 20, (1, 0): 10, (2, 0): 0, (None, None): 25}
    assert {k: value(spark, health.payment_score(*map(n, k))) for k in cases} == cases
    cases = {(11, 10): 20, (9, 10): 15, (5, 10): 10, (4, 10): 0, (None, None): 0}
    assert {k: value(spark, health.usage_score(*map(n, k))) for k in cases} == cases


def test_risk_bands(spark):
    bands = [value(spark, health._banded(F.lit(s), health.RISK_CLASSES, health.BEST_CLASS)) for s in (40, 60, 80, 81)]
    assert bands == ["CHURN_RISK", "AT_RISK", "HEALTHY", "EXPANSION_OPPORTUNITY"]
    odds = [value(spark, health._banded(F.lit(s), health.CHURN_PROBABILITY, health.LOWEST_PROBABILITY))
            for s in (30, 50, 70, 71)]
    assert odds == [0.80, 0.40, 0.10, 0.01]


@pytest.fixture
def invoices(staged):
    return staged(
        "stripe_invoices",
        {"invoice_id": "i1", "customer_id": "cus1", "status": "open", "invoice_date": ago(30), "amount_due_gbp": 100},
        {"invoice_id": "i2", "customer_id": "cus1", "status": "open", "invoice_date": ago(10), "amount_due_gbp": 300},
        {"invoice_id": "i3", "customer_id": "cus1", "status": "paid", "invoice_date": ago(40), "paid_at": at(ago(20))},
        {"invoice_id": "i4", "customer_id": "cus1", "status": "paid", "invoice_date": ago(200), "paid_at": at(ago(100))})


def test_payment_behaviour_and_dso(invoices, idmap):
    (row,) = health.payment_behaviour(invoices, idmap, AS_OF).collect()
    assert (row.open_invoices_count, row.open_invoices_30d_plus_count, row.open_invoices_30d_plus_amount_gbp) == (2, 1, 100)
    assert (row.max_open_invoice_age_days, row.avg_days_to_pay_90d, row.late_paid_invoices_90d) == (30, 20.0, 1)
    (row,) = health.dso(invoices, idmap, AS_OF).collect()
    assert row.days_sales_outstanding == pytest.approx((100 * 30 + 300 * 10) / 400)


def test_health_score_and_usage_switch(spark, staged, invoices, idmap, chain):
    monthly = spark.createDataFrame([("M1", dt.date(2024, 2, 1), Decimal(120)), ("M1", dt.date(2024, 1, 1), Decimal(100))],
                                    "master_customer_id string, snapshot_month date, commercial_mrr_gbp decimal(28,6)")
    revenue = spark.createDataFrame([revenue_row("M1", 5), revenue_row("M1", 7, day=dt.date(2024, 2, 1))], LEDGER_REVENUE)
    events = staged("mixpanel_events", *[{"event_id": str(i), "distinct_id": "u1", "timestamp": at(ago(i))} for i in range(3)])
    users = spark.createDataFrame([("u1", "M1")], "user_identifier string, master_customer_id string")
    build = lambda u: {r.master_customer_id: r for r in health.customer_health_score(health.health_components(
        idmap, monthly, revenue, invoices, chain, AS_OF, u), AS_OF).collect()}
    plain, mapped = build(None), build(health.usage_trend(events, AS_OF, users))
    one, two = plain["M1"], plain["M2"]
    assert (one.revenue_health_score, one.support_health_score, one.payment_health_score, one.usage_health_score) == (30, 5, 10, 0)
    assert (one.health_score, one.risk_category, one.churn_probability) == (45, "AT_RISK", 0.40)
    assert (one.gaap_recognized_current_month_gbp, one.gaap_recognized_prev_month_gbp) == (7, 5)
    assert one.support_cost_30d == 725 + 25  # the ticket's own cost counts once per issue
    assert (two.health_score, two.usage_events_30d) == (0 + 15 + 25 + 0, None)
    assert (mapped["M1"].usage_health_score, mapped["M1"].usage_days_30d) == (20, 3)
    per_user = health.usage_trend(events, AS_OF)
    assert per_user.filter("master_customer_id is null and events_last_30d = 3").count() == 1


def usage_rows(spark, *days):
    return spark.createDataFrame([("M1", ago(n), 2, active, 1.5) for n, active in days],
                                 "master_customer_id string, event_date date, monthly_active_users_30d long, "
                                 "active_days_30d long, usage_trend_pct_30d double")


def test_fact_customer_health(spark, staged, invoices, idmap):
    tickets = staged("zendesk_tickets", {"ticket_id": "t1", "organization_id": "ZD1", "status": None, "severity": "High"},
                     {"ticket_id": "t2", "organization_id": "ZD1", "status": "open", "priority": "urgent"},
                     {"ticket_id": "t3", "organization_id": "ZD1", "status": "solved", "priority": "urgent"},
                     {"ticket_id": "t4", "organization_id": "ZD1", "status": "open", "priority": "low"})
    events = staged("mixpanel_events", {"event_name": "User LOGIN", "distinct_id": "u1", "timestamp": at(ago(4))},
                    {"event_name": "view", "distinct_id": "u1", "timestamp": at(ago(1))})
    users = spark.createDataFrame([("u1", "M1")], "user_identifier string, master_customer_id string")
    rows = {r.master_customer_id: r for r in health.fact_customer_health(
        idmap, usage_rows(spark, (1, 1), (0, 30)), events, users, tickets, invoices, AS_OF).collect()}
    one, two = rows["M1"], rows["M2"]
    assert (one.usage_score, one.tickets_score, one.late_payment_score) == (100.0, 50, 25.0)
    assert one.health_score == pytest.approx(50 - 15 - 5) and one.health_category == "CHURN_RISK"
    assert (one.last_login_date, one.days_sales_outstanding, one.avg_days_to_pay_90d) == (ago(4), 15.0, 20.0)
    assert (two.health_score, two.last_login_date, two.active_users_l30d) == (0, None, 0)


def test_revenue_at_risk(spark, staged, idmap):
    won = {"account_id": "A1", "stage": "Closed Won"}
    opps = staged("sf_opportunities",
                  {**won, "arr_booked_gbp": 50000, "contract_start_date": ago(10), "contract_end_date": None},
                  {**won, "arr_booked_gbp": 1, "contract_start_date": ago(10), "contract_end_date": TODAY},
                  {**won, "arr_booked_gbp": 9, "contract_start_date": ago(90), "contract_end_date": ago(1)},
                  {**won, "arr_booked_gbp": 9, "contract_start_date": ago(-1)})
    cost = spark.createDataFrame([cost_row("M1", 1, "SUPPORT", day=ago(30), hours=12),
                                  cost_row("M1", 1, "SUPPORT", day=ago(31), hours=10)], LEDGER_COST)
    rows = {r.master_customer_id: r for r in health.revenue_at_risk(
        idmap, opps, usage_rows(spark, (121, 99), (120, 10), (30, 10), (29, 99), (0, 8)), cost, AS_OF).collect()}
    one, two = rows["M1"], rows["M2"]
    assert (one.booked_arr_gbp, one.is_high_value, one.active_days_30d_prev_3mo_avg) == (50001, True, 10.0)
    assert (one.active_days_change_ratio, one.is_declining_usage, one.is_revenue_at_risk) == (-0.2, True, True)
    assert (one.support_hours_30d, one.is_support_spike) == (12, True)
    assert (two.active_days_change_ratio, two.is_declining_usage, two.is_revenue_at_risk) == (None, False, False)


def test_activation(staged):
    billing = staged("stripe_customers",
                     {"customer_id": "c1", "email_domain": "a.example", "company_name": "A", "created_at": at(ago(31))},
                     {"customer_id": "c2", "email_domain": "b.example", "company_name": "B", "created_at": at(ago(30))},
                     {"customer_id": "c3", "email_domain": "c.example", "company_name": None, "created_at": at(ago(99))},
                     {"customer_id": "c4", "email_domain": None, "company_name": "D", "created_at": at(ago(99))})
    dim = activation.dim_customer_360(identity.unified_customers(billing), AS_OF)
    assert dim.count() == 3
    (row,) = activation.activation_customers(dim).collect()
    assert (row.email_domain, row.segment) == ("a.example", "high_engagement")
    assert row.customer_key == hashlib.md5(b"a.example-c1").hexdigest()
