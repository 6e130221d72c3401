"""Unified revenue and cost ledgers and the subscription MRR snapshot.

The branches of one source are shaped in a single scan, branches with the same
customer key are united before the identity join, and keys are computed last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import trunc_date, try_date
from ..functions.keys import surrogate_key
from ..functions.scalars import flag, money
from ..operators.relational import attribute, lookup, union_all, unmatched, with_may_match
from ..operators.session import cut_lineage
from .params import RATES, Rates

REVENUE_FIELDS = ["source_record_id", "revenue_date", "revenue_type", "revenue_category", "amount_gbp",
                  "amount_gbp_signed", "event_direction", "cash_status", "mrr_gbp", "arr_gbp", "payment_status",
                  "subscription_id", "invoice_id", "charge_id", "source_system"]

_TYPES = {"revenue_date": "date", "amount_gbp": "decimal(28,6)", "amount_gbp_signed": "decimal(28,6)",
          "mrr_gbp": "decimal(28,6)", "arr_gbp": "decimal(28,6)"}


def _event(customer: Column, **values) -> list[Column]:
    """Revenue layout from keyword columns; missing ones are typed nulls."""
    def col(name: str) -> Column:
        value = values.get(name)
        value = value if isinstance(value, Column) else F.lit(value)
        return value.cast(_TYPES.get(name, "string")).alias(name)

    return [customer.alias("customer_id"), *[col(f) for f in REVENUE_FIELDS]]


def _map_of(idmap: DataFrame, key: str) -> DataFrame:
    return idmap.select(key, "master_customer_id")


def invoice_events(invoices: DataFrame, statuses: tuple[str, ...] = ("paid", "open")) -> DataFrame:
    """Paid invoices as cash and open invoices as receivables, in one scan."""
    paid = (F.col("status") == "paid") & F.col("paid_at").isNotNull()
    open_ = F.col("status") == "open"
    wanted = F.lit(False)
    if "paid" in statuses:
        wanted = wanted | paid
    if "open" in statuses:
        wanted = wanted | open_

    def pick(if_paid, if_open) -> Column:
        return F.when(paid, if_paid).otherwise(if_open)

    amount = pick(F.col("amount_paid_gbp"), F.col("amount_due_gbp"))
    return invoices.filter(wanted).select(*_event(
        F.col("customer_id"),
        source_record_id=F.col("invoice_id"),
        revenue_date=pick(F.col("paid_at").cast("date"), F.col("invoice_date")),
        revenue_type=pick(F.lit("CASH"), F.lit("AR")), revenue_category="INVOICE",
        amount_gbp=amount, amount_gbp_signed=amount, event_direction="CREDIT",
        cash_status=pick(F.lit("PAID"), F.lit("OUTSTANDING")), payment_status=F.col("status"),
        subscription_id=F.col("subscription_id"), invoice_id=F.col("invoice_id"), source_system="STRIPE"))


def invoice_cash(invoices: DataFrame) -> DataFrame:
    return invoice_events(invoices, ("paid",))


def invoice_ar(invoices: DataFrame) -> DataFrame:
    return invoice_events(invoices, ("open",))


def _refunds(refunds: DataFrame) -> DataFrame:
    return refunds.filter(F.col("amount_gbp").isNotNull()).select(
        F.col("refund_id").alias("record_id"), "charge_id", F.col("created_at").cast("date").alias("day"),
        money("amount_gbp").alias("amount"), F.lit("REFUND").alias("category"),
        F.coalesce("reason", F.lit("REFUND")).alias("status"))


def _lost_disputes(disputes: DataFrame) -> DataFrame:
    return disputes.filter(F.col("amount_gbp").isNotNull() & (F.col("status") == "lost")).select(
        F.col("dispute_id").alias("record_id"), "charge_id", F.col("created_at").cast("date").alias("day"),
        money("amount_gbp").alias("amount"), F.lit("CHARGEBACK").alias("category"),
        F.coalesce("status", F.lit("DISPUTE")).alias("status"))


def _cash_out(outflows: DataFrame, charges: DataFrame) -> DataFrame:
    """Outflows find their customer and invoice through the charge."""
    charge = charges.select(F.col("charge_id").alias("__charge"), "customer_id", "invoice_id")
    joined = lookup(outflows, charge, "charge_id", "__charge", spread_by="record_id")
    return joined.select(*_event(
        F.col("customer_id"),
        source_record_id=F.col("record_id"), revenue_date=F.col("day"), revenue_type="CASH",
        revenue_category=F.col("category"), amount_gbp=F.abs("amount"), amount_gbp_signed=-F.abs("amount"),
        event_direction="DEBIT", cash_status="SETTLED", payment_status=F.col("status"),
        invoice_id=F.col("invoice_id"), charge_id=F.col("charge_id"), source_system="STRIPE"))


def refund_cash(refunds: DataFrame, charges: DataFrame) -> DataFrame:
    return _cash_out(_refunds(refunds), charges)


def dispute_cash(disputes: DataFrame, charges: DataFrame) -> DataFrame:
    return _cash_out(_lost_disputes(disputes), charges)


def gaap_events(revrec: DataFrame, categories: tuple[str, ...] = ("RECOGNIZED", "DEFERRED")) -> DataFrame:
    """Recognized and deferred revenue of a month, exploded from one scan."""
    month_start = try_date(F.concat("month", F.lit("-01")))

    def branch(category: str, keep: Column, amount: str, record: Column, mrr: Column, arr: Column) -> Column:
        return F.when(keep, F.struct(
            F.lit(category).alias("category"), record.alias("record_id"), money(amount).alias("amount"),
            money(mrr).alias("mrr"), money(arr).alias("arr")))

    none = F.lit(None)
    branches = []
    if "RECOGNIZED" in categories:
        branches.append(branch("RECOGNIZED", F.col("recognized_revenue_gbp").isNotNull(), "recognized_revenue_gbp",
                               F.col("revrec_id"), F.col("recognized_revenue_gbp"), F.col("booked_arr_gbp")))
    if "DEFERRED" in categories:
        branches.append(branch("DEFERRED", F.col("deferred_revenue_gbp") > 0, "deferred_revenue_gbp",
                               F.concat("revrec_id", F.lit("_deferred")), none, none))
    rows = revrec.select("customer_id", month_start.alias("day"), F.explode(F.array(*branches)).alias("e")).filter("e is not null")
    return rows.select(*_event(
        F.col("customer_id"),
        source_record_id=F.col("e.record_id"), revenue_date=F.col("day"), revenue_type="GAAP",
        revenue_category=F.col("e.category"), amount_gbp=F.col("e.amount"), amount_gbp_signed=F.col("e.amount"),
        event_direction="CREDIT", mrr_gbp=F.col("e.mrr"), arr_gbp=F.col("e.arr"),
        payment_status=F.col("e.category"), source_system="INTACCT"))


def gaap_recognized(revrec: DataFrame) -> DataFrame:
    return gaap_events(revrec, ("RECOGNIZED",))


def gaap_deferred(revrec: DataFrame) -> DataFrame:
    return gaap_events(revrec, ("DEFERRED",))


def unified_revenue(invoices: DataFrame, charges: DataFrame, refunds: DataFrame, disputes: DataFrame,
                    revrec: DataFrame, idmap: DataFrame) -> DataFrame:
    """All attributable revenue events with key, periods and flags.

    Refunds and lost disputes share one join to charges; billing events share one
    identity join and ledger events another, instead of one join per branch.
    """
    outflows = _cash_out(_refunds(refunds).unionByName(_lost_disputes(disputes)), charges)
    billing = attribute(invoice_events(invoices).unionByName(outflows), _map_of(idmap, "stripe_customer_id"),
                        "customer_id", "stripe_customer_id")
    ledger = attribute(gaap_events(revrec), _map_of(idmap, "intacct_customer_id"),
                       "customer_id", "intacct_customer_id")
    day = "revenue_date"
    return billing.unionByName(ledger).select(
        surrogate_key("source_system", "source_record_id").alias("revenue_event_id"), "master_customer_id",
        *[f for f in REVENUE_FIELDS if f not in ("source_record_id", "source_system")],
        "source_system", "source_record_id",
        trunc_date("month", day).alias("revenue_month"), trunc_date("quarter", day).alias("revenue_quarter"),
        F.year(day).alias("revenue_year"),
        flag(F.col("revenue_type") == "CASH").alias("is_cash_revenue"),
        flag(F.col("revenue_type") == "GAAP").alias("is_gaap_revenue"),
        flag(F.col("revenue_type") == "AR").alias("is_accounts_receivable"),
        flag(F.col("event_direction") == "DEBIT").alias("is_cash_outflow"),
        flag(F.col("event_direction") == "CREDIT").alias("is_cash_inflow"),
        flag(F.col("revenue_category") == "RECOGNIZED").alias("is_recurring"))


def mrr_snapshot(subscriptions: DataFrame, idmap: DataFrame) -> DataFrame:
    """Operational MRR and ARR per subscription period."""
    rows = attribute(subscriptions.filter(F.col("subscription_id").isNotNull()),
                     _map_of(idmap, "stripe_customer_id"), "customer_id", "stripe_customer_id")
    start = trunc_date("day", "current_period_start")
    return rows.select(
        surrogate_key("subscription_id", start).alias("mrr_arr_snapshot_id"), "master_customer_id",
        "subscription_id", F.col("status").alias("subscription_status"), start.alias("snapshot_date"),
        money("mrr_gbp").alias("mrr_gbp"), money(money("mrr_gbp") * 12).alias("arr_gbp"))


COST_FIELDS = ["source_record_id", "master_customer_id", "activity_date", "person_name", "role_or_tier", "hours",
               "cost_gbp", "work_type", "work_category", "linked_ticket_id", "linked_issue_id", "source_system",
               "notes"]
_COST_TYPES = {"activity_date": "date", "hours": "decimal(28,6)", "cost_gbp": "decimal(28,6)"}


def _cost(**values) -> list[Column]:
    def col(name: str) -> Column:
        value = values.get(name)
        value = value if isinstance(value, Column) else F.lit(value)
        return value.cast(_COST_TYPES.get(name, "string")).alias(name)

    return [col(f) for f in COST_FIELDS]


def _hours(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def rate_lit(value: float) -> Column:
    return F.lit(str(value)).cast("decimal(10,2)")


def owned_issues(issues: DataFrame, idmap: DataFrame, issue_key: str = "jira_account_key") -> DataFrame:
    """Attributed issues, with what the cost ledger reads of them.

    ``issue_key`` is the identity column the issue's account id is matched to. Both the
    engineering costs and the owners of delivery work come from these rows: write them
    once where both are wanted.
    """
    customers = idmap.select(F.col(issue_key).alias("__key"), "master_customer_id")
    known = with_may_match(issues, customers, "account_id", "__key", "__may").filter("__may")
    rows = attribute(known, customers, "account_id", "__key")
    return rows.select("issue_id", "master_customer_id", "created_at", "time_spent_hours", "issue_type", "zendesk_ticket_id", "summary")


def issue_customer(owned: DataFrame) -> DataFrame:
    """Customer of each issue, from :func:`owned_issues`."""
    return owned.filter(F.col("issue_id").isNotNull()).select("issue_id", "master_customer_id")


def delivery_costs(time_entries: DataFrame, projects: DataFrame, idmap: DataFrame,
                   issues_to_customer: DataFrame) -> DataFrame:
    """Delivery work: hours x cost rate; customer through the project, else through the linked issue.

    The customers of projects are resolved on the small project table and written. An entry is then
    sent once, to the one customer it takes: by its project if that has a customer, by its issue if not.
    With neither a customer nor an issue it is left out before.
    """
    owners = cut_lineage(attribute(projects.select("project_id", "client_id"),
                                   idmap.select("harvest_client_id", F.col("master_customer_id").alias("project_master")),
                                   "client_id", "harvest_client_id").select("project_id", "project_master"))
    sent = _by_project_or_issue(time_entries, owners)
    customers = (owners.filter(F.col("project_master").isNotNull()).select(_project_key().alias("__key"), F.col("project_master").alias("__customer"))
                 .unionByName(issues_to_customer.select(_issue_key("issue_id").alias("__key"), F.col("master_customer_id").alias("__customer"))))
    both = lookup(sent, customers, "__owner", "__key")
    hours = _hours("hours")
    return both.select(*_cost(
        source_record_id=F.col("entry_id"), master_customer_id=F.col("__customer"),
        activity_date=F.col("date"), person_name=F.col("person"), role_or_tier=F.col("role"), hours=hours,
        cost_gbp=hours * _hours("cost_rate_gbp_per_hour"), work_type="DELIVERY",
        work_category=F.when(F.col("billable_rate_gbp_per_hour") > 0, "BILLABLE").otherwise("NON_BILLABLE"),
        linked_issue_id=F.col("linked_jira_issue_id"), source_system="HARVEST", notes=F.col("notes")))


def _project_key() -> Column:
    return F.concat(F.lit("P"), "project_id")


def _issue_key(column: str) -> Column:
    return F.concat(F.lit("I"), column)


def _by_project_or_issue(time_entries: DataFrame, owners: DataFrame) -> DataFrame:
    """Entries with the key of the project or issue whose customer they take, in column ``__owner``.

    A filter of the projects with a customer, of a few MB, tells which way an entry goes. Where it may be
    wrong is found beforehand from the distinct projects of the entries, and written: projects that pass it
    without a customer. Beside them stand projects with an owner whose customer is unknown; for each
    of these their entries go by the issue, too.
    """
    found = owners.filter(F.col("project_master").isNotNull())
    told = with_may_match(time_entries, found, "project_id", "project_id", "__by_project")
    passed = told.filter("__by_project").select("project_id").distinct()
    wrong = unmatched(passed, owners, "project_id", "project_id").select("project_id", F.lit(False).alias("__found"), F.lit(1).cast("bigint").alias("__unknown"))
    unknown = owners.filter(F.col("project_id").isNotNull()).groupBy("project_id").agg(
        F.bool_or(F.col("project_master").isNotNull()).alias("__found"), F.count_if(F.col("project_master").isNull()).alias("__unknown")).filter("__unknown > 0")
    listed = cut_lineage(wrong.unionByName(unknown)).withColumnRenamed("project_id", "__project")
    rows = lookup(told, listed, "project_id", "__project", spread_by=("linked_jira_issue_id", "date"))
    by_project = F.coalesce("__found", "__by_project")
    by_issue = F.coalesce("__unknown", F.when(F.col("__by_project"), 0).otherwise(1)).cast("int")
    none = F.array().cast("array<string>")
    keys = F.concat(F.when(by_project, F.array(_project_key())).otherwise(none),
                    F.when(F.col("linked_jira_issue_id").isNotNull(), F.array_repeat(_issue_key("linked_jira_issue_id"), by_issue)).otherwise(none))
    return rows.withColumn("__owner", F.explode(keys)).drop("__found", "__unknown", "__by_project")


def support_hours_of(minutes: str = "time_spent_minutes") -> Column:
    """Minutes as hours with six decimals."""
    return (F.col(minutes).cast("decimal(18,2)") / F.lit(60)).cast("decimal(18,6)")


def support_rate(tier: str = "tier", rates: Rates = RATES) -> Column:
    level = F.col(tier)
    return (F.when(level == 1, rate_lit(rates.support_tier_1))
            .when(level == 2, rate_lit(rates.support_tier_2))
            .when(level == 3, rate_lit(rates.support_tier_3))
            .otherwise(rate_lit(rates.support_default)))


def ticket_customer(tickets: DataFrame, idmap: DataFrame) -> DataFrame:
    """Customer of each ticket through its organisation."""
    return attribute(tickets.select("ticket_id", "organization_id"), _map_of(idmap, "zendesk_organization_id"),
                     "organization_id", "zendesk_organization_id").select("ticket_id", "master_customer_id")


def support_costs(time_entries: DataFrame, tickets: DataFrame, idmap: DataFrame,
                  rates: Rates = RATES) -> DataFrame:
    """Support work: minutes as hours x the tier's rate; attributed entries only."""
    owners = ticket_customer(tickets, idmap).withColumnRenamed("ticket_id", "__ticket")
    rows = attribute(time_entries, owners, "ticket_id", "__ticket")
    hours = support_hours_of()
    tier = F.coalesce(F.col("tier").cast("decimal(38,0)").cast("string"), F.lit("Unknown"))
    return rows.select(*_cost(
        source_record_id=F.col("time_entry_id"), master_customer_id=F.col("master_customer_id"),
        activity_date=F.col("date"), person_name=F.col("agent_id"),
        role_or_tier=F.concat(F.lit("Support Tier "), tier), hours=hours,
        cost_gbp=hours * support_rate(rates=rates), work_type="SUPPORT",
        work_category=F.coalesce("work_type", F.lit("GENERAL_SUPPORT")), linked_ticket_id=F.col("ticket_id"),
        source_system="ZENDESK"))


def engineering_costs(owned: DataFrame, rates: Rates = RATES) -> DataFrame:
    """Engineering work: hours of :func:`owned_issues` x the engineering rate."""
    hours = F.coalesce(_hours("time_spent_hours"), F.lit(0).cast("decimal(18,2)"))
    return owned.select(*_cost(
        source_record_id=F.col("issue_id"), master_customer_id=F.col("master_customer_id"),
        activity_date=F.col("created_at").cast("date"), role_or_tier="Engineer", hours=hours,
        cost_gbp=hours * rate_lit(rates.engineering), work_type="ENGINEERING", work_category=F.col("issue_type"),
        linked_ticket_id=F.col("zendesk_ticket_id"), linked_issue_id=F.col("issue_id"), source_system="JIRA",
        notes=F.col("summary")))


def unified_cost(*parts: DataFrame) -> DataFrame:
    """All attributable cost events (delivery, support, engineering) with key and periods."""
    day = "activity_date"
    rows = union_all(*parts).filter(F.col("master_customer_id").isNotNull())
    return rows.select(
        surrogate_key("source_system", "source_record_id").alias("cost_event_id"), "master_customer_id", day,
        "person_name", "role_or_tier", "hours", "cost_gbp", "work_type", "work_category", "linked_ticket_id",
        "linked_issue_id", "source_system", "source_record_id", "notes",
        trunc_date("month", day).alias("activity_month"), trunc_date("quarter", day).alias("activity_quarter"),
        F.year(day).alias("activity_year"))
