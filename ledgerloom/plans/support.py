"""Support operations: ticket to issue to delivery resolution chain."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_lit, day_diff
from ..functions.keys import surrogate_key
from ..functions.scalars import flag, least_or_null, money, zero_if_null
from ..operators.relational import attribute, lookup
from .ledgers import rate_lit, support_hours_of, support_rate
from .params import RATES, Rates

# Severity -> points; days within the bound -> speed class.
SEVERITY_POINTS = {"Critical": 100, "High": 75, "Medium": 50, "Low": 25}
SPEED_CLASSES = [(7, "FAST"), (30, "NORMAL"), (90, "SLOW")]
SLOWEST = "VERY_SLOW"
COMPONENT_CAP = 100


def ticket_lifecycle(events: DataFrame) -> DataFrame:
    """First agent comment and last agent status change per ticket."""
    def by_agent(kind: str) -> Column:
        return F.when((F.col("event_type") == kind) & (F.col("actor") == "agent"), F.col("timestamp"))

    return events.filter(F.col("ticket_id").isNotNull()).groupBy("ticket_id").agg(
        F.min(by_agent("comment")).alias("ticket_first_response_at"),
        F.max(by_agent("status_change")).alias("ticket_last_agent_status_change_at"))


def tickets_enriched(tickets: DataFrame, events: DataFrame, idmap: DataFrame) -> DataFrame:
    """Attributed tickets with response and solved times inferred from their status."""
    owned = attribute(tickets, idmap.select("zendesk_organization_id", "master_customer_id"), "organization_id",
                      "zendesk_organization_id")
    rows = lookup(owned, ticket_lifecycle(events).withColumnRenamed("ticket_id", "__t"), "ticket_id", "__t")
    last, status = F.col("ticket_last_agent_status_change_at"), F.col("status")
    return rows.select(
        "ticket_id", "master_customer_id", F.col("created_at").alias("ticket_created_at"),
        "ticket_first_response_at", "ticket_last_agent_status_change_at",
        F.when(status.isin("solved", "closed"), last).alias("ticket_solved_at"),
        F.when(status == "closed", last).alias("ticket_closed_at"), status.alias("ticket_status"),
        F.col("priority").alias("ticket_priority"), F.col("severity").alias("ticket_severity"),
        F.col("type").alias("ticket_type"), "channel", F.col("subject").alias("ticket_subject"), "assigned_group")


def linked_issues(issues: DataFrame) -> DataFrame:
    """Issues that name a ticket."""
    return issues.filter(F.col("zendesk_ticket_id").isNotNull()).select(
        F.col("issue_id").alias("jira_issue_id"), F.col("zendesk_ticket_id").alias("__issue_ticket"),
        F.col("summary").alias("issue_summary"), "issue_type", F.col("status").alias("issue_status"),
        F.col("priority").alias("issue_priority"), "story_points",
        F.col("time_spent_hours").cast("decimal(18,2)").alias("__jira_hours"),
        F.col("created_at").alias("issue_created_at"), F.col("resolved_at").alias("issue_resolved_at"))


def hours_by_issue(time_entries: DataFrame) -> DataFrame:
    """Delivery hours and cost per linked issue."""
    hours = F.col("hours").cast("decimal(18,2)")
    return time_entries.filter(F.col("linked_jira_issue_id").isNotNull()).groupBy("linked_jira_issue_id").agg(
        F.sum(hours).alias("harvest_hours"),
        F.sum(hours * F.col("cost_rate_gbp_per_hour").cast("decimal(18,2)")).alias("harvest_cost_gbp"))


def hours_by_ticket(time_entries: DataFrame, rates: Rates = RATES) -> DataFrame:
    """Support hours and cost per ticket."""
    hours = support_hours_of()
    return time_entries.filter(F.col("ticket_id").isNotNull()).groupBy("ticket_id").agg(
        F.sum(hours).alias("support_handle_time_hours"),
        F.sum(hours * support_rate(rates=rates)).alias("support_cost_gbp"))


def resolution_chain(tickets: DataFrame, events: DataFrame, issues: DataFrame, delivery_time: DataFrame,
                     support_time: DataFrame, idmap: DataFrame, as_of: str | dt.date,
                     rates: Rates = RATES) -> DataFrame:
    """Ticket x linked issue rows with time, cost and day differences.

    Time entries are summed per issue and per ticket before the joins; ticket cost
    repeats on every issue of the ticket, as in the grain of the model.
    """
    issue_time = hours_by_issue(delivery_time).withColumnRenamed("linked_jira_issue_id", "__time_issue")
    work = lookup(linked_issues(issues), issue_time.withColumn("__delivered", F.lit(1)), "jira_issue_id",
                  "__time_issue")
    desk = hours_by_ticket(support_time, rates).withColumnRenamed("ticket_id", "__time_ticket")
    chain = lookup(lookup(tickets_enriched(tickets, events, idmap), desk, "ticket_id", "__time_ticket"),
                   work, "ticket_id", "__issue_ticket")
    jira_hours = zero_if_null("__jira_hours")
    jira_cost = money(jira_hours * rate_lit(rates.engineering))
    delivery_cost = money(zero_if_null("harvest_cost_gbp"))
    created, resolved = F.col("ticket_created_at"), F.col("issue_resolved_at")
    return chain.select(
        F.col("ticket_id").alias("zendesk_ticket_id"), "master_customer_id", "ticket_created_at",
        "ticket_first_response_at", "ticket_last_agent_status_change_at", "ticket_solved_at", "ticket_closed_at",
        "ticket_status", "ticket_priority", "ticket_severity", "ticket_type", "channel", "ticket_subject",
        "assigned_group", "jira_issue_id", "issue_summary", "issue_type", "issue_status", "issue_priority",
        "story_points", "issue_created_at", "issue_resolved_at",
        zero_if_null("support_handle_time_hours").alias("support_handle_time_hours"),
        money(zero_if_null("support_cost_gbp")).alias("total_support_cost_gbp"),
        jira_hours.alias("total_jira_hours"), jira_cost.alias("total_jira_cost_gbp"),
        zero_if_null("harvest_hours").alias("total_harvest_hours"), delivery_cost.alias("total_harvest_cost_gbp"),
        (jira_hours + zero_if_null("harvest_hours")).alias("total_engineering_hours"),
        (jira_cost + delivery_cost).alias("total_engineering_cost_gbp"),
        day_diff(created, resolved).alias("resolution_time_days"),
        day_diff(created, "issue_created_at").alias("ticket_to_issue_days"),
        day_diff("issue_created_at", resolved).alias("issue_resolution_days"),
        day_diff(created, F.coalesce(F.col("ticket_solved_at").cast("date"), date_lit(as_of))).alias(
            "ticket_age_days"),
        flag(F.col("jira_issue_id").isNotNull()).alias("has_linked_issue"),
        flag(F.col("__delivered").isNotNull()).alias("has_delivery_work"),
        flag(resolved.isNotNull()).alias("is_resolved"))


def _speed(days: Column) -> Column:
    speed = F.lit(SLOWEST)
    for bound, label in reversed(SPEED_CLASSES):
        speed = F.when(days <= bound, F.lit(label)).otherwise(speed)
    return speed


def _severity(column: Column) -> Column:
    points = F.lit(0)
    for name, value in SEVERITY_POINTS.items():
        points = F.when(column == name, F.lit(value)).otherwise(points)
    return points


def issue_resolution(chain: DataFrame) -> DataFrame:
    """Chain rows with key, total cost, speed class and impact score (null while unresolved)."""
    total = F.col("total_support_cost_gbp") + F.col("total_engineering_cost_gbp")
    days = F.col("resolution_time_days")
    impact = (_severity(F.col("ticket_severity")).cast("double")
              + least_or_null(F.col("total_cost_gbp").cast("double") / 10, F.lit(float(COMPONENT_CAP)))
              + least_or_null(days, F.lit(COMPONENT_CAP)))
    return (chain.withColumn("total_cost_gbp", total)
            .withColumn("resolution_speed_category", _speed(days))
            .withColumn("impact_score", impact)
            .withColumn("resolution_chain_id", surrogate_key(
                "zendesk_ticket_id", F.coalesce("jira_issue_id", F.lit("NO_JIRA")))))
