"""Customer health, churn risk and revenue at risk."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import count_distinct_where, mean_of, sum_where
from ..functions.dates import add_months_py, as_date, date_lit, day_diff
from ..functions.keys import surrogate_key
from ..functions.scalars import clamp, contains_any_ci, is_true, money, ratio, zero_if_null
from ..operators.relational import attribute
from .finance import CUSTOMER, closed_won, is_recognized
from .params import THRESHOLDS, Thresholds

# Score up to the bound -> class; score up to the bound -> churn probability.
RISK_CLASSES = [(40, "CHURN_RISK"), (60, "AT_RISK"), (80, "HEALTHY")]
BEST_CLASS = "EXPANSION_OPPORTUNITY"
CHURN_PROBABILITY = [(30, 0.80), (50, 0.40), (70, 0.10)]
LOWEST_PROBABILITY = 0.01


def _banded(value: Column, bands: list[tuple], last, strict: bool = False) -> Column:
    """First band whose bound holds the value, else ``last``."""
    result = F.lit(last)
    for bound, label in reversed(bands):
        result = F.when(value < bound if strict else value <= bound, F.lit(label)).otherwise(result)
    return result


def mrr_trend(monthly: DataFrame, as_of: str | dt.date) -> DataFrame:
    """MRR of this month and the two before, and the change in percent."""
    first = as_date(as_of).replace(day=1)
    amounts = {name: sum_where(F.col("snapshot_month") == date_lit(add_months_py(first, shift)),
                               "commercial_mrr_gbp").alias(name)
               for name, shift in (("current_mrr", 0), ("prev_month_mrr", -1), ("two_months_ago_mrr", -2))}
    before, now = F.col("prev_month_mrr"), F.col("current_mrr")
    change = F.when(before > 0, ratio(now - before, before) * 100).otherwise(F.lit(0.0))
    return monthly.groupBy(CUSTOMER).agg(*amounts.values()).withColumn("mrr_change_pct", change)


def gaap_trend(revenue: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Recognized revenue of this and the previous month; zero for customers that have older revenue only.

    The amounts come from the ledger rows of these two months, the customers from two
    columns of all.
    """
    first = as_date(as_of).replace(day=1)
    before, month = add_months_py(first, -1), F.col("revenue_month")
    recognized = revenue.filter(is_recognized())
    recent = recognized.filter(F.col("revenue_date").between(date_lit(before), F.last_day(date_lit(first))))
    sums = recent.groupBy(CUSTOMER).agg(
        sum_where(month == date_lit(first), "amount_gbp").alias("gaap_recognized_current_month_gbp"),
        sum_where(month == date_lit(before), "amount_gbp").alias("gaap_recognized_prev_month_gbp"))
    return _for_everyone(sums, recognized, ["gaap_recognized_current_month_gbp", "gaap_recognized_prev_month_gbp"])


def _for_everyone(measures: DataFrame, rows: DataFrame, zero: list[str]) -> DataFrame:
    """Measures of the customers that have any, zeros for the others of ``rows``."""
    names = [c for c in measures.columns if c != CUSTOMER]
    both = rows.select(CUSTOMER).distinct().unionByName(measures, allowMissingColumns=True)
    return both.groupBy(CUSTOMER).agg(*[(zero_if_null(F.max(c)) if c in zero else F.max(c)).alias(c) for c in names])


def _owned_invoices(invoices: DataFrame, idmap: DataFrame) -> DataFrame:
    return attribute(invoices, idmap.select("stripe_customer_id", CUSTOMER), "customer_id", "stripe_customer_id")


def _invoice_conditions(as_of: str | dt.date, thresholds: Thresholds) -> dict[str, Column]:
    today = date_lit(as_of)
    is_open = F.col("status") == "open"
    age = day_diff("invoice_date", today)
    to_pay = day_diff("invoice_date", "paid_at")
    paid_recently = ((F.col("status") == "paid") & F.col("invoice_date").isNotNull()
                     & (F.col("paid_at").cast("date") >= F.date_sub(today, thresholds.paid_window_days)))
    return {"open": is_open, "age": age, "overdue": is_open & (age >= thresholds.open_invoice_days),
            "to_pay": to_pay, "paid": paid_recently, "late": paid_recently & (to_pay > thresholds.late_after_days)}


def payment_behaviour(invoices: DataFrame, idmap: DataFrame, as_of: str | dt.date,
                      thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Open, overdue and late-paid invoices per customer.

    Rows are reduced to invoices first, so that counting them once needs no distinct count.
    """
    is_ = _invoice_conditions(as_of, thresholds)
    due = money("amount_due_gbp")
    to_pay = F.when(is_["paid"], is_["to_pay"])
    per_invoice = _owned_invoices(invoices, idmap).groupBy(CUSTOMER, "invoice_id").agg(
        *[F.bool_or(is_[name]).alias(name) for name in ("open", "overdue", "late")],
        sum_where(is_["open"], due).alias("open_due"), sum_where(is_["overdue"], due).alias("overdue_due"),
        F.max(F.when(is_["open"], is_["age"])).alias("age"), F.sum(to_pay).alias("pay_days"),
        F.count(to_pay).alias("paid_rows"))
    return per_invoice.groupBy(CUSTOMER).agg(
        _count_known("open", "invoice_id").alias("open_invoices_count"),
        F.sum("open_due").alias("open_invoices_amount_gbp"),
        _count_known("overdue", "invoice_id").alias("open_invoices_30d_plus_count"),
        F.sum("overdue_due").alias("open_invoices_30d_plus_amount_gbp"),
        F.max("age").alias("max_open_invoice_age_days"),
        ratio(F.sum("pay_days"), F.sum("paid_rows")).alias("avg_days_to_pay_90d"),
        _count_known("late", "invoice_id").alias("late_paid_invoices_90d"))


def _count_known(condition: str, key: str) -> Column:
    """Rows with the condition whose key is not null."""
    return F.count_if(F.col(condition) & F.col(key).isNotNull())


def support_trend(chain: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Tickets of the last and previous 30 days, high severity, resolution days and cost.

    A ticket repeats on each of its issues: counts are distinct, cost is summed per row.
    Only tickets of the last 60 days join their work; older ones only name their customers.
    """
    today = as_date(as_of)

    def days_ago(n: int) -> Column:
        return F.lit(today - dt.timedelta(days=n)).cast("timestamp_ntz")

    created = F.col("ticket_created_at")
    last = created >= days_ago(30)
    previous = (created >= days_ago(60)) & (created < days_ago(30))
    high = F.col("ticket_severity").isin("Critical", "High") & last
    resolution = F.when(last, F.col("resolution_time_days"))
    per_ticket = chain.filter(created >= days_ago(60)).groupBy(CUSTOMER, "zendesk_ticket_id").agg(
        F.bool_or(last).alias("last"), F.bool_or(previous).alias("previous"), F.bool_or(high).alias("high"),
        F.sum(resolution).alias("days"), F.count(resolution).alias("resolved"),
        sum_where(last, "total_cost_gbp").alias("cost"))
    trend = per_ticket.groupBy(CUSTOMER).agg(
        _count_known("last", "zendesk_ticket_id").alias("tickets_last_30d"),
        _count_known("previous", "zendesk_ticket_id").alias("tickets_prev_30d"),
        _count_known("high", "zendesk_ticket_id").alias("high_severity_tickets_30d"),
        ratio(F.sum("days"), F.sum("resolved")).alias("avg_resolution_days_30d"),
        F.sum("cost").alias("total_support_cost_30d"))
    return _for_everyone(trend, chain, ["tickets_last_30d", "tickets_prev_30d", "high_severity_tickets_30d", "total_support_cost_30d"])


def usage_trend(events: DataFrame, as_of: str | dt.date, users: DataFrame | None = None) -> DataFrame:
    """Events of the last and previous 30 days and active days.

    Without a user map the customer stays unknown (one row per user), as in the
    model; with ``users`` the metrics are per customer of that map, zero without recent
    events. Only the last 60 days of events are read for the counts; the days are
    reduced to user-days before the map is joined.
    """
    today = as_date(as_of)

    def since(n: int) -> Column:
        return F.lit(today - dt.timedelta(days=n)).cast("timestamp_ntz")

    at = F.col("timestamp")
    recent = events.filter(at >= since(60)).select("distinct_id", "event_id", "timestamp")
    days = recent.filter(at >= since(30)).select("distinct_id", at.cast("date").alias("day")).distinct()
    if users is None:
        key, everyone = "distinct_id", events.select("distinct_id").distinct()
    else:
        owners = users.select(F.col("user_identifier").alias("__user"), CUSTOMER)
        recent, days = (attribute(rows, owners, "distinct_id", "__user") for rows in (recent, days))
        key, everyone = CUSTOMER, users.select(CUSTOMER).distinct()
    per_event = recent.filter(F.col("event_id").isNotNull()).groupBy(key, "event_id").agg(
        F.bool_or(at >= since(30)).alias("last"), F.bool_or(at < since(30)).alias("previous"))
    measures = {"events_last_30d": F.count_if("last"), "events_prev_30d": F.count_if("previous")}
    counts = per_event.groupBy(key).agg(*[value.alias(name) for name, value in measures.items()])
    active = days.groupBy(key, "day").agg(F.lit(1)).groupBy(key).agg(F.count(F.lit(1)).alias("active_days_30d"))
    rows = (everyone.unionByName(counts, allowMissingColumns=True).unionByName(active, allowMissingColumns=True)
            .groupBy(key).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*measures, "active_days_30d")]))
    if users is None:
        return rows.withColumnRenamed(key, "user_identifier").withColumn(CUSTOMER, F.lit(None).cast("string"))
    return rows


def revenue_score(change: Column) -> Column:
    return (F.when(change >= 20, 30).when(change >= 10, 25).when(change >= 0, 20).when(change >= -10, 10)
            .otherwise(0))


def support_score(last: Column, previous: Column, high: Column) -> Column:
    return (F.when(last == 0, 25).when(high > 0, 5).when(last > previous, 10).when(last < previous, 20)
            .otherwise(15))


def payment_score(overdue: Column, late: Column) -> Column:
    return (F.when((overdue == 0) & (late == 0), 25).when((overdue == 0) & (late > 0), 20).when(overdue == 1, 10)
            .when(overdue >= 2, 0).otherwise(25))


def usage_score(last: Column, previous: Column) -> Column:
    return (F.when(last > previous, 20).when(last >= previous * 0.9, 15).when(last >= previous * 0.5, 10)
            .otherwise(0))


def health_components(idmap: DataFrame, mrr_monthly: DataFrame, revenue: DataFrame, invoices: DataFrame,
                      chain: DataFrame, as_of: str | dt.date, usage: DataFrame | None = None,
                      thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Four component scores and their raw metrics per customer.

    ``usage`` is the per-customer form of :func:`usage_trend`. Without it no customer
    has usage, which is what the model's placeholder join amounts to.
    """
    rows = (idmap.select(CUSTOMER, "customer_name")
            .join(mrr_trend(mrr_monthly, as_of), CUSTOMER, "left")
            .join(gaap_trend(revenue, as_of), CUSTOMER, "left")
            .join(support_trend(chain, as_of), CUSTOMER, "left")
            .join(payment_behaviour(invoices, idmap, as_of, thresholds), CUSTOMER, "left"))
    if usage is None:
        none = F.lit(None).cast("bigint")
        rows = rows.withColumns({"events_last_30d": none, "events_prev_30d": none, "active_days_30d": none})
    else:
        rows = rows.join(usage, CUSTOMER, "left")
    return rows.withColumns({
        "revenue_health_score": revenue_score(F.col("mrr_change_pct")),
        "support_health_score": support_score(F.col("tickets_last_30d"), F.col("tickets_prev_30d"),
                                              F.col("high_severity_tickets_30d")),
        "payment_health_score": payment_score(F.col("open_invoices_30d_plus_count"),
                                              F.col("late_paid_invoices_90d")),
        "usage_health_score": usage_score(F.col("events_last_30d"), F.col("events_prev_30d")),
    })


def customer_health_score(components: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Composite score 0-100 with risk class and churn probability."""
    parts = ["revenue_health_score", "support_health_score", "payment_health_score", "usage_health_score"]
    scored = components.withColumn("health_score", sum((F.col(p) for p in parts[1:]), F.col(parts[0])))
    score = F.col("health_score")
    return scored.select(
        CUSTOMER, "customer_name", "health_score", *parts,
        _banded(score, RISK_CLASSES, BEST_CLASS).alias("risk_category"),
        _banded(score, CHURN_PROBABILITY, LOWEST_PROBABILITY).alias("churn_probability"),
        F.col("current_mrr").alias("commercial_current_mrr"),
        F.col("mrr_change_pct").alias("commercial_mrr_change_pct"), "gaap_recognized_current_month_gbp",
        "gaap_recognized_prev_month_gbp", F.col("tickets_last_30d").alias("support_tickets_30d"),
        "high_severity_tickets_30d", F.col("total_support_cost_30d").alias("support_cost_30d"),
        "open_invoices_count", "open_invoices_amount_gbp", "open_invoices_30d_plus_count",
        "open_invoices_30d_plus_amount_gbp", "max_open_invoice_age_days", "avg_days_to_pay_90d",
        "late_paid_invoices_90d", F.col("events_last_30d").alias("usage_events_30d"),
        F.col("active_days_30d").alias("usage_days_30d"), date_lit(as_of).alias("score_calculated_at"))


# --- daily health fact -----------------------------------------------------------


def latest_usage(usage: DataFrame) -> DataFrame:
    """Latest usage row per customer."""
    fields = ["event_date", "monthly_active_users_30d", "active_days_30d", "usage_trend_pct_30d"]
    return usage.groupBy(CUSTOMER).agg(F.max_by(F.struct(*fields), "event_date").alias("last")).select(
        CUSTOMER, "last.*")


def last_login(events: DataFrame, users: DataFrame, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Last login and last activity date per customer.

    Dates are reduced per user before the user map is joined.
    """
    day = F.col("timestamp").cast("date")
    login = contains_any_ci("event_name", list(thresholds.login_words))
    per_user = (events.filter(F.col("timestamp").isNotNull() & F.col("distinct_id").isNotNull())
                .groupBy("distinct_id").agg(F.max(F.when(login, day)).alias("login"), F.max(day).alias("activity")))
    owners = users.select(F.col("user_identifier").alias("__user"), CUSTOMER)
    return attribute(per_user, owners, "distinct_id", "__user").groupBy(CUSTOMER).agg(
        F.max("login").alias("last_login_date"), F.max("activity").alias("last_activity_date"))


def open_critical(tickets: DataFrame, idmap: DataFrame) -> DataFrame:
    """Distinct unsolved tickets of high severity or priority per customer."""
    def within(column: str, *values: str) -> Column:
        return F.coalesce(F.col(column), F.lit("")).isin(*values)

    urgent = tickets.filter(F.col("ticket_id").isNotNull() & ~within("status", "solved", "closed")
                            & (within("severity", "Critical", "High") | within("priority", "urgent", "high")))
    owned = attribute(urgent, idmap.select("zendesk_organization_id", CUSTOMER), "organization_id",
                      "zendesk_organization_id")
    return owned.groupBy(CUSTOMER).agg(F.count_distinct("ticket_id").alias("open_critical_tickets_count"))


def dso(invoices: DataFrame, idmap: DataFrame, as_of: str | dt.date,
        thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Amount-weighted age of open invoices, overdue count and days to pay."""
    is_ = _invoice_conditions(as_of, thresholds)
    due = zero_if_null(money("amount_due_gbp"))
    aged = F.coalesce(due * is_["age"], F.lit(0))
    open_due = sum_where(is_["open"], due)
    return _owned_invoices(invoices, idmap).groupBy(CUSTOMER).agg(
        F.when(open_due > 0, ratio(sum_where(is_["open"], aged), open_due)).otherwise(F.lit(0.0)).alias(
            "days_sales_outstanding"),
        count_distinct_where(is_["overdue"], "invoice_id").alias("open_invoices_30d_plus_count"),
        mean_of(F.when(is_["paid"], is_["to_pay"])).alias("avg_days_to_pay_90d"))


def fact_customer_health(idmap: DataFrame, usage: DataFrame, events: DataFrame, users: DataFrame,
                         tickets: DataFrame, invoices: DataFrame, as_of: str | dt.date,
                         thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Usage, ticket and payment scores, composite and class per customer."""
    rows = (idmap.select(CUSTOMER, "customer_name")
            .join(latest_usage(usage), CUSTOMER, "left")
            .join(last_login(events, users, thresholds), CUSTOMER, "left")
            .join(open_critical(tickets, idmap), CUSTOMER, "left")
            .join(dso(invoices, idmap, as_of, thresholds), CUSTOMER, "left"))
    rows = rows.withColumns({name: zero_if_null(name) for name in (
        "active_days_30d", "monthly_active_users_30d", "open_critical_tickets_count", "days_sales_outstanding",
        "open_invoices_30d_plus_count", "avg_days_to_pay_90d", "usage_trend_pct_30d")})
    scored = rows.withColumns({
        "as_of_date": date_lit(as_of),
        "usage_score": clamp(F.col("active_days_30d") / 30.0 * 100, 0.0, 100.0),
        "tickets_score": clamp(F.col("open_critical_tickets_count") * 25, 0, 100),
        "late_payment_score": clamp(F.col("days_sales_outstanding") / 60.0 * 100, 0.0, 100.0),
    }).withColumn("health_score", clamp(
        F.col("usage_score") * 0.5 - F.col("tickets_score") * 0.3 - F.col("late_payment_score") * 0.2, 0.0, 100.0))
    return scored.select(
        surrogate_key(CUSTOMER, "as_of_date").alias("customer_health_id"), CUSTOMER, "customer_name", "as_of_date",
        F.coalesce("last_login_date", "last_activity_date").alias("last_login_date"),
        F.col("monthly_active_users_30d").alias("active_users_l30d"), "open_critical_tickets_count",
        F.round("days_sales_outstanding", 1).alias("days_sales_outstanding"), "usage_score", "tickets_score",
        "late_payment_score", "health_score", "open_invoices_30d_plus_count",
        F.round("avg_days_to_pay_90d", 1).alias("avg_days_to_pay_90d"), "usage_trend_pct_30d",
        _banded(F.col("health_score"), RISK_CLASSES, BEST_CLASS, strict=True).alias("health_category"))


# --- revenue at risk -------------------------------------------------------------


def active_arr(opportunities: DataFrame, idmap: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Booked yearly value of contracts active on the date."""
    today = date_lit(as_of)
    active = opportunities.filter(
        F.col("arr_booked_gbp").isNotNull() & (F.col("contract_start_date") <= today)
        & (F.col("contract_end_date").isNull() | (F.col("contract_end_date") >= today)))
    return closed_won(active, idmap).groupBy(CUSTOMER).agg(
        F.sum(money("arr_booked_gbp")).alias("booked_arr_gbp"))


def usage_baseline(usage: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Average active days between 120 and 30 days ago."""
    today = date_lit(as_of)
    window = usage.filter(F.col("event_date").between(F.date_sub(today, 120), F.date_sub(today, 30)))
    return window.groupBy(CUSTOMER).agg(mean_of("active_days_30d").alias("active_days_30d_prev_3mo_avg"))


def support_hours(cost: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Support hours of the last and previous 30 days; customers without any in them have no row."""
    today, day = date_lit(as_of), F.col("activity_date")
    recent, previous = day >= F.date_sub(today, 30), day < F.date_sub(today, 30)
    window = cost.filter((F.col("work_type") == "SUPPORT") & (day >= F.date_sub(today, 60)))
    return window.groupBy(CUSTOMER).agg(
        sum_where(recent, "hours").alias("support_hours_30d"),
        sum_where(previous, "hours").alias("support_hours_prev_30d"))


def revenue_at_risk(idmap: DataFrame, opportunities: DataFrame, usage: DataFrame, cost: DataFrame,
                    as_of: str | dt.date, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """High-value customers whose usage declines, with a support spike signal."""
    current = latest_usage(usage).select(CUSTOMER, F.col("active_days_30d").alias("active_days_30d_current"))
    rows = (idmap.select(CUSTOMER, "customer_name")
            .join(active_arr(opportunities, idmap, as_of), CUSTOMER, "left")
            .join(current, CUSTOMER, "left")
            .join(usage_baseline(usage, as_of), CUSTOMER, "left")
            .join(support_hours(cost, as_of), CUSTOMER, "left"))
    rows = rows.withColumns({name: zero_if_null(name) for name in (
        "booked_arr_gbp", "active_days_30d_current", "active_days_30d_prev_3mo_avg", "support_hours_30d",
        "support_hours_prev_30d")})
    base, change = F.col("active_days_30d_prev_3mo_avg"), F.col("active_days_change_ratio")
    before = F.col("support_hours_prev_30d")
    flagged = rows.withColumns({
        "as_of_date": date_lit(as_of),
        "is_high_value": F.col("booked_arr_gbp") > thresholds.high_value_arr_gbp,
        "active_days_change_ratio": F.when(base > 0, ratio(F.col("active_days_30d_current") - base, base)),
        "is_support_spike": is_true((before > 0) & (ratio("support_hours_30d", before) >= thresholds.spike_ratio)),
    }).withColumn("is_declining_usage", is_true(change <= thresholds.decline_ratio))
    return flagged.select(
        surrogate_key(CUSTOMER, "as_of_date").alias("revenue_at_risk_id"), CUSTOMER, "customer_name", "as_of_date",
        "booked_arr_gbp", "is_high_value", "active_days_30d_current", "active_days_30d_prev_3mo_avg",
        "active_days_change_ratio", "is_declining_usage", "support_hours_30d", "support_hours_prev_30d",
        "is_support_spike", (F.col("is_high_value") & F.col("is_declining_usage")).alias("is_revenue_at_risk"))
