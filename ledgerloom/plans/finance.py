"""Finance marts: revenue gap, customer profitability, lifetime value, project performance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import sum_where
from ..functions.dates import as_date, date_lit, day_diff, month_diff, trunc_date
from ..functions.keys import surrogate_key
from ..functions.scalars import is_true, least_or_null, money, ratio, zero_if_null
from ..operators.relational import attribute, lookup, top1, with_calendar_total
from ..operators.session import cut_lineage
from .params import THRESHOLDS, Thresholds

CUSTOMER = "master_customer_id"


def _names(idmap: DataFrame) -> DataFrame:
    return idmap.select(F.col(CUSTOMER).alias("__customer"), "customer_name")


def with_customer_name(df: DataFrame, idmap: DataFrame) -> DataFrame:
    return lookup(df, _names(idmap), CUSTOMER, "__customer")


# --- revenue gap -----------------------------------------------------------------


def closed_won(opportunities: DataFrame, idmap: DataFrame) -> DataFrame:
    """Closed-won opportunities with their customer."""
    won = opportunities.filter(F.col("stage") == "Closed Won")
    return attribute(won, idmap.select(F.col("account_id").alias("__account"), CUSTOMER), "account_id", "__account")


def contract_months(opportunities: DataFrame, idmap: DataFrame,
                    thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """First and last month of each closed-won contract; open ends run for a default term."""
    rows = closed_won(opportunities.filter(F.col("arr_booked_gbp").isNotNull()
                                           & F.col("contract_start_date").isNotNull()), idmap)
    end = F.coalesce("contract_end_date", F.add_months("contract_start_date", thresholds.default_contract_months))
    return rows.select(CUSTOMER, "opportunity_id", "arr_booked_gbp",
                       trunc_date("month", "contract_start_date").alias("start_month"),
                       trunc_date("month", end).alias("end_month"))


def expand_months(contracts: DataFrame, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """One row per contract month, end included, with a twelfth of the yearly value.

    The model counts ``contract_months_cap`` months of a contract at most; with None all count.
    """
    last = month_diff("start_month", "end_month")
    if thresholds.contract_months_cap is not None:
        last = F.least(last, F.lit(thresholds.contract_months_cap - 1))
    offsets = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0))))
    monthly = money(money("arr_booked_gbp") / F.lit(12)).alias("expected_monthly_booked_gbp")
    rows = contracts.select(CUSTOMER, "opportunity_id", "start_month", monthly, F.explode(offsets).alias("__n"))
    return rows.select(CUSTOMER, "opportunity_id", F.add_months("start_month", F.col("__n")).alias("revenue_month"),
                       "expected_monthly_booked_gbp")


def booked_monthly(months: DataFrame) -> DataFrame:
    return months.groupBy(CUSTOMER, "revenue_month").agg(
        F.sum("expected_monthly_booked_gbp").alias("expected_monthly_booked_gbp"))


def actual_lines(lines: DataFrame, invoices: DataFrame, idmap: DataFrame) -> DataFrame:
    """Invoiced amounts per (customer, month), summed per invoice before anything is joined.

    Lines are reduced to one row per invoice and invoices to one row per billing
    customer and month, so only small rows reach the identity join even when one
    customer owns a large share of the lines.
    """
    per_invoice = (lines.filter(F.col("invoice_id").isNotNull())
                   .groupBy(F.col("invoice_id").alias("__invoice"))
                   .agg(F.sum(zero_if_null(money("amount_gbp"))).alias("amount")))
    dated = invoices.filter(F.col("invoice_date").isNotNull() & F.col("customer_id").isNotNull())
    per_customer = (dated.join(per_invoice, F.col("invoice_id") == F.col("__invoice"))
                    .groupBy("customer_id", trunc_date("month", "invoice_date").alias("revenue_month"))
                    .agg(F.sum("amount").alias("amount")))
    return attribute(per_customer, idmap.select("stripe_customer_id", CUSTOMER), "customer_id",
                     "stripe_customer_id").select(CUSTOMER, "revenue_month", "amount")


def actual_monthly(lines: DataFrame, invoices: DataFrame, idmap: DataFrame) -> DataFrame:
    return actual_lines(lines, invoices, idmap).groupBy(CUSTOMER, "revenue_month").agg(
        F.sum("amount").alias("actual_net_revenue_gbp"))


def revenue_gap(opportunities: DataFrame, lines: DataFrame, invoices: DataFrame, idmap: DataFrame,
                thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Booked versus invoiced value per customer and month.

    The union of booked and actual rows is aggregated once; a month spine with two
    outer joins would give the same rows with three more shuffles.
    """
    booked = expand_months(contract_months(opportunities, idmap, thresholds), thresholds).select(
        CUSTOMER, "revenue_month", F.col("expected_monthly_booked_gbp").alias("booked"),
        F.lit(None).cast("decimal(38,6)").alias("actual"))
    actual = actual_lines(lines, invoices, idmap).select(
        CUSTOMER, "revenue_month", F.lit(None).cast("decimal(28,6)").alias("booked"),
        F.col("amount").cast("decimal(38,6)").alias("actual"))
    monthly = booked.unionByName(actual).groupBy(CUSTOMER, "revenue_month").agg(
        zero_if_null(F.sum("booked")).alias("expected_monthly_booked_gbp"),
        zero_if_null(F.sum("actual")).alias("actual_net_revenue_gbp"))
    kept = monthly.filter((F.col("expected_monthly_booked_gbp") != 0) | (F.col("actual_net_revenue_gbp") != 0))
    return with_customer_name(kept, idmap).select(
        surrogate_key(CUSTOMER, "revenue_month").alias("revenue_gap_id"), CUSTOMER, "customer_name",
        "revenue_month", "expected_monthly_booked_gbp", "actual_net_revenue_gbp",
        (F.col("expected_monthly_booked_gbp") - F.col("actual_net_revenue_gbp")).alias("revenue_gap_gbp"))


# --- profitability ---------------------------------------------------------------


def is_recognized() -> Column:
    return (F.col("revenue_type") == "GAAP") & (F.col("revenue_category") == "RECOGNIZED")


def is_shared() -> Column:
    """Engineering work that no ticket asked for is pooled over customers."""
    return ((F.col("work_type") == "ENGINEERING") & (F.col("source_system") == "JIRA")
            & F.col("linked_ticket_id").isNull())


def with_allocation_type(cost: DataFrame) -> DataFrame:
    return cost.withColumn("cost_allocation_type",
                           F.when(is_true(is_shared()), F.lit("SHARED")).otherwise(F.lit("DIRECT")))


def revenue_monthly(revenue: DataFrame) -> DataFrame:
    """Recognized revenue per customer and month."""
    return (revenue.filter(is_recognized() & F.col("revenue_date").isNotNull())
            .groupBy(CUSTOMER, trunc_date("month", "revenue_date").alias("profitability_month"))
            .agg(F.sum("amount_gbp").alias("gaap_recognized_revenue_gbp")))


def _cost_sums() -> dict[str, Column]:
    """Conditional sums over a cost ledger with allocation types."""
    direct, shared = F.col("cost_allocation_type") == "DIRECT", F.col("cost_allocation_type") == "SHARED"
    kind = F.col("work_type")
    return {
        "direct": sum_where(direct, "cost_gbp"),
        "delivery": sum_where(direct & (kind == "DELIVERY"), "cost_gbp"),
        "support": sum_where(direct & (kind == "SUPPORT"), "cost_gbp"),
        "engineering": sum_where(direct & (kind == "ENGINEERING"), "cost_gbp"),
        "shared": sum_where(shared & (kind == "ENGINEERING"), "cost_gbp"),
    }


def cost_monthly(cost: DataFrame) -> DataFrame:
    """Direct cost by kind and shared engineering cost per customer and month, in one pass."""
    return (with_allocation_type(cost).filter(F.col("activity_date").isNotNull())
            .groupBy(CUSTOMER, trunc_date("month", "activity_date").alias("profitability_month"))
            .agg(*[amount.alias(name) for name, amount in _monthly_sums().items()]))


def _monthly_sums() -> dict[str, Column]:
    sums = _cost_sums()
    return {"total_direct_cost_gbp": sums["direct"], "delivery_cost_gbp": sums["delivery"], "support_cost_gbp": sums["support"],
            "engineering_direct_cost_gbp": sums["engineering"], "shared_engineering_cost_customer_month_gbp": sums["shared"]}


def active_spine(revenue_by_month: DataFrame, cost_by_month: DataFrame) -> DataFrame:
    """Customer-months with revenue or cost."""
    keys = [CUSTOMER, "profitability_month"]
    return revenue_by_month.select(*keys).unionByName(cost_by_month.select(*keys)).distinct()


def customer_profitability(revenue: DataFrame, cost: DataFrame, idmap: DataFrame) -> DataFrame:
    """Revenue, direct cost, pooled engineering share and margin per customer and month.

    The rows of both ledgers are united and aggregated once by customer and month, which
    replaces the spine and its outer joins. The customer-months are written once: the rows and the
    totals per month, a small, calendar-bounded table, come from the same pass over the
    ledgers. Names are joined before anything is derived, so that only sums are sent for them.
    A month without cost rows of its own sees no pool.
    """
    month = "profitability_month"
    earnings = revenue.filter(is_recognized() & F.col("revenue_date").isNotNull()).select(
        CUSTOMER, trunc_date("month", "revenue_date").alias(month), F.col("amount_gbp").alias("__earned"), F.lit(0).alias("__has_cost"))
    spending = with_allocation_type(cost).filter(F.col("activity_date").isNotNull()).select(
        CUSTOMER, trunc_date("month", "activity_date").alias(month), "cost_allocation_type", "work_type", "cost_gbp", F.lit(1).alias("__has_cost"))
    merged = cut_lineage(earnings.unionByName(spending, allowMissingColumns=True).groupBy(CUSTOMER, month).agg(
        zero_if_null(F.sum("__earned")).alias("gaap_recognized_revenue_gbp"),
        *[zero_if_null(amount).alias(name) for name, amount in _monthly_sums().items()], F.max("__has_cost").alias("__has_cost")))
    totals = merged.groupBy(F.col(month).alias("__month")).agg(
        F.sum("gaap_recognized_revenue_gbp").alias("__month_revenue"),
        F.sum("shared_engineering_cost_customer_month_gbp").alias("__month_pool"))
    # One row per month: bounded by the calendar, so safe to broadcast.
    joined = with_customer_name(merged, idmap).join(F.broadcast(totals), F.col(month) == F.col("__month"))
    pool = F.when(F.col("__has_cost") == 1, F.col("__month_pool")).otherwise(
        F.lit(0).cast("decimal(38,6)"))
    earned = F.col("gaap_recognized_revenue_gbp")
    share = F.when((F.col("__month_revenue") > 0) & (earned > 0),
                   ratio(earned, F.col("__month_revenue")) * F.col("shared_engineering_pool_gbp").cast("double")
                   ).otherwise(F.lit(0.0))
    rows = (joined.withColumn("shared_engineering_pool_gbp", pool)
            .filter((earned > 0) | (F.col("total_direct_cost_gbp") > 0)
                    | (F.col("shared_engineering_pool_gbp") > 0))
            .withColumn("allocated_shared_engineering_cost_gbp", share)
            .withColumn("total_cost_gbp", F.col("total_direct_cost_gbp").cast("double")
                        + F.col("allocated_shared_engineering_cost_gbp"))
            .withColumn("gross_margin_gbp", earned.cast("double") - F.col("total_cost_gbp"))
            .withColumn("gross_margin_pct", F.when(earned > 0, ratio("gross_margin_gbp", earned) * 100)
                        .otherwise(F.lit(0.0))))
    return rows.select(
        surrogate_key(CUSTOMER, month).alias("customer_profitability_id"), CUSTOMER, "customer_name", month,
        "gaap_recognized_revenue_gbp", "delivery_cost_gbp", "support_cost_gbp", "engineering_direct_cost_gbp",
        "total_direct_cost_gbp", "shared_engineering_pool_gbp", "allocated_shared_engineering_cost_gbp",
        "total_cost_gbp", "gross_margin_gbp", "gross_margin_pct")


def with_month_pool(cost_by_month: DataFrame) -> DataFrame:
    """Cost months with the pooled engineering cost of all customers in that month.

    The months are written once: rows and totals come from one pass over the ledger.
    """
    return with_calendar_total(cut_lineage(cost_by_month), "profitability_month",
                               "shared_engineering_cost_customer_month_gbp", "shared_engineering_pool_gbp")


def allocation_basis(spine: DataFrame, revenue_by_month: DataFrame) -> DataFrame:
    """Revenue of each customer-month and of all customers in that month."""
    keys = [CUSTOMER, "profitability_month"]
    return _with_month_revenue(spine.join(revenue_by_month, keys, "left").withColumn(
        "gaap_recognized_revenue_gbp", zero_if_null("gaap_recognized_revenue_gbp")))


def month_basis(revenue: DataFrame, cost: DataFrame) -> DataFrame:
    """:func:`allocation_basis` over all customer-months with revenue or cost, from one aggregate over the rows of both ledgers."""
    month = "profitability_month"
    earned = F.when(F.col(CUSTOMER).isNotNull(), F.col("amount_gbp")).alias("__earned")  # a join finds no revenue for a null key
    recognized = revenue.filter(is_recognized() & F.col("revenue_date").isNotNull()).select(CUSTOMER, trunc_date("month", "revenue_date").alias(month), earned)
    spent = cost.filter(F.col("activity_date").isNotNull()).select(CUSTOMER, trunc_date("month", "activity_date").alias(month))
    return _with_month_revenue(recognized.unionByName(spent, allowMissingColumns=True).groupBy(CUSTOMER, month).agg(
        zero_if_null(F.sum("__earned")).alias("gaap_recognized_revenue_gbp")))


def _with_month_revenue(rows: DataFrame) -> DataFrame:
    """Rows with their month's total; they are written once, so that it comes from them and not from the ledgers again."""
    return with_calendar_total(cut_lineage(rows), "profitability_month", "gaap_recognized_revenue_gbp",
                               "total_revenue_in_month_gbp")


# --- lifetime value --------------------------------------------------------------


def commercial_mrr_monthly(snapshots: DataFrame) -> DataFrame:
    """MRR per customer and month from the latest snapshot of each subscription."""
    usable = snapshots.filter(F.col("subscription_id").isNotNull() & F.col("snapshot_date").isNotNull())
    dated = usable.withColumn("snapshot_month", trunc_date("month", "snapshot_date"))
    latest = dated.groupBy(CUSTOMER, "subscription_id", "snapshot_month").agg(
        F.max_by("mrr_gbp", F.struct("snapshot_date", "mrr_gbp")).alias("mrr_gbp"))
    return latest.groupBy(CUSTOMER, "snapshot_month").agg(F.sum("mrr_gbp").alias("commercial_mrr_gbp"))


def mrr_metrics(monthly: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Current month, average month and number of months with MRR."""
    this_month = date_lit(as_date(as_of).replace(day=1))
    return monthly.groupBy(CUSTOMER).agg(
        sum_where(F.col("snapshot_month") == this_month, "commercial_mrr_gbp").alias("commercial_current_mrr_gbp"),
        ratio(F.sum("commercial_mrr_gbp"), F.count("commercial_mrr_gbp")).alias("commercial_avg_monthly_mrr_gbp"),
        # (customer, month) is the grain of the input, so counting is counting distinct months.
        F.count("snapshot_month").alias("months_with_commercial_mrr"))


def lifetime_revenue(revenue: DataFrame) -> DataFrame:
    """First and last date, totals by category and active months of GAAP revenue."""
    category = F.col("revenue_category")
    return revenue.filter(F.col("revenue_type") == "GAAP").groupBy(CUSTOMER).agg(
        F.min("revenue_date").alias("first_revenue_date"), F.max("revenue_date").alias("last_revenue_date"),
        F.sum("amount_gbp").alias("gaap_total_revenue_gbp"),
        sum_where(category == "RECOGNIZED", "amount_gbp").alias("gaap_total_recognized_revenue_gbp"),
        sum_where(category == "DEFERRED", "amount_gbp").alias("gaap_total_deferred_revenue_gbp"),
        F.count_distinct("revenue_month").alias("gaap_months_with_revenue"))


def lifetime_cost(cost: DataFrame) -> DataFrame:
    """Direct cost by kind, shared engineering cost and hours."""
    sums = _cost_sums()
    return with_allocation_type(cost).groupBy(CUSTOMER).agg(
        sums["direct"].alias("total_direct_cost_gbp"), sums["delivery"].alias("total_delivery_cost_gbp"),
        sums["support"].alias("total_support_cost_gbp"),
        sums["engineering"].alias("total_engineering_direct_cost_gbp"),
        sums["shared"].alias("total_engineering_shared_cost_gbp"), F.sum("hours").alias("total_hours"))


def acquisition(opportunities: DataFrame, idmap: DataFrame) -> DataFrame:
    """First closed-won date and number of won opportunities."""
    return closed_won(opportunities, idmap).groupBy(CUSTOMER).agg(
        F.min("close_date").alias("acquisition_date"),
        F.count_distinct("opportunity_id").alias("opportunities_count"))


def tenure(idmap: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Calendar months since a customer was first seen, and the same with a floor of 1."""
    months = month_diff("first_seen_at", date_lit(as_of))
    return idmap.select(CUSTOMER, "customer_name", F.col("first_seen_at").alias("customer_since"),
                        months.alias("customer_tenure_months"),
                        F.when(months <= 0, F.lit(1)).otherwise(months).alias("tenure_months_safe"))


def ltv_calculation(idmap: DataFrame, revenue: DataFrame, cost: DataFrame, snapshots: DataFrame,
                    opportunities: DataFrame, as_of: str | dt.date,
                    thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Revenue, cost, pool share, margins and monthly averages per customer.

    All inputs are aggregated by customer first. Costs and MRR per customer are written
    once: their sums over all customers come from these rows, not from the ledgers again.
    """
    customers = tenure(idmap, as_of)
    spent = cut_lineage(lifetime_cost(cost).join(mrr_metrics(commercial_mrr_monthly(snapshots), as_of), CUSTOMER, "full_outer"))
    joined = (customers.join(lifetime_revenue(revenue), CUSTOMER, "left").join(spent, CUSTOMER, "left")
              .join(acquisition(opportunities, idmap), CUSTOMER, "left"))
    amounts = ["gaap_total_revenue_gbp", "gaap_total_recognized_revenue_gbp", "gaap_total_deferred_revenue_gbp",
               "commercial_current_mrr_gbp", "commercial_avg_monthly_mrr_gbp", "total_direct_cost_gbp",
               "total_delivery_cost_gbp", "total_support_cost_gbp", "total_engineering_direct_cost_gbp",
               "total_engineering_shared_cost_gbp", "total_hours"]
    filled = joined.withColumns({"__has_revenue": F.col("gaap_total_revenue_gbp") > 0,
                                 **{a: zero_if_null(a) for a in amounts}})
    totals = spent.agg(F.sum("total_engineering_shared_cost_gbp").alias("shared_engineering_pool_gbp"),
                       F.sum("commercial_current_mrr_gbp").alias("__all_mrr"))
    rows = filled.crossJoin(F.broadcast(totals))  # one row
    mrr, revenue_total = F.col("commercial_current_mrr_gbp"), F.col("gaap_total_revenue_gbp").cast("double")
    direct, months = F.col("total_direct_cost_gbp").cast("double"), F.col("tenure_months_safe")
    share = F.when((F.col("__all_mrr") > 0) & (mrr > 0),
                   ratio(mrr, F.col("__all_mrr")) * zero_if_null("shared_engineering_pool_gbp").cast("double")).otherwise(F.lit(0.0))

    def monthly(total: Column) -> Column:
        return F.when(months > 0, total / months).otherwise(F.lit(0.0))

    allocated = F.col("allocated_shared_engineering_cost_gbp")
    margin = F.col("gross_margin_direct_cost_gbp")
    with_share = rows.withColumns({"allocated_shared_engineering_cost_gbp": share,
                                   "gross_margin_direct_cost_gbp": revenue_total - direct})
    return with_share.withColumns({
        "total_cost_including_allocated_shared_engineering_gbp": direct + allocated,
        "margin_percent_direct_cost": F.when(F.col("__has_revenue"), ratio(margin, revenue_total) * 100).otherwise(
            F.lit(0.0)),
        "gross_margin_with_allocated_shared_engineering_gbp": revenue_total - (direct + allocated),
        "avg_monthly_revenue_gbp": monthly(revenue_total),
        "avg_monthly_cost_gbp": monthly(direct),
        "avg_monthly_margin_gbp": monthly(margin),
        "projected_commercial_ltv_gbp": mrr * thresholds.projection_months,
        "projected_gaap_ltv_gbp": F.lit(None).cast("decimal(38,0)"),
        "estimated_cac_gbp": F.lit(thresholds.estimated_cac_gbp),
    })


LTV_COLUMNS = [
    CUSTOMER, "customer_name", "gaap_total_revenue_gbp", "gaap_total_recognized_revenue_gbp",
    "gaap_total_deferred_revenue_gbp", "commercial_current_mrr_gbp", "commercial_avg_monthly_mrr_gbp",
    "total_direct_cost_gbp", "total_delivery_cost_gbp", "total_support_cost_gbp",
    "total_engineering_direct_cost_gbp", "total_engineering_shared_cost_gbp", "total_hours",
    "allocated_shared_engineering_cost_gbp", "total_cost_including_allocated_shared_engineering_gbp",
    "gross_margin_direct_cost_gbp", "margin_percent_direct_cost",
    "gross_margin_with_allocated_shared_engineering_gbp", "customer_tenure_months", "customer_since",
    "avg_monthly_revenue_gbp", "avg_monthly_cost_gbp", "avg_monthly_margin_gbp", "projected_commercial_ltv_gbp",
    "projected_gaap_ltv_gbp", "estimated_cac_gbp", "acquisition_date", "first_revenue_date", "last_revenue_date",
    "gaap_months_with_revenue", "ltv_to_cac_ratio", "cac_payback_months", "profitability_tier", "customer_status"]

# Margin above the bound -> tier, best first.
PROFIT_TIERS = [(10000, "PLATINUM"), (5000, "GOLD"), (1000, "SILVER"), (0, "BRONZE")]


def _tier(margin: Column) -> Column:
    tier = F.lit("UNPROFITABLE")
    for bound, label in reversed(PROFIT_TIERS):
        tier = F.when(margin > bound, F.lit(label)).otherwise(tier)
    return tier


def customer_ltv(idmap: DataFrame, revenue: DataFrame, cost: DataFrame, snapshots: DataFrame,
                 opportunities: DataFrame, as_of: str | dt.date,
                 thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Lifetime value, acquisition ratios, tier and status per customer."""
    rows = ltv_calculation(idmap, revenue, cost, snapshots, opportunities, as_of, thresholds)
    cac, margin = F.col("estimated_cac_gbp"), F.col("avg_monthly_margin_gbp")
    recent = F.add_months(date_lit(as_of), -3)
    return rows.withColumns({
        "ltv_to_cac_ratio": F.when(cac > 0, ratio("projected_commercial_ltv_gbp", cac)),
        "cac_payback_months": F.when(margin > 0, ratio(cac, margin)),
        "profitability_tier": _tier(F.col("gross_margin_direct_cost_gbp")),
        "customer_status": F.when(F.col("commercial_current_mrr_gbp") > 0, "ACTIVE")
        .when(F.col("last_revenue_date") >= recent, "RECENTLY_CHURNED").otherwise("CHURNED"),
    }).select(*LTV_COLUMNS)


# --- project performance ---------------------------------------------------------


def project_costs(projects: DataFrame, time_entries: DataFrame, idmap: DataFrame) -> DataFrame:
    """Hours, cost and activity dates per project.

    Time entries are summed per project before the join, so a project that holds a
    large share of them is one row by then.
    """
    hours = zero_if_null(F.col("hours").cast("decimal(18,2)"))
    rate = zero_if_null(F.col("cost_rate_gbp_per_hour").cast("decimal(18,2)"))
    spent = time_entries.filter(F.col("project_id").isNotNull()).groupBy(
        F.col("project_id").alias("__project")).agg(
        F.min("date").alias("project_start_date"), F.max("date").alias("project_last_activity_date"),
        F.sum(hours).alias("total_hours_to_date"), F.sum(hours * rate).alias("actual_cost_to_date_gbp"))
    owned = attribute(projects.filter(F.col("project_id").isNotNull()).select("project_id", "client_id", "name")
                      .withColumnRenamed("client_id", "harvest_client_id"),
                      idmap.select(F.col("harvest_client_id").alias("__client"), CUSTOMER, "customer_name"),
                      "harvest_client_id", "__client")
    rows = lookup(owned, spent, "project_id", "__project")
    return rows.groupBy("project_id", "harvest_client_id", CUSTOMER, "customer_name",
                        F.col("name").alias("project_name")).agg(
        F.min("project_start_date").alias("project_start_date"),
        F.max("project_last_activity_date").alias("project_last_activity_date"),
        zero_if_null(F.sum("total_hours_to_date")).alias("total_hours_to_date"),
        zero_if_null(F.sum("actual_cost_to_date_gbp")).alias("actual_cost_to_date_gbp"))


def latest_contract(opportunities: DataFrame, idmap: DataFrame) -> DataFrame:
    """Latest closed-won contract per customer; its yearly value stands for the budget."""
    won = closed_won(opportunities, idmap)
    start = F.coalesce("contract_start_date", "close_date")
    best = top1(won, [CUSTOMER], [start.desc_nulls_first(), F.col("close_date").desc_nulls_first(),
                                  F.col("opportunity_id").asc_nulls_last()])
    return best.select(CUSTOMER, "opportunity_id", F.col("arr_booked_gbp").alias("project_budget_gbp"),
                       "contract_start_date", "contract_end_date")


def project_performance(projects: DataFrame, time_entries: DataFrame, opportunities: DataFrame,
                        idmap: DataFrame, as_of: str | dt.date,
                        thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Budget use, completion, burn rate, forecast and alert per project and customer."""
    rows = project_costs(projects, time_entries, idmap).join(latest_contract(opportunities, idmap), CUSTOMER, "left")
    today = date_lit(as_of)
    start, end = F.col("contract_start_date"), F.col("contract_end_date")
    term = day_diff(start, end)
    has_term = is_true(end > start)
    worked = day_diff("project_start_date", today)
    spent, budget = F.col("actual_cost_to_date_gbp").cast("double"), F.col("project_budget_gbp").cast("double")
    forecastable = has_term & F.col("burn_rate_gbp_per_day").isNotNull()
    elapsed = ratio(day_diff(start, today), term)
    return (rows.withColumn("project_budget_gbp", zero_if_null("project_budget_gbp"))
            .withColumn("budget_utilization_pct", F.when(F.col("project_budget_gbp") > 0, spent / budget))
            .withColumn("project_completion_pct",
                        F.when(has_term, least_or_null(F.lit(1.0), F.when(
                            elapsed.isNotNull(), F.greatest(F.lit(0.0), elapsed)))))
            .withColumn("burn_rate_gbp_per_day", F.when(worked > 0, spent / worked))
            .withColumn("projected_total_cost_gbp",
                        F.when(forecastable, F.col("burn_rate_gbp_per_day") * term))
            .withColumn("projected_overrun_gbp", F.when(
                F.col("project_budget_gbp") > 0, F.col("projected_total_cost_gbp") - budget))
            .withColumn("is_at_risk", is_true(
                (F.col("budget_utilization_pct") > thresholds.at_risk_budget)
                & (F.coalesce("project_completion_pct", F.lit(1.0)) < thresholds.at_risk_completion)))
            .select(surrogate_key(CUSTOMER, "project_id").alias("project_performance_id"), CUSTOMER,
                    "customer_name", F.col("project_id").alias("harvest_project_id"), "project_name",
                    "project_budget_gbp", "actual_cost_to_date_gbp", "budget_utilization_pct",
                    "contract_start_date", "contract_end_date", "project_start_date",
                    "project_last_activity_date", "project_completion_pct", "burn_rate_gbp_per_day",
                    "projected_total_cost_gbp", "projected_overrun_gbp", "is_at_risk"))
