"""Customer 360 dimension and the activation segment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_lit, day_diff
from ..functions.keys import surrogate_key
from .params import THRESHOLDS, Thresholds


def dim_customer_360(customers: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Unified customers with a key and the days since they were first seen."""
    return customers.select(
        surrogate_key("email_domain", "stripe_customer_id").alias("customer_key"), "email_domain", "first_name",
        "last_name", "company", "stripe_customer_id", "first_seen_at", "last_seen_at",
        day_diff("first_seen_at", date_lit(as_of)).alias("days_since_first_seen"))


def activation_customers(dimension: DataFrame, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Customers for sales outreach: known long enough and with a company name."""
    return dimension.filter((F.col("days_since_first_seen") > thresholds.activation_days)
                            & F.col("company").isNotNull()).select(
        "customer_key", "email_domain", "first_name", "last_name", "company",
        F.lit("high_engagement").alias("segment"),
        F.lit("Sales outreach for upsell").alias("recommended_action"))
