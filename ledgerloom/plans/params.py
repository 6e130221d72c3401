"""Business constants; every one can be overridden per tenant."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rates:
    """Cost assumptions in GBP per hour (fixed values)."""

    support_tier_1: float = 25
    support_tier_2: float = 35
    support_tier_3: float = 50
    support_default: float = 30
    engineering: float = 60


@dataclass(frozen=True)
class Thresholds:
    """Cut-offs of scores and classes (fixed values)."""

    usage_spine_days: int = 121
    rolling_days: int = 30
    late_after_days: int = 14
    open_invoice_days: int = 30
    paid_window_days: int = 90
    contract_months_cap: int | None = 240
    default_contract_months: int = 12
    projection_months: int = 36
    estimated_cac_gbp: int = 1000
    high_value_arr_gbp: int = 50000
    decline_ratio: float = -0.20
    spike_ratio: float = 1.20
    at_risk_budget: float = 0.80
    at_risk_completion: float = 0.50
    activation_days: int = 30
    key_action_words: tuple[str, ...] = ("purchase", "upgrade")
    login_words: tuple[str, ...] = ("login",)


RATES = Rates()
THRESHOLDS = Thresholds()
