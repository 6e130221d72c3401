"""Landing schema and the column specs of the 23 staged tables.

A staging model is data, not code: (column, JSON field, kind) triples that
:func:`ledgerloom.sources.staging.stage` turns into one projection.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("metadata_filename", T.StringType()),
    T.StructField("metadata_row_number", T.LongType()),
    T.StructField("metadata_ingest_time", T.TimestampType(), nullable=False),
    T.StructField("record_content", T.VariantType()),
])


class Field(NamedTuple):
    name: str
    path: str
    kind: str  # string | number | date | timestamp | variant


def _fields(**kinds: str) -> list[Field]:
    """``kind='a b c'`` keyword lists; ``column<-field`` renames."""
    out = []
    for kind, names in kinds.items():
        for entry in names.split():
            name, _, path = entry.partition("<-")
            out.append(Field(name, path or name, kind))
    return out


# Table name -> columns by kind, as the landing documents define them.
STAGING: dict[str, list[Field]] = {
    "harvest_clients": _fields(string="client_id name"),
    "harvest_projects": _fields(string="project_id client_id name", number="billable"),
    "harvest_time_entries": _fields(
        string="entry_id project_id person role linked_jira_issue_id notes",
        number="hours billable_rate_gbp_per_hour cost_rate_gbp_per_hour", date="date"),
    "intacct_customers": _fields(string="customer_id customer_name status", date="created_date"),
    "intacct_gl_entries": _fields(
        string="entry_id customer_id account description department cost_center product",
        number="amount_gbp", date="date"),
    "intacct_revenue_recognition": _fields(
        string="revrec_id customer_id month",
        number="booked_arr_gbp recognized_revenue_gbp deferred_revenue_gbp"),
    "jira_issues": _fields(
        string="issue_id account_id zendesk_ticket_id summary issue_type status priority",
        number="story_points time_spent_hours", timestamp="created_at resolved_at"),
    "mixpanel_events": _fields(
        string="event_id event_name distinct_id company_id", number="event_value",
        timestamp="timestamp", variant="event_properties<-properties"),
    "sf_accounts": _fields(
        string="account_id account_name industry segment country billing_city billing_postcode",
        number="employee_count", date="created_date"),
    "sf_opportunities": _fields(
        string="opportunity_id account_id stage product_plan billing_frequency",
        number="arr_booked_gbp discount_pct",
        date="created_date close_date contract_start_date contract_end_date renewal_date"),
    "sf_users": _fields(string="user_id email full_name role slack_user_handle"),
    "stripe_balance_transactions": _fields(
        string="balance_txn_id source_charge_id", timestamp="created_at", number="gross_gbp fee_gbp net_gbp"),
    "stripe_charges": _fields(
        string="charge_id customer_id invoice_id status payment_method", timestamp="created_at",
        number="amount_gbp"),
    "stripe_customers": _fields(string="customer_id company_name email_domain", timestamp="created_at"),
    "stripe_disputes": _fields(
        string="dispute_id charge_id status reason", timestamp="created_at", number="amount_gbp"),
    "stripe_invoice_line_items": _fields(
        string="invoice_line_item_id invoice_id description revenue_category",
        number="amount_gbp quantity unit_price_gbp"),
    "stripe_invoices": _fields(
        string="invoice_id customer_id subscription_id status", date="invoice_date period_start period_end",
        timestamp="paid_at", number="amount_due_gbp amount_paid_gbp"),
    "stripe_refunds": _fields(string="refund_id charge_id reason", timestamp="created_at", number="amount_gbp"),
    "stripe_subscriptions": _fields(
        string="subscription_id customer_id plan_id plan_name status",
        date="start_date current_period_start current_period_end", number="cancel_at_period_end mrr_gbp"),
    "zendesk_organizations": _fields(string="organization_id account_id name", timestamp="created_at"),
    "zendesk_ticket_events": _fields(
        string="event_id ticket_id event_type actor notes to_tier", timestamp="timestamp"),
    "zendesk_tickets": _fields(
        string="ticket_id organization_id status priority type channel subject tags severity assigned_group",
        timestamp="created_at updated_at"),
    "zendesk_time_entries": _fields(
        string="time_entry_id ticket_id agent_id work_type", date="date", number="time_spent_minutes tier"),
}

# Source group -> file prefix of its tables.
SOURCE_GROUPS: dict[str, str] = {
    "harvest": "harvest",
    "intacct": "intacct",
    "jira": "jira",
    "mixpanel": "mixpanel",
    "salesforce": "sf",
    "stripe": "stripe",
    "zendesk": "zendesk",
}

_KIND_TYPES = {"string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampNTZType(),
               "variant": T.VariantType()}

METADATA_FIELDS = [
    T.StructField("_source_file", T.StringType()),
    T.StructField("_row_num", T.LongType()),
    T.StructField("_ingested_at", T.TimestampType()),
]


def staged_schema(table: str, number_scale: int = 0) -> T.StructType:
    """Declared schema of a staged table, for contracts and hand-made rows."""
    typed = [
        T.StructField(f.name, T.DecimalType(38, number_scale) if f.kind == "number" else _KIND_TYPES[f.kind])
        for f in STAGING[table]
    ]
    return T.StructType(METADATA_FIELDS + typed)


def tables_of(group: str) -> list[str]:
    """Staged table names of one source group."""
    prefix = SOURCE_GROUPS[group] + "_"
    return [t for t in STAGING if t.startswith(prefix)]
