"""Identity resolution: one ``master_customer_id`` per customer across all systems."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import INTACCT_PREFIX, STRIPE_PREFIX, ZENDESK_PREFIX, prefixed
from ..functions.scalars import flag
from ..operators.relational import lookup, or_join, union_all, unmatched

# Identifier columns in map order.
IDENTIFIERS = ["account_id", "stripe_customer_id", "intacct_customer_id", "zendesk_organization_id",
               "harvest_client_id", "jira_account_key", "mixpanel_company_id"]

# Rank of an identity source when several describe one customer.
SOURCE_PRIORITY = {"GROUND_TRUTH": 1, "ZENDESK_LINKED": 2, "SALESFORCE_ONLY": 3, "STRIPE_ONLY": 4,
                   "INTACCT_ONLY": 5, "ZENDESK_ONLY": 6}
UNKNOWN_PRIORITY = 99

GROUND_TRUTH_SCHEMA = ("company_name string, harvest_client_id string, intacct_customer_id string, "
                       "jira_account_key string, mixpanel_company_id string, salesforce_account_id string, "
                       "stripe_customer_id string, zendesk_organization_id string")


def ground_truth(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Known mappings given inline, in seed column order."""
    return spark.createDataFrame(list(rows), GROUND_TRUTH_SCHEMA)


def _identity(df: DataFrame, master: Column, name: Column, source: Column, **ids: Column) -> DataFrame:
    """Project a source to the identity layout; identifiers it lacks are null."""
    missing = F.lit(None).cast("string")
    columns = [ids.get(c, missing).alias(c) for c in IDENTIFIERS]
    return df.select(master.alias("master_customer_id"), name.alias("customer_name"), *columns,
                     source.alias("identity_source"))


def truth_identities(seed: DataFrame) -> DataFrame:
    """Ground-truth rows; the CRM account id is the master id."""
    ids = {c: F.col(c) for c in IDENTIFIERS if c != "account_id"}
    return _identity(seed, F.col("salesforce_account_id"), F.col("company_name"), F.lit("GROUND_TRUTH"),
                     account_id=F.col("salesforce_account_id"), **ids)


def residual_identities(df: DataFrame, truth: DataFrame, key: str, truth_key: str, prefix: str, label: str,
                        name: str) -> DataFrame:
    """Customers of one system that ground truth does not know."""
    master = prefixed(prefix, key) if prefix else F.col(key)
    return _identity(unmatched(df, truth, key, truth_key), master, F.col(name), F.lit(label),
                     **{truth_key: F.col(key)})


def residual_orgs(orgs: DataFrame, truth: DataFrame) -> DataFrame:
    """Helpdesk organisations not in ground truth, linked to their CRM account when they name one."""
    rest = unmatched(orgs, truth, "organization_id", "zendesk_organization_id")
    linked = F.col("account_id").isNotNull()
    return _identity(
        rest,
        F.coalesce(F.col("account_id"), prefixed(ZENDESK_PREFIX, "organization_id")),
        F.col("name"),
        F.when(linked, F.lit("ZENDESK_LINKED")).otherwise(F.lit("ZENDESK_ONLY")),
        account_id=F.col("account_id"), zendesk_organization_id=F.col("organization_id"))


def all_identities(seed: DataFrame, accounts: DataFrame, billing: DataFrame, ledger: DataFrame,
                   orgs: DataFrame) -> DataFrame:
    """Every identity candidate of every system."""
    truth = truth_identities(seed)
    return union_all(
        truth,
        residual_identities(accounts, truth, "account_id", "account_id", "", "SALESFORCE_ONLY", "account_name"),
        residual_identities(billing, truth, "customer_id", "stripe_customer_id", STRIPE_PREFIX, "STRIPE_ONLY",
                            "company_name"),
        residual_identities(ledger, truth, "customer_id", "intacct_customer_id", INTACCT_PREFIX, "INTACCT_ONLY",
                            "customer_name"),
        residual_orgs(orgs, truth))


def populated(columns: Sequence[str]) -> Column:
    """How many of the columns are not null."""
    return F.expr(" + ".join(f"int({c} is not null)" for c in columns))


def score_identities(df: DataFrame) -> DataFrame:
    """Add the source priority and the number of populated identifiers."""
    ranks = " ".join(f"when '{source}' then {rank}" for source, rank in SOURCE_PRIORITY.items())
    priority = F.expr(f"case identity_source {ranks} else {UNKNOWN_PRIORITY} end")
    return df.withColumns({
        "identity_source_priority": priority,
        "identifiers_populated": populated(IDENTIFIERS),
    })


def _canonical(*columns: str) -> Column:
    """The wanted columns of the best record: lowest priority, most identifiers, first name.

    A ``min_by`` over an ordering struct replaces a ranking window: it combines on the
    map side, so a master id with many candidates stays cheap. Null names sort last;
    the identifiers break remaining ties.
    """
    order = F.struct(F.col("identity_source_priority"), -F.col("identifiers_populated"),
                     F.col("customer_name").isNull(), F.col("customer_name"),
                     *[F.col(c) for c in IDENTIFIERS])
    return F.min_by(F.struct(*columns), order)


def canonical_identity(scored: DataFrame) -> DataFrame:
    """The best record per master id, whole."""
    fields = [*IDENTIFIERS, "customer_name", "identity_source"]
    return (scored.groupBy("master_customer_id").agg(_canonical(*fields).alias("best"))
            .select("master_customer_id", "best.*"))


def collapse_identities(scored: DataFrame) -> DataFrame:
    """One row per master id: merged identifiers, coverage, ground-truth and conflict flags.

    An identifier conflicts when its smallest and largest value differ, which needs no
    distinct count. Name and source come from the best record of the same aggregation.
    """
    merged = scored.groupBy("master_customer_id").agg(
        *[F.max(c).alias(c) for c in IDENTIFIERS],
        *[F.min(c).alias(f"__min_{c}") for c in IDENTIFIERS],
        F.bool_or(F.col("identity_source") == "GROUND_TRUTH").alias("has_ground_truth"),
        _canonical("customer_name", "identity_source").alias("best"))
    conflict = F.expr(" or ".join(f"coalesce({c} != __min_{c}, false)" for c in IDENTIFIERS))
    return merged.select(
        "master_customer_id", *IDENTIFIERS, "best.customer_name", "best.identity_source",
        populated(IDENTIFIERS).alias("source_system_count"),
        "has_ground_truth", conflict.alias("has_conflicts"))


def with_seen_range(df: DataFrame, accounts: DataFrame, billing: DataFrame, ledger: DataFrame,
                    orgs: DataFrame) -> DataFrame:
    """Add first and last creation date over the four systems (nulls are skipped)."""
    sources = [
        (accounts, "account_id", "account_id", "created_date", "__seen_crm"),
        (billing, "customer_id", "stripe_customer_id", "created_at", "__seen_billing"),
        (ledger, "customer_id", "intacct_customer_id", "created_date", "__seen_ledger"),
        (orgs, "organization_id", "zendesk_organization_id", "created_at", "__seen_desk"),
    ]
    for source, source_key, key, created, name in sources:
        dates = source.select(F.col(source_key).alias("__id"), F.col(created).cast("date").alias(name))
        df = lookup(df, dates, key, "__id", spread_by="master_customer_id")
    seen = [name for *_, name in sources]
    return df.withColumns({"first_seen_at": F.least(*seen), "last_seen_at": F.greatest(*seen)}).drop(*seen)


def identity_map(seed: DataFrame, accounts: DataFrame, billing: DataFrame, ledger: DataFrame,
                 orgs: DataFrame) -> DataFrame:
    """The identity map every other model joins to."""
    scored = score_identities(all_identities(seed, accounts, billing, ledger, orgs))
    return with_seen_range(collapse_identities(scored), accounts, billing, ledger, orgs)


# Score -> (method, confidence) of a user-to-customer match.
MATCH_LABELS = {2: ("MIXPANEL_COMPANY_ID", "HIGH"), 1: ("SALESFORCE_ACCOUNT_ID", "MEDIUM"), 0: ("UNMAPPED", "NONE")}


def user_company_activity(events: DataFrame) -> DataFrame:
    """First and last event and row count per (user, company)."""
    return (events.filter(F.col("distinct_id").isNotNull())
            .groupBy(F.col("distinct_id").alias("user_identifier"), "company_id")
            .agg(F.min("timestamp").alias("first_seen_at"), F.max("timestamp").alias("last_seen_at"),
                 F.count(F.lit(1)).alias("event_row_count")))


def match_candidates(activity: DataFrame, idmap: DataFrame) -> DataFrame:
    """Customers a (user, company) may belong to, with method, confidence and score."""
    matched = or_join(activity, idmap, "company_id", [("mixpanel_company_id", 2), ("account_id", 1)],
                      "master_customer_id", "mapping_score", "user_identifier")
    method, confidence = F.lit("UNMAPPED"), F.lit("NONE")
    for score in (1, 2):
        hit = F.col("mapping_score") == score
        method = F.when(hit, F.lit(MATCH_LABELS[score][0])).otherwise(method)
        confidence = F.when(hit, F.lit(MATCH_LABELS[score][1])).otherwise(confidence)
    return matched.withColumns({"mapping_method": method, "mapping_confidence": confidence})


def rank_candidates(candidates: DataFrame) -> DataFrame:
    """Best candidate per user with its conflict metrics, in one aggregation.

    Best is highest score, then latest activity (unknown first), then most events;
    company and customer break ties. ``max_by`` and the distinct counts share one
    shuffle and combine on the map side.
    """
    order = F.struct(F.col("mapping_score"), F.col("last_seen_at").isNull(), F.col("last_seen_at"),
                     F.col("event_row_count"), F.col("company_id"), F.col("master_customer_id"))
    row = F.struct("company_id", "master_customer_id", "mapping_method", "mapping_confidence",
                   "first_seen_at", "last_seen_at")
    ranked = candidates.groupBy("user_identifier").agg(
        F.max_by(row, order).alias("best"),
        F.count_distinct(F.when(F.col("mapping_score") > 0, F.col("master_customer_id"))).alias(
            "mapped_customer_count"),
        F.count_distinct("company_id").alias("company_id_count"))
    return ranked.select(
        "user_identifier", "best.company_id", "best.master_customer_id", "best.mapping_method",
        "best.mapping_confidence", flag(F.col("mapped_customer_count") > 1).alias("has_conflict"),
        "mapped_customer_count", "company_id_count", "best.first_seen_at", "best.last_seen_at")


def user_customer_map(events: DataFrame, idmap: DataFrame) -> DataFrame:
    """One customer per product user; users without a match are left out."""
    ranked = rank_candidates(match_candidates(user_company_activity(events), idmap))
    return ranked.filter(F.col("master_customer_id").isNotNull())


def unified_customers(billing: DataFrame) -> DataFrame:
    """Customer attributes of billing customers with an email domain."""
    missing = F.lit(None).cast("string")
    return billing.filter(F.col("email_domain").isNotNull()).select(
        "email_domain", missing.alias("first_name"), missing.alias("last_name"),
        F.col("company_name").alias("company"), F.col("customer_id").alias("stripe_customer_id"),
        F.col("created_at").alias("first_seen_at"), F.col("created_at").alias("last_seen_at"))
