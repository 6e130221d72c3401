"""The test tables in the shape of the staged feeds.

Commerce dates are moved by a fixed number of days so that they end where the
product events end; every row of every table takes part.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.session import cut_lineage, tune
from ..plans import identity, ledgers, support, usage

AS_OF = "2024-02-20"
SHIFT_DAYS = 8238
AMOUNT = "decimal(18,2)"

# Tables that grow with the business, and columns that tell their rows apart.

# Customers of these market segments are in the ground-truth seed.
KNOWN_SEGMENTS = ["BUILDING", "MACHINERY"]

# Staged table -> attribute of its stand-in.
FEEDS = {
    "harvest_clients": "harvest_clients", "harvest_projects": "projects", "harvest_time_entries": "delivery_time",
    "intacct_customers": "ledger", "intacct_gl_entries": "gl_entries", "intacct_revenue_recognition": "revrec",
    "jira_issues": "issues", "mixpanel_events": "product_events", "sf_accounts": "accounts",
    "sf_opportunities": "opportunities", "sf_users": "sf_users",
    "stripe_balance_transactions": "balance_transactions", "stripe_charges": "charges",
    "stripe_customers": "billing", "stripe_disputes": "disputes", "stripe_invoice_line_items": "invoice_lines",
    "stripe_invoices": "invoices", "stripe_refunds": "refunds", "stripe_subscriptions": "subscriptions",
    "zendesk_organizations": "orgs", "zendesk_ticket_events": "ticket_events", "zendesk_tickets": "tickets",
    "zendesk_time_entries": "support_time",
}


# Fields of the landing documents that no model reads, as SQL over the stand-in's columns that both engines know.
DOCUMENT_FIELDS = {
    "intacct_customers": {"status": "CASE WHEN customer_id LIKE 'INTACCT_S%' THEN 'vendor' ELSE 'active' END"},
    "intacct_gl_entries": {
        "description": "account || ' of ' || customer_id", "cost_center": "'CC-' || department",
        "product": "CASE WHEN account = 'R' THEN 'returns' END"},
    "sf_accounts": {
        "industry": "LOWER(segment)", "country": "CASE segment WHEN 'BUILDING' THEN 'GB' WHEN 'MACHINERY' THEN 'IE' END",
        "billing_city": "'City ' || RIGHT(account_id, 1)", "billing_postcode": "'PC' || RIGHT(account_id, 3)",
        "employee_count": "LENGTH(segment) * 10"},
    "sf_opportunities": {
        "product_plan": "CASE stage WHEN 'Closed Won' THEN 'pro' ELSE 'trial' END",
        "billing_frequency": "CASE WHEN arr_booked_gbp > 100000 THEN 'annual' ELSE 'monthly' END",
        "discount_pct": "CASE WHEN arr_booked_gbp > 200000 THEN 10 ELSE 0 END", "created_date": "close_date - 30",
        "renewal_date": "contract_end_date + 1"},
    "sf_users": {"slack_user_handle": "'@' || LOWER(full_name)"},
    "stripe_charges": {
        "status": "CASE WHEN amount_gbp > 100000 THEN 'pending' ELSE 'succeeded' END",
        "payment_method": "CASE WHEN customer_id LIKE '%1' THEN 'bacs_debit' ELSE 'card' END",
        "created_at": "DATE '2024-01-01' + CAST(FLOOR(amount_gbp % 28) AS INT)"},
    "stripe_disputes": {"reason": "CASE status WHEN 'lost' THEN 'fraudulent' ELSE 'duplicate' END"},
    "stripe_invoice_line_items": {
        "description": "'line of ' || invoice_id", "revenue_category": "CASE WHEN amount_gbp > 20000 THEN 'services' ELSE 'subscription' END",
        "quantity": "CASE WHEN amount_gbp > 1000 THEN 2 ELSE 1 END", "unit_price_gbp": "FLOOR(amount_gbp)"},
    "stripe_invoices": {"period_start": "invoice_date - 30", "period_end": "invoice_date"},
    "stripe_subscriptions": {
        "plan_id": "'plan_' || status", "plan_name": "CASE WHEN mrr_gbp > 100000 THEN 'Enterprise' ELSE 'Team' END",
        "start_date": "current_period_start - 365", "current_period_end": "current_period_start + 30",
        "cancel_at_period_end": "CASE status WHEN 'past_due' THEN 1 ELSE 0 END"},
    "zendesk_ticket_events": {"notes": "CASE actor WHEN 'agent' THEN 'by ' || actor END", "to_tier": "CASE event_type WHEN 'signup' THEN '2' END"},
    "zendesk_tickets": {"tags": "status || ',' || priority", "updated_at": "created_at + INTERVAL 2 HOURS"},
}


def _id(prefix: str, column: str) -> Column:
    return F.expr(f"concat('{prefix}', cast({column} as string))")


def _day(column: str) -> Column:
    return F.expr(f"date_add(cast({column} as date), {SHIFT_DAYS})")


def _created(first: str) -> Column:
    return F.expr(f"date_add(date'{first}', cast(floor(abs(c_acctbal) / 10) as int))")


def _at(column: str) -> Column:
    return _day(column).cast("timestamp_ntz")


def _amount(column: Column) -> Column:
    return column.cast(AMOUNT)


class StandIns:
    """Staged feeds built from one directory of test tables; everything is lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark, hashed=True)
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A test table; its footer is read once per instance."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # --- customers ---------------------------------------------------------------

    @cached_property
    def seed(self) -> DataFrame:
        known = self.table("customer").filter(F.col("c_mktsegment").isin(KNOWN_SEGMENTS))
        return known.select(
            F.col("c_name").alias("company_name"), _id("HV_", "c_custkey").alias("harvest_client_id"),
            _id("INTACCT_", "c_custkey").alias("intacct_customer_id"),
            _id("JIRA_", "c_custkey").alias("jira_account_key"),
            _id("mp_", "c_custkey").alias("mixpanel_company_id"),
            _id("SF_", "c_custkey").alias("salesforce_account_id"),
            _id("cus_", "c_custkey").alias("stripe_customer_id"),
            _id("ZD_", "c_custkey").alias("zendesk_organization_id"))

    @cached_property
    def accounts(self) -> DataFrame:
        """Customers, created on a day that follows from their balance."""
        return self.table("customer").select(
            _id("SF_", "c_custkey").alias("account_id"), F.col("c_name").alias("account_name"),
            F.col("c_mktsegment").alias("segment"), _created("2020-01-01").alias("created_date"))

    @cached_property
    def billing(self) -> DataFrame:
        """Customers in debit have no email domain."""
        return self.table("customer").select(
            _id("cus_", "c_custkey").alias("customer_id"), F.col("c_name").alias("company_name"),
            F.expr("case when c_acctbal >= 0 then concat(lower(replace(c_name, '#', '-')), '.example') end").alias(
                "email_domain"),
            _created("2021-01-01").cast("timestamp_ntz").alias("created_at"))

    @cached_property
    def ledger(self) -> DataFrame:
        """Customers and, as a disjoint system, suppliers."""
        customers = self.table("customer").select(
            _id("INTACCT_", "c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
            F.lit("2017-01-01").cast("date").alias("created_date"))
        suppliers = self.table("supplier").select(
            _id("INTACCT_S", "s_suppkey").alias("customer_id"), F.col("s_name").alias("customer_name"),
            F.lit("2018-01-01").cast("date").alias("created_date"))
        return customers.unionByName(suppliers)

    @cached_property
    def orgs(self) -> DataFrame:
        """One organisation per customer (without an account when in debit) and one more per supplier."""
        customers = self.table("customer").select(
            _id("ZD_", "c_custkey").alias("organization_id"), F.col("c_name").alias("name"),
            F.when(F.col("c_acctbal") >= 0, _id("SF_", "c_custkey")).alias("account_id"),
            F.lit("2016-06-01").cast("timestamp_ntz").alias("created_at"))
        suppliers = self.table("supplier").select(
            _id("ZD_S", "s_suppkey").alias("organization_id"), F.col("s_name").alias("name"),
            _id("SF_", "s_suppkey").alias("account_id"), F.lit("2019-06-01").cast("timestamp_ntz").alias("created_at"))
        return customers.unionByName(suppliers)

    # --- billing -----------------------------------------------------------------

    @cached_property
    def invoices(self) -> DataFrame:
        """Orders: F paid, O open, P void; paid after as many days as the order's day of month."""
        price = _amount(F.col("o_totalprice"))
        paid = F.col("o_orderstatus") == "F"
        return self.table("orders").select(
            _id("in_", "o_orderkey").alias("invoice_id"), _id("cus_", "o_custkey").alias("customer_id"),
            _id("sub_", "o_custkey").alias("subscription_id"), _day("o_orderdate").alias("invoice_date"),
            F.when(paid, F.date_add(_day("o_orderdate"), F.dayofmonth("o_orderdate")).cast("timestamp_ntz")).alias(
                "paid_at"),
            price.alias("amount_due_gbp"), F.when(paid, price).alias("amount_paid_gbp"),
            F.when(paid, "paid").when(F.col("o_orderstatus") == "O", "open").otherwise("void").alias("status"))

    @cached_property
    def invoice_lines(self) -> DataFrame:
        net = F.col("l_extendedprice").cast(AMOUNT) * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
        return self.table("lineitem").select(_line_id("li_").alias("invoice_line_item_id"),
                                             _id("in_", "l_orderkey").alias("invoice_id"),
                                             net.cast("decimal(18,4)").alias("amount_gbp"))

    @cached_property
    def charges(self) -> DataFrame:
        return self.table("orders").select(
            _id("ch_", "o_orderkey").alias("charge_id"), _id("cus_", "o_custkey").alias("customer_id"),
            _id("in_", "o_orderkey").alias("invoice_id"), _amount(F.col("o_totalprice")).alias("amount_gbp"))

    @cached_property
    def refunds(self) -> DataFrame:
        """Returned lines; the reason is unknown for open lines."""
        return self.table("lineitem").filter(F.col("l_returnflag") == "R").select(
            _line_id("re_").alias("refund_id"), _id("ch_", "l_orderkey").alias("charge_id"),
            _at("l_shipdate").alias("created_at"), _amount(F.col("l_extendedprice")).alias("amount_gbp"),
            F.when(F.col("l_linestatus") == "F", "customer_request").alias("reason"))

    @cached_property
    def disputes(self) -> DataFrame:
        """Accepted lines: lost when filled, else still open."""
        return self.table("lineitem").filter(F.col("l_returnflag") == "A").select(
            _line_id("dp_").alias("dispute_id"), _id("ch_", "l_orderkey").alias("charge_id"),
            _at("l_shipdate").alias("created_at"), _amount(F.col("l_extendedprice")).alias("amount_gbp"),
            F.when(F.col("l_linestatus") == "F", "lost").otherwise("needs_response").alias("status"))

    @cached_property
    def subscriptions(self) -> DataFrame:
        """Every order is a subscription period of its customer and priority class."""
        return self.table("orders").select(
            F.concat_ws("-", _id("sub_", "o_custkey"), "o_orderpriority").alias("subscription_id"),
            _id("cus_", "o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") == "P", "past_due").otherwise("active").alias("status"),
            _day("o_orderdate").alias("current_period_start"),
            _amount(F.col("o_totalprice")).alias("mrr_gbp"))

    @cached_property
    def opportunities(self) -> DataFrame:
        """Orders; urgent and high priority are won, filled ones have an open end."""
        won = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        start = _day("o_orderdate")
        return self.table("orders").select(
            _id("OPP_", "o_orderkey").alias("opportunity_id"), _id("SF_", "o_custkey").alias("account_id"),
            F.when(won, "Closed Won").otherwise("Closed Lost").alias("stage"),
            _amount(F.col("o_totalprice")).alias("arr_booked_gbp"), start.alias("contract_start_date"),
            F.when(F.col("o_orderstatus") != "F", F.add_months(start, 11)).alias("contract_end_date"),
            F.date_sub(start, 10).alias("close_date"))

    @cached_property
    def revrec(self) -> DataFrame:
        """Orders by month: filled ones are recognized, open ones partly deferred, others not recognized."""
        price = _amount(F.col("o_totalprice"))
        status = F.col("o_orderstatus")
        return self.table("orders").select(
            _id("RR_", "o_orderkey").alias("revrec_id"), _id("INTACCT_", "o_custkey").alias("customer_id"),
            F.date_format(_day("o_orderdate"), "yyyy-MM").alias("month"), price.alias("booked_arr_gbp"),
            F.when(status != "P", price).alias("recognized_revenue_gbp"),
            F.when(status == "O", (price * F.lit("0.25").cast("decimal(4,2)")).cast("decimal(18,4)"))
            .when(status == "F", F.lit(0).cast("decimal(18,4)")).alias("deferred_revenue_gbp"))

    # --- work --------------------------------------------------------------------

    @cached_property
    def projects(self) -> DataFrame:
        return self.table("part").select(
            _id("PRJ_", "p_partkey").alias("project_id"), _id("HV_", "p_partkey").alias("client_id"),
            F.col("p_name").alias("name"), F.lit(1).alias("billable"))

    @cached_property
    def delivery_time(self) -> DataFrame:
        """Lines as delivery work; lines without a return flag name no issue."""
        return self.table("lineitem").select(
            _line_id("te_").alias("entry_id"), _id("PRJ_", "l_partkey").alias("project_id"),
            _id("P", "l_suppkey").alias("person"), F.col("l_linestatus").alias("role"),
            F.when(F.col("l_returnflag") != "N", _id("J", "l_orderkey")).alias("linked_jira_issue_id"),
            F.col("l_quantity").cast(AMOUNT).alias("hours"),
            (F.col("l_discount") * 1000).cast(AMOUNT).alias("billable_rate_gbp_per_hour"),
            (F.col("l_tax") * 1000).cast(AMOUNT).alias("cost_rate_gbp_per_hour"),
            F.when(F.col("l_returnflag") == "R", "rework").alias("notes"), _day("l_shipdate").alias("date"))

    @cached_property
    def support_time(self) -> DataFrame:
        """Lines as support work; the tier is the line number, unknown for the last one."""
        line = F.col("l_linenumber")
        return self.table("lineitem").select(
            _line_id("ze_").alias("time_entry_id"), _id("T", "l_orderkey").alias("ticket_id"),
            _id("A", "l_suppkey").alias("agent_id"), _day("l_shipdate").alias("date"),
            (F.col("l_quantity").cast("int") * line).alias("time_spent_minutes"),
            F.when(F.col("l_linestatus") == "O", "GENERAL").alias("work_type"),
            F.when(line < 7, line).alias("tier"))

    @cached_property
    def tickets(self) -> DataFrame:
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        return self.table("orders").select(
            _id("T", "o_orderkey").alias("ticket_id"), _id("ZD_", "o_custkey").alias("organization_id"),
            _at("o_orderdate").alias("created_at"),
            F.when(status == "F", "solved").when(status == "P", "closed").otherwise("open").alias("status"),
            F.when(priority == "1-URGENT", "urgent").when(priority == "3-MEDIUM", "high").otherwise("normal").alias(
                "priority"),
            F.when(priority == "1-URGENT", "Critical").when(priority == "2-HIGH", "High")
            .when(priority == "3-MEDIUM", "Medium").when(priority == "5-LOW", "Low").alias("severity"),
            F.lit("incident").alias("type"), F.lit("web").alias("channel"),
            priority.alias("subject"), F.lit("desk").alias("assigned_group"))

    @cached_property
    def ticket_events(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            _id("E", "event_id").alias("event_id"), _id("T", "user_id").alias("ticket_id"),
            F.col("ts").alias("timestamp"),
            F.when(kind == "click", "comment").when(kind == "view", "status_change").otherwise(kind).alias(
                "event_type"),
            F.when(kind == "error", "requester").otherwise("agent").alias("actor"))

    @cached_property
    def issues(self) -> DataFrame:
        """One issue per order: its hours, first and last shipment; returned orders name their ticket."""
        lines = self.table("lineitem").groupBy("l_orderkey").agg(
            F.sum(F.col("l_quantity").cast(AMOUNT)).alias("hours"), F.min("l_shipdate").alias("first"),
            F.max("l_shipdate").alias("last"), F.bool_and(F.col("l_linestatus") == "F").alias("done"),
            F.char(F.max(F.ascii("l_returnflag"))).alias("flag"))  # one letter; numbers keep the aggregation hashed
        rows = lines.join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return rows.select(
            _id("J", "l_orderkey").alias("issue_id"), _id("JIRA_", "o_custkey").alias("account_id"),
            F.when(F.col("flag") == "R", _id("T", "l_orderkey")).alias("zendesk_ticket_id"),
            F.col("o_orderpriority").alias("summary"), F.col("flag").alias("issue_type"),
            F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
            F.lit(3).alias("story_points"), F.col("hours").cast(AMOUNT).alias("time_spent_hours"),
            _at("first").alias("created_at"), F.when(F.col("done"), _at("last")).alias("resolved_at"))

    # --- product events ----------------------------------------------------------

    @cached_property
    def product_events(self) -> DataFrame:
        """Events; views and clicks name a CRM account (clicks of the next customer), others a product company."""
        kind = F.col("event_type")
        company = (F.when(kind == "view", _id("SF_", "user_id"))
                   .when(kind == "click", F.concat(F.lit("SF_"), (F.col("user_id") + 1).cast("string")))
                   .when(kind != "error", _id("mp_", "user_id")))
        return self.table("events").select(
            _id("E", "event_id").alias("event_id"),
            F.when(kind == "signup", "User Login").when(kind == "purchase", "Plan PURCHASE").otherwise(kind).alias(
                "event_name"),
            _id("u", "user_id").alias("distinct_id"), company.alias("company_id"), F.col("value").alias("event_value"),
            F.col("ts").alias("timestamp"), F.col("props"))

    # --- feeds no model reads ----------------------------------------------------

    @cached_property
    def harvest_clients(self) -> DataFrame:
        return self.table("customer").select(_id("HV_", "c_custkey").alias("client_id"), F.col("c_name").alias("name"))

    @cached_property
    def gl_entries(self) -> DataFrame:
        return self.table("lineitem").select(
            _line_id("GL_").alias("entry_id"), _id("INTACCT_S", "l_suppkey").alias("customer_id"),
            F.col("l_returnflag").alias("account"), _amount(F.col("l_extendedprice")).alias("amount_gbp"),
            F.col("l_linestatus").alias("department"), _day("l_shipdate").alias("date"))

    @cached_property
    def sf_users(self) -> DataFrame:
        return self.table("supplier").select(
            _id("USR_", "s_suppkey").alias("user_id"), F.col("s_name").alias("full_name"),
            F.concat(_id("s", "s_suppkey"), F.lit("@example.com")).alias("email"), F.lit("Owner").alias("role"))

    @cached_property
    def balance_transactions(self) -> DataFrame:
        gross = _amount(F.col("o_totalprice"))
        fee = (gross * F.lit("0.02").cast("decimal(4,2)")).cast("decimal(18,4)")
        return self.table("orders").select(
            _id("txn_", "o_orderkey").alias("balance_txn_id"), _id("ch_", "o_orderkey").alias("source_charge_id"),
            _at("o_orderdate").alias("created_at"), gross.alias("gross_gbp"), fee.alias("fee_gbp"),
            (gross - fee).alias("net_gbp"))

    # --- landing documents -------------------------------------------------------

    def feed(self, table: str) -> DataFrame:
        """The stand-in of a staged table, by the staged name."""
        return getattr(self, FEEDS[table])

    def documents(self, table: str) -> DataFrame:
        """The stand-in as JSON texts, one document per row, as the source systems write them."""
        df = self.feed(table).withColumns({name: F.expr(text) for name, text in DOCUMENT_FIELDS.get(table, {}).items()})
        columns = [F.from_json("props", "k int").alias("properties") if f.name == "props"
                   else F.col(f.name).cast("string").alias(f.name)
                   if f.dataType.simpleString() in ("date", "timestamp_ntz") else F.col(f.name) for f in df.schema]
        rows = df.select(*columns)
        # A feed lands in many files. Rows are dealt by their hash: dealing them in turn sorts them first.
        dealt = rows.repartition(self.spark.sparkContext.defaultParallelism, F.xxhash64(*rows.columns))
        return dealt.select(F.to_json(F.struct(*dealt.columns)).alias("value"))

    def landing(self, table: str) -> DataFrame:
        return self.documents(table).select(F.parse_json("value").alias("record_content"))

    # --- shared results ----------------------------------------------------------

    @cached_property
    def idmap_plan(self) -> DataFrame:
        return identity.identity_map(self.seed, self.accounts, self.billing, self.ledger, self.orgs)

    @cached_property
    def idmap(self) -> DataFrame:
        """The identity map, written once: every model joins it several times."""
        return cut_lineage(self.idmap_plan)

    @cached_property
    def users(self) -> DataFrame:
        return cut_lineage(identity.user_customer_map(self.product_events, self.idmap))

    @cached_property
    def revenue(self) -> DataFrame:
        return ledgers.unified_revenue(self.invoices, self.charges, self.refunds, self.disputes, self.revrec,
                                       self.idmap)

    @cached_property
    def snapshots(self) -> DataFrame:
        return ledgers.mrr_snapshot(self.subscriptions, self.idmap)

    @cached_property
    def cost(self) -> DataFrame:
        owned = self.owned_issues
        return ledgers.unified_cost(
            ledgers.delivery_costs(self.delivery_time, self.projects, self.idmap, ledgers.issue_customer(owned)),
            self._support_costs, ledgers.engineering_costs(owned))

    @cached_property
    def _support_costs(self) -> DataFrame:
        return ledgers.support_costs(self.support_time, self.tickets, self.idmap)

    @cached_property
    def support_cost(self) -> DataFrame:
        """The support part of the cost ledger."""
        return ledgers.unified_cost(self._support_costs)

    @cached_property
    def owned_issues(self) -> DataFrame:
        return cut_lineage(ledgers.owned_issues(self.issues, self.idmap))

    @cached_property
    def usage_plan(self) -> DataFrame:
        return usage.product_usage(self.product_events, self.users, self.idmap, AS_OF)

    @cached_property
    def usage(self) -> DataFrame:
        """The usage model, written once: facts read it for several windows."""
        return cut_lineage(self.usage_plan)

    @cached_property
    def chain(self) -> DataFrame:
        return support.issue_resolution(support.resolution_chain(
            self.tickets, self.ticket_events, self.issues, self.delivery_time, self.support_time, self.idmap, AS_OF))


def _line_id(prefix: str) -> Column:
    return F.expr(f"concat('{prefix}', concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey))")

