"""Registered queries of staging, ingestion, relational forms, functions, increments, snapshots and checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import aggregates, dates, keys, scalars, sqludf, types
from ..operators import incremental, quality, relational, snapshots
from ..operators.models import Dag
from ..operators.session import scratch_path
from ..schemas import STAGING
from ..sources import landing, partitions, staging
from ..sources.catalog import Catalog, load_seed
from ..sources.tables import (clone_table, export_segment, register_view, write_jsonl, write_path, write_table)
from ..streaming import ingest, refresh, totals
from . import oracle
from .model_queries import Query, paired
from .shape import finish
from .standins import AS_OF, DOCUMENT_FIELDS, FEEDS, StandIns


# --- staging: one query per staged table -----------------------------------------

_KIND = {"string": "s", "number": "f0", "date": "d", "timestamp": "t", "variant": "s"}
def stage_query(table: str) -> Query:
    fields = STAGING[table]

    def value(f) -> str:
        if f.kind == "variant":
            return f"REPLACE(props, ' ', '') AS {f.name}"
        if f.kind == "number":
            return f"ROUND(CAST({f.path} AS DECIMAL(30,6))) AS {f.name}"
        return f"{f.path} AS {f.name}"

    def run(s: StandIns) -> DataFrame:
        staged = staging.stage(table, s.landing(table))
        variants = [f.name for f in fields if f.kind == "variant"]
        return staged.withColumns({v: F.to_json(v) for v in variants}) if variants else staged

    spec = " ".join(f"{f.name}:{_KIND[f.kind]}" for f in fields)
    more = "".join(f", {text} AS {name}" for name, text in DOCUMENT_FIELDS.get(table, {}).items())
    return paired(run, f"SELECT {', '.join(value(f) for f in fields)} FROM (SELECT *{more} FROM {FEEDS[table]})", spec)


def stg_events_variant(s: StandIns) -> DataFrame:
    """Typed values straight out of the events' JSON text, at both number scales."""
    raw = s.table("events").select(
        "event_id", F.parse_json(F.to_json(F.struct(
            F.col("event_id").cast("string").alias("event_id"), F.col("value").alias("event_value"),
            F.col("ts").cast("string").alias("timestamp"), F.col("event_type").alias("event_name"),
            F.from_json("props", "k int").alias("properties")))).alias("record_content"))
    whole = staging.field("record_content", STAGING["mixpanel_events"][4], 0)
    pence = staging.field("record_content", STAGING["mixpanel_events"][4], 2)
    return raw.select("event_id", whole.alias("value_whole"), pence.alias("value_pence"),
                      F.try_variant_get("record_content", "$.properties.k", "int").alias("k"),
                      dates.try_timestamp(F.try_variant_get("record_content", "$.timestamp", "string")).alias("seen_at"),
                      dates.try_date(F.try_variant_get("record_content", "$.event_name", "string")).alias("no_date"))


def stg_lost_values(s: StandIns) -> DataFrame:
    """Events whose value text is not a number for errors: counted as lost, not dropped."""
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    raw = s.table("events").select(F.parse_json(F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"), text.alias("event_value")))).alias("record_content"))
    return staging.lost_values("mixpanel_events", raw).select("event_id", "event_value")


# --- ingestion -------------------------------------------------------------------


def _event_lines(s: StandIns) -> DataFrame:
    """Events as JSON lines, dealt to FILES files per event type; the large error events of half of them are cut off."""
    text = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"),
                              F.col("event_type").alias("event_name"), F.col("value").alias("event_value")))
    part = F.pmod("event_id", F.lit(FILES))
    cut = (F.col("event_type") == "error") & (F.col("value") > 100) & (part < FILES // 2)
    return s.table("events").select(F.when(cut, F.lit('{"cut')).otherwise(text).alias("value"), "event_type",
                                    part.alias("part"), "event_id")


def _write_by_type(lines: DataFrame, path: str) -> None:
    """Gzip files of lines in event order; a frequent type is spread over its files."""
    (lines.repartition("event_type", "part").sortWithinPartitions("event_type", "part", "event_id")
     .select("value", "event_type", "part").write.partitionBy("event_type", "part").option("compression", "gzip").text(path))


FILES = 8


def _file_of(column: str):
    return F.concat_ws("/", F.regexp_extract(column, r"event_type=([^/]+)/", 1), F.regexp_extract(column, r"part=([^/]+)/", 1))


def ingest_jsonl(s: StandIns) -> DataFrame:
    """Bulk load that skips the files with cut-off lines."""
    path = scratch_path(s.spark, "ingest")
    _write_by_type(_event_lines(s), path)
    raw = landing.load_raw(s.spark, path, pattern="*.gz")
    staged = staging.stage("mixpanel_events", raw)
    return staged.select(_file_of("_source_file").alias("file"), F.col("_row_num").alias("row_num"), "event_id",
                         "event_name", "event_value")


def ingest_validate(s: StandIns) -> DataFrame:
    path = scratch_path(s.spark, "validate")
    _write_by_type(_event_lines(s), path)
    return landing.validate_files(s.spark, path, "*.gz").withColumn("file", _file_of("file"))


def ingest_gate(s: StandIns) -> DataFrame:
    """Listing of one batch per event day; days with more errors than clicks have no marker."""
    daily = s.table("events").groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.count_if(F.col("event_type") == "click").alias("clicks"))

    def path(file: str):
        return F.concat(F.lit(landing.raw_path("acme", "mixpanel", "events", base="s3://raw") + "/run_date="),
                        F.col("day").cast("string"), F.lit("/" + file))

    files = daily.select(path("events.jsonl.gz").alias("path")).unionByName(
        daily.filter("errors <= clicks").select(path("_SUCCESS").alias("path"))).unionByName(
        daily.select(path("").alias("path")))
    return landing.promote_complete_batches(landing.with_layout(files))


def ingest_listing(s: StandIns) -> DataFrame:
    """Batches of one run date, one per event type, found by listing files; those of errors have no marker."""
    base = scratch_path(s.spark, "listed")
    events = s.table("events").select("event_id", "event_type")
    for (kind,) in events.select("event_type").distinct().orderBy("event_type").collect():
        target = landing.raw_path("acme", "mixpanel", kind, "2024-02-20", base=base)
        writer = events.filter(F.col("event_type") == kind).write.option("compression", "gzip")
        writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(kind != "error").lower()).json(target)
    files = landing.with_layout(landing.listing(s.spark, base, client="acme", run_date="2024-02-20"))
    promoted = landing.promote_complete_batches(files).withColumn("is_data", F.col("file").endswith(".json.gz"))
    promoted = promoted.withColumnRenamed("table", "table_name")
    return promoted.groupBy("client", "source", "table_name", "run_date").agg(F.bool_and("is_data").alias("only_data"))


def functions_types(s: StandIns) -> DataFrame:
    """Order columns as text, cast by portable type names; and that now is after every order."""
    names = {"string": "o_orderstatus", "timestamp": "o_orderdate", "float": "o_totalprice", "numeric": "o_totalprice", "bigint": "o_orderkey",
             "int": "o_custkey", "date": "o_orderdate"}
    cast = [F.col(c).cast("string").cast(types.portable_type(kind)).alias(f"as_{kind}") for kind, c in names.items()]
    flag = (F.col("o_orderstatus") == "F").cast("string").cast(types.portable_type("boolean")).alias("as_boolean")
    return s.table("orders").select("o_orderkey", *cast, flag, (dates.utc_now() > F.col("o_orderdate")).alias("is_past"))


def file_names(s: StandIns) -> DataFrame:
    names = relational.union_all(
        s.table("nation").select(F.concat("n_name", F.lit(".jsonl")).alias("file")),
        s.table("region").select(F.concat("r_name", F.lit(".jsonl")).alias("file")),
        s.table("region").select(F.concat(F.lit("sf_"), "r_name", F.lit("_x.jsonl")).alias("file")))
    return landing.with_source_table(names).withColumnRenamed("table", "table_name")


def ingest_catalog(s: StandIns) -> DataFrame:
    """Export one run date as a landing batch, then read it through the tenant's catalog."""
    base = scratch_path(s.spark, "lake")
    refunds = s.refunds.withColumn("created_at", F.col("created_at").cast("string"))
    target = landing.raw_path("acme", "stripe", "refunds", base=base)
    write_jsonl(refunds, target, "2024-02-20")
    again = write_jsonl(refunds.limit(0), target, "2024-02-20")  # exists: left alone
    catalog = Catalog(s.spark, "acme", "dev", base, number_scale=2, pattern="*.json.gz")
    staged = catalog.staged("stripe", "refunds", "2024-02-20")
    return staged.withColumn("database", F.lit(catalog.database)).withColumn("rewritten", F.lit(again))


def ingest_once(s: StandIns) -> DataFrame:
    """File-arrival load in micro-batches of a few files, run twice: the second run finds nothing new."""
    base, target = scratch_path(s.spark, "arrivals"), scratch_path(s.spark, "landed")
    checkpoint = scratch_path(s.spark, "load-history")
    _write_by_type(_event_lines(s), base)
    for _ in range(2):
        ingest.land_files(s.spark, base, target, checkpoint, pattern="*.gz", max_files_per_trigger=16).awaitTermination()
    return staging.stage("mixpanel_events", ingest.landed(s.spark, target)).select(
        _file_of("_source_file").alias("file"), F.col("_row_num").alias("row_num"), "event_id", "event_name", "event_value")


def seed(s: StandIns) -> DataFrame:
    path = scratch_path(s.spark, "seed")
    s.table("customer").select("c_custkey", "c_name", "c_acctbal").write.option("header", "true").csv(path)
    return load_seed(s.spark, path)


def sinks(s: StandIns) -> DataFrame:
    """Write a clustered table, clone it, name it as a view and export a segment; read the export."""
    root = scratch_path(s.spark, "sinks")
    tag = root.rsplit("-", 1)[-1]
    orders = s.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    write_table(orders, f"orders_{tag}", cluster_by=["o_custkey"], path=f"{root}/orders")
    clone = clone_table(s.spark, f"orders_{tag}", f"orders_copy_{tag}", path=f"{root}/copy")
    view = register_view(clone, f"orders_view_{tag}")
    by_path = write_path(view, f"{root}/by_priority", partition_by=["o_orderpriority"])
    export_segment(by_path.filter("o_orderpriority = '1-URGENT'"), f"{root}/segment")
    return s.spark.read.parquet(f"{root}/segment")


AUDITED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
           "pages", "benchmark", "labels", "conversations")


def audit(s: StandIns) -> DataFrame:
    return landing.audit_counts({t: s.table(t) for t in AUDITED})


def fresh(s: StandIns) -> DataFrame:
    now = F.lit(f"{AS_OF} 00:00:00").cast("timestamp_ntz")
    return landing.freshness(s.table("events"), "ts", now, "event_type <> 'error'")


# --- relational forms ------------------------------------------------------------


def select_filter_subquery(s: StandIns) -> DataFrame:
    """Orders above the average price, with several filter forms; the average is one row."""
    orders = s.table("orders")
    average = orders.agg((F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
                          / F.count(F.lit(1))).alias("avg_price"))
    rows = orders.crossJoin(F.broadcast(average)).filter(
        (F.col("o_totalprice") > F.col("avg_price")) & F.col("o_orderstatus").isin("F", "O")
        & ~F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW") & F.col("o_custkey").isNotNull()
        & F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp_ntz"),
                                       F.lit("1999-12-31").cast("timestamp_ntz")))
    return (rows.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
        .filter(F.col("n") > 1).withColumn("label", F.lit("above average")))


def top_n_listing(s: StandIns) -> DataFrame:
    """The hundred largest orders, a report."""
    return s.table("orders").select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc_nulls_first(), F.col("o_orderkey")).limit(100)


def best_per_group(s: StandIns) -> DataFrame:
    """Largest order per customer."""
    return relational.top1(s.table("orders"), ["o_custkey"],
                           [F.col("o_totalprice").desc_nulls_first(), F.col("o_orderkey").asc_nulls_last()])


def totals_over(s: StandIns) -> DataFrame:
    """Share of each customer in the month and in everything."""
    per = s.table("orders").groupBy("o_custkey", dates.trunc_date("month", "o_orderdate").alias("month")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spent"))
    monthly = relational.with_calendar_total(per, "month", "spent", "month_total")
    return relational.with_grand_total(monthly, "spent", "grand_total")


def distinct_over(s: StandIns) -> DataFrame:
    rows = s.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    return relational.with_distinct_over(rows, ["o_custkey"], {
        "priorities": F.col("o_orderpriority"),
        "filled_priorities": F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))})


def joins(s: StandIns) -> DataFrame:
    """Left, inner-in-effect and anti joins on nullable keys."""
    customers = s.table("customer").select(F.col("c_custkey").cast("string").alias("k"), "c_mktsegment", "c_acctbal")
    in_credit = customers.filter("c_acctbal >= 0")
    lines = s.table("lineitem").select(
        _text("l_orderkey").alias("id"), F.when(F.col("l_returnflag") != "N", _text("l_suppkey")).alias("supplier"))
    named = relational.lookup(lines, in_credit.select("k", "c_mktsegment"), "supplier", "k", spread_by="id")
    missing = relational.unmatched(lines, in_credit, "supplier", "k").groupBy("supplier").agg(
        F.count(F.lit(1)).alias("n")).select(F.lit("no credit").alias("segment"), F.col("n"))
    found = named.groupBy(F.coalesce("c_mktsegment", F.lit("none")).alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    matched = relational.attribute(lines, in_credit.select("k", "c_mktsegment"), "supplier", "k").groupBy(
        F.concat(F.lit("inner "), "c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    absent = missing.groupBy("segment").agg(F.sum("n").alias("n"))
    return relational.union_all(found, matched, absent)


def _text(column: str):
    return F.col(column).cast("string")


def set_ops(s: StandIns) -> DataFrame:
    buyers = s.table("orders").select(F.col("o_custkey").alias("k"))
    users = s.table("events").select(F.col("user_id").alias("k"))
    customers = s.table("customer").select(F.col("c_custkey").alias("k"))
    parts = {
        "union_distinct": relational.union_distinct(buyers, users),
        "union_all": relational.union_all(users, customers),
        "except": relational.except_distinct(customers, users),
        "intersect": relational.intersect_distinct(buyers, users),
        "distinct": buyers.distinct(),
    }
    return relational.union_all(*[
        df.agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k_sum")).select(F.lit(name).alias("op"), "n", "k_sum")
        for name, df in parts.items()])


# --- functions -------------------------------------------------------------------


def functions_string(s: StandIns) -> DataFrame:
    name = F.col("p_name")
    return s.table("part").select(
        "p_partkey", keys.surrogate_key("p_partkey", F.when(F.col("p_size") > 10, F.col("p_brand"))).alias("sk"),
        keys.hash_value("p_partkey").alias("h"), keys.scd_hash("p_partkey", F.lit(None)).alias("scd"),
        scalars.split_part(name, " ", 1).alias("first"), scalars.split_part(name, " ", -1).alias("last"),
        scalars.right_text(name, 3).alias("r3"), scalars.right_text(name, 0).alias("r0"),
        scalars.position("r", name).alias("pos"), F.length(name).alias("len"),
        F.replace(name, F.lit(" "), F.lit("_")).alias("snake"), keys.prefixed("P:", "p_brand").alias("prefixed"),
        scalars.bool_to_text(F.col("p_size") > 25).alias("big"), scalars.string_literal("it's").alias("lit"),
        scalars.safe_cast("p_brand", "int").alias("no_int"), scalars.safe_cast(F.lit("12"), "int").alias("an_int"),
        scalars.equals(F.lit(None).cast("string"), F.lit(None).cast("string"), null_safe=True).alias("null_eq"),
        scalars.contains_any_ci(name, ["RING", "bolt"]).alias("has"))


def functions_date(s: StandIns) -> DataFrame:
    day, at = F.col("o_orderdate").cast("date"), dates.date_lit(AS_OF)
    cols = {"o_orderkey": F.col("o_orderkey"), "made": dates.make_date(F.year(day), F.month(day), F.lit(1)),
            "plus_days": dates.add_days(day, 40), "no_date": dates.try_date(F.col("o_orderpriority"))}
    for part in ("day", "week", "month", "quarter", "year"):
        cols[f"diff_{part}"] = dates.date_diff(part, day, at)
        cols[f"add_{part}"] = dates.date_add_part(part, 3, day)
        cols[f"trunc_{part}"] = dates.trunc_date(part, day)
        if part != "day":
            cols[f"last_{part}"] = dates.last_day_of(part, day)
    for part in _clock_parts:
        cols[f"diff_{part}"] = dates.date_diff(part, "o_orderdate", F.lit(dt.datetime(2024, 2, 20, 1, 30, 15)))
        cols[f"add_{part}"] = dates.date_add_part(part, 100, "o_orderdate")
    return s.table("orders").select(*[c.alias(n) for n, c in cols.items()])


def functions_null_rules(s: StandIns) -> DataFrame:
    """Null-strict least and greatest, clamp, guarded ratio, rounding and weighted mean parts."""
    line = F.when(F.col("l_linenumber") < 7, F.col("l_linenumber"))
    qty = F.col("l_quantity").cast("int")
    return s.table("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        scalars.least_or_null(line, qty).alias("lo"), scalars.greatest_or_null(line, qty).alias("hi"),
        scalars.clamp(qty, 10, 40).alias("clamped"), scalars.ratio(qty, line - 1).alias("guarded"),
        scalars.zero_if_null(line).alias("filled"), scalars.flag(line > 3).alias("flagged"),
        scalars.is_true(line > 3).alias("truth"), F.nullif(line, F.lit(1)).alias("not_one"))


def functions_array(s: StandIns) -> DataFrame:
    base = scalars.array_of("n_nationkey", "n_regionkey")
    grown = scalars.array_with(base, F.lit(7))
    both = scalars.array_join_up(grown, scalars.array_of(F.lit(1), F.lit(2)))
    return s.table("nation").select("n_nationkey", F.array_join(both, ",").alias("joined"), F.size(both).alias("n"))


def functions_agg(s: StandIns) -> DataFrame:
    rows = s.table("customer").join(s.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    balance = F.col("c_acctbal").cast("decimal(18,2)")
    weight = F.length("c_mktsegment").cast("decimal(10,0)")
    per_nation = rows.groupBy("n_name", "n_regionkey").agg(
        aggregates.bool_or(F.col("c_acctbal") < 0).alias("any_debit"),
        aggregates.weighted_avg(weight, balance).alias("weighted"), aggregates.mean_of(balance).alias("mean"),
        aggregates.sum_where(F.col("c_acctbal") < 0, balance).alias("debit"),
        aggregates.count_distinct_where(F.col("c_acctbal") < 0, "c_mktsegment").alias("debit_segments"))
    last_names = relational.first_values(per_nation, ["n_regionkey"], "n_name", 3, "last_names", "|", [F.desc("n_name")])
    return last_names.join(per_nation.groupBy("n_regionkey").agg(
        aggregates.list_agg("n_name").alias("names"),
        aggregates.list_agg("n_name", order_by=F.length("n_name")).alias("by_length"),
        aggregates.any_value(F.col("n_regionkey") * 2).alias("twice"),
        aggregates.bool_or("any_debit").alias("any_debit"), F.sum(F.round("weighted", 6)).alias("weighted"),
        F.sum(F.round("mean", 6)).alias("mean"), F.sum("debit").alias("debit"),
        F.sum("debit_segments").alias("debit_segments")), "n_regionkey")


def series_and_spines(s: StandIns) -> DataFrame:
    """Daily order counts on a dense spine from the first to the last day of the orders."""
    day = F.col("o_orderdate").cast("date")
    first, last = s.table("orders").agg(F.min(day), F.max(day)).first()
    spine = dates.date_spine(s.spark, "day", first, last + dt.timedelta(days=1))
    months = dates.date_spine(s.spark, "month", first.replace(day=1), dates.add_months_py(last.replace(day=1), 1))
    daily = s.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("date_day")).agg(
        F.count(F.lit(1)).alias("n"))
    dense = spine.join(daily, "date_day", "left").select(
        dates.trunc_date("month", "date_day").alias("date_month"), F.coalesce("n", F.lit(0)).alias("n"))
    numbered = dates.number_series(s.spark, 12)
    quarter = numbered.agg(F.max("generated_number").alias("largest"))
    return months.join(dense.groupBy("date_month").agg(F.sum("n").alias("orders"), F.count(F.lit(1)).alias("days")),
                       "date_month", "left").crossJoin(F.broadcast(quarter))


def partition_dates(s: StandIns) -> DataFrame:
    """Events per partition date of a formatted range."""
    wanted = dates.partition_range(s.spark, "20240105,20240125")
    daily = s.table("events").groupBy(F.date_format("ts", "yyyyMMdd").alias("partition_date")).agg(
        F.count(F.lit(1)).alias("n"))
    return wanted.join(daily, "partition_date", "left")


def sql_udf(s: StandIns) -> DataFrame:
    sqludf.register_sql_function(s.spark, "ledgerloom_net", {"price": "DOUBLE", "discount": "DOUBLE"}, "DOUBLE",
                                 "round(price * (1 - discount), 4)")
    return s.table("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.call_function("ledgerloom_net", "l_extendedprice", "l_discount").alias("net"))


def python_model(s: StandIns) -> DataFrame:
    """Two registered models, the second built on the first."""
    dag = Dag(s.spark, {"orders": s.table("orders")}, {"status": "F"})
    sqludf.set_query_tag(s.spark, "acme", "dev", "spend", "run-1")

    @dag.model()
    def filled(d: Dag, spark: SparkSession) -> DataFrame:
        return d.source("orders").filter(F.col("o_orderstatus") == d.config["status"])

    @dag.model("spend")
    def per_customer(d: Dag, spark: SparkSession) -> DataFrame:
        return d.ref("filled").groupBy("o_custkey").agg(
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spent"))

    return dag.ref("spend")


# --- increments ------------------------------------------------------------------


def accounts_now(s: StandIns) -> DataFrame:
    return s.table("customer").select(_cid().alias("id"), F.col("c_name").alias("name"),
                                      F.col("c_acctbal").alias("balance"))


def _cid():
    return F.concat(F.lit("C"), F.col("c_custkey").cast("string"))


def accounts_delta(s: StandIns) -> DataFrame:
    """Changed balances of two segments and the suppliers as new accounts."""
    changed = s.table("customer").filter(F.col("c_mktsegment").isin("BUILDING", "FURNITURE")).select(
        _cid().alias("id"), F.upper("c_name").alias("name"), (F.col("c_acctbal") + 1).alias("balance"))
    new = s.table("supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"),
                                     F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return changed.unionByName(new)


def event_rows(s: StandIns) -> DataFrame:
    return s.table("events").select("event_id", "user_id", "event_type", "ts", "value")


def purchases_doubled(s: StandIns) -> DataFrame:
    return event_rows(s).filter("event_type = 'purchase'").withColumn("value", F.col("value") * 2)


def microbatch(s: StandIns) -> DataFrame:
    window = purchases_doubled(s).filter("ts >= timestamp_ntz'2024-01-10' and ts < timestamp_ntz'2024-01-20'")
    return incremental.microbatch(event_rows(s), window, "ts", "2024-01-10", "2024-01-20")


def schema_sync(s: StandIns) -> DataFrame:
    """Append under a policy that adds the source's new column to the target."""
    source = accounts_delta(s).withColumn("region", F.lit("EU"))
    src, dst = incremental.reconcile_schema(source, accounts_now(s), "append_new_columns")
    return incremental.append(dst, src)


def schema_retype(s: StandIns) -> DataFrame:
    """Upsert under a policy that drops, adds and retypes the target's columns."""
    source = accounts_delta(s).select("id", F.col("balance").cast("decimal(18,2)").alias("balance"),
                                      F.lit("EU").alias("region"))
    src, dst = incremental.reconcile_schema(source, accounts_now(s), "sync_all_columns")
    return incremental.merge_upsert(dst, src, "id")


def incremental_runs(s: StandIns) -> DataFrame:
    """First build, then two equal upserts, which rewrite the buckets of their keys."""
    path = scratch_path(s.spark, "accounts")

    def build(is_increment: bool) -> DataFrame:
        return accounts_delta(s) if is_increment else accounts_now(s)

    for _ in range(3):
        result = incremental.run_incremental(
            s.spark, path, build, lambda current, source: incremental.merge_upsert(current, source, "id"), keys="id")
    return result


# --- snapshots -------------------------------------------------------------------

FIRST, SECOND, THIRD = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def first_state(s: StandIns) -> DataFrame:
    return s.table("customer").select(_cid().alias("id"), F.col("c_mktsegment").alias("segment"),
                                      F.col("c_acctbal").alias("balance"),
                                      F.lit(FIRST).cast("timestamp_ntz").alias("updated_at"))


def second_state(s: StandIns) -> DataFrame:
    """One segment gone, one changed, the suppliers new."""
    changed = F.col("c_mktsegment") == "BUILDING"
    kept = s.table("customer").filter(F.col("c_mktsegment") != "HOUSEHOLD").select(
        _cid().alias("id"), F.col("c_mktsegment").alias("segment"),
        F.when(changed, F.col("c_acctbal") * 2).otherwise(F.col("c_acctbal")).alias("balance"),
        F.when(changed, F.lit(SECOND)).otherwise(F.lit(FIRST)).cast("timestamp_ntz").alias("updated_at"))
    new = s.table("supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"), F.lit("SUPPLIER").alias("segment"),
        F.col("s_acctbal").alias("balance"), F.lit(SECOND).cast("timestamp_ntz").alias("updated_at"))
    return kept.unionByName(new)


def scd2(hard_deletes: str = "ignore", strategy: str = "timestamp",
         runs: int = 1) -> Callable[[StandIns], DataFrame]:
    def run(s: StandIns) -> DataFrame:
        by_check = strategy == "check"
        spec = snapshots.Snapshot("id", strategy=strategy, updated_at=None if by_check else "updated_at",
                                  check_cols=("segment", "balance"), hard_deletes=hard_deletes, now=THIRD)
        first = snapshots.Snapshot("id", strategy=strategy, updated_at=None if by_check else "updated_at",
                                   check_cols=("segment", "balance"), hard_deletes=hard_deletes, now=FIRST)
        state = snapshots.snapshot_init(first_state(s), first)
        for _ in range(runs):
            state = snapshots.snapshot_apply(state, second_state(s), spec)
        return state

    return run


def scd2_history(s: StandIns) -> DataFrame:
    """A third run brings deleted keys back unchanged: their closed versions have the hash, so none is added."""
    def spec(now: str) -> snapshots.Snapshot:
        return snapshots.Snapshot("id", updated_at="updated_at", hard_deletes="invalidate", now=now, match_history=True)

    state = snapshots.snapshot_init(first_state(s), spec(FIRST))
    for now, source in ((THIRD, second_state(s)), (FOURTH, first_state(s))):
        state = snapshots.snapshot_apply(state, source, spec(now))
    return state


FOURTH = "2024-04-01 00:00:00"
_T = "TIMESTAMP"
S1 = f"SELECT 'C' || c_custkey AS id, c_mktsegment AS segment, c_acctbal AS balance, {_T} '{FIRST}' AS updated_at FROM customer"
S2 = (f"SELECT 'C' || c_custkey AS id, c_mktsegment AS segment, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal * 2 "
      f"ELSE c_acctbal END AS balance, CASE WHEN c_mktsegment = 'BUILDING' THEN {_T} '{SECOND}' ELSE {_T} '{FIRST}' END "
      f"AS updated_at FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' UNION ALL SELECT 'S' || s_suppkey, 'SUPPLIER', "
      f"s_acctbal, {_T} '{SECOND}' FROM supplier")
SCD = ("id:s segment:s balance:f4 updated_at:t dbt_scd_id:s dbt_updated_at:t dbt_valid_from:t dbt_valid_to:t")


def scd_sql(hard_deletes: str, by_check: bool) -> str:
    """Versions after one run, as a union of what happens to each key."""
    first_at = f"{_T} '{FIRST}'" if by_check else "a.updated_at"
    now = f"{_T} '{THIRD}'"
    new_at = now if by_check else "b.updated_at"
    changed = ("(a.segment IS DISTINCT FROM b.segment OR a.balance IS DISTINCT FROM b.balance)" if by_check
               else f"{first_at} < b.updated_at")
    flag = ", 'False' AS dbt_is_deleted" if hard_deletes == "new_record" else ""
    gone = ", 'True' AS dbt_is_deleted" if hard_deletes == "new_record" else ""
    old_hash = oracle.scd("a.id", first_at)
    end_deleted = "NULL" if hard_deletes == "ignore" else now
    valid_to = f"CASE WHEN b.id IS NULL THEN {end_deleted} WHEN {changed} THEN {new_at} END"
    parts = [
        f"SELECT a.*, {old_hash} AS dbt_scd_id, {first_at} AS dbt_updated_at, {first_at} AS dbt_valid_from, "
        f"CAST({valid_to} AS TIMESTAMP) AS dbt_valid_to{flag} FROM ({S1}) a LEFT JOIN ({S2}) b ON a.id = b.id",
        f"SELECT b.*, {oracle.scd('b.id', new_at)}, {new_at}, {new_at}, CAST(NULL AS TIMESTAMP){flag} FROM ({S2}) b "
        f"LEFT JOIN ({S1}) a ON a.id = b.id WHERE a.id IS NULL OR {changed}"]
    if hard_deletes == "new_record":
        parts.append(f"SELECT a.*, {oracle.scd(old_hash, now)}, {now}, {now}, CAST(NULL AS TIMESTAMP){gone} FROM ({S1}) a "
                     f"LEFT JOIN ({S2}) b ON a.id = b.id WHERE b.id IS NULL")
    return " UNION ALL ".join(parts)


def scd_history_sql() -> str:
    """Every version ever made and when it ended: replaced, gone in the second state, or gone in the third."""
    stays = f"SELECT *, updated_at AS made, CASE c WHEN 'BUILDING' THEN {_T} '{SECOND}' WHEN 'HOUSEHOLD' THEN {_T} '{THIRD}' END AS upto FROM (SELECT *, segment AS c FROM ({S1}))"
    later = f"SELECT *, '' AS c, updated_at AS made, CASE segment WHEN 'SUPPLIER' THEN {_T} '{FOURTH}' END AS upto FROM ({S2}) WHERE updated_at = {_T} '{SECOND}'"
    return (f"SELECT id, segment, balance, updated_at, {oracle.scd('id', 'updated_at')} AS dbt_scd_id, made AS dbt_updated_at, made AS dbt_valid_from, "
            f"CAST(upto AS TIMESTAMP) AS dbt_valid_to FROM (SELECT * FROM ({stays}) UNION ALL BY NAME SELECT * FROM ({later}))")


# --- checks ----------------------------------------------------------------------


def line_keys(s: StandIns) -> DataFrame:
    return s.table("lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key"),
                                      "l_returnflag", "l_linestatus", F.col("l_suppkey").alias("supplier"))


SUITE = [
    quality.Check("lines", "line_key", "unique"),
    quality.Check("lines", "line_key", "unique", where="l_returnflag = 'R'", error_if="> 1000000"),
    quality.Check("lines", "l_returnflag", "accepted_values", values=("A", "N")),
    quality.Check("lines", "supplier", "not_null"),
    quality.Check("lines", "line_key", "not_null"),
    quality.Check("orders", "o_custkey", "relationships", to="credit", field="c_custkey", warn_if="> 10"),
    quality.Check("users", "company_id", "not_null", where="event_name <> 'error'"),
    quality.Check("users", "company_id", "not_null"),
]


def dq_suite(s: StandIns) -> DataFrame:
    return quality.run_suite(SUITE, {
        "lines": line_keys(s), "orders": s.table("orders"),
        "credit": s.table("customer").filter("c_acctbal >= 0"), "users": s.product_events})


def _suite_sql() -> str:
    line = "SELECT CONCAT_WS('-', l_orderkey, l_linenumber) AS k, l_returnflag AS f FROM lineitem"
    counts = [
        ("lines", "line_key", "unique", f"SELECT k FROM ({line}) GROUP BY k HAVING COUNT(*) > 1", "<> 0", "<> 0"),
        ("lines", "line_key", "unique", f"SELECT k FROM ({line}) WHERE f = 'R' GROUP BY k HAVING COUNT(*) > 1",
         "<> 0", "> 1000000"),
        ("lines", "l_returnflag", "accepted_values",
         "SELECT l_returnflag FROM lineitem GROUP BY 1 HAVING l_returnflag NOT IN ('A', 'N')", "<> 0", "<> 0"),
        ("lines", "supplier", "not_null", "SELECT 1 FROM lineitem WHERE l_suppkey IS NULL", "<> 0", "<> 0"),
        ("lines", "line_key", "not_null", f"SELECT 1 FROM ({line}) WHERE k IS NULL", "<> 0", "<> 0"),
        ("orders", "o_custkey", "relationships",
         "SELECT 1 FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey "
         "WHERE c_custkey IS NULL AND o_custkey IS NOT NULL", "> 10", "<> 0"),
        ("users", "company_id", "not_null",
         "SELECT 1 FROM product_events WHERE event_name <> 'error' AND company_id IS NULL", "<> 0", "<> 0"),
        ("users", "company_id", "not_null", "SELECT 1 FROM product_events WHERE company_id IS NULL", "<> 0", "<> 0"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{c}' AS col, '{k}' AS kind, COUNT(*) AS failures, COUNT(*) {w} AS should_warn, "
        f"COUNT(*) {e} AS should_error FROM ({q})" for m, c, k, q, w, e in counts)


def assert_same(s: StandIns) -> DataFrame:
    """Two equal aggregations by different routes: no differing rows; a changed one: both sides shown."""
    a = s.table("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    b = s.table("orders").select("o_orderstatus", F.lit(1).alias("one")).groupBy("o_orderstatus").agg(
        F.sum("one").alias("n"))
    changed = b.withColumn("n", F.when(F.col("o_orderstatus") == "F", F.col("n") + 1).otherwise(F.col("n")))
    same = quality.diff_rows(a, b).withColumn("route", F.lit("same"))
    return same.unionByName(quality.diff_rows(a, changed).withColumn("route", F.lit("changed")))


def contract(s: StandIns) -> DataFrame:
    """Orders through their declared schema, in declared order."""
    orders = s.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    declared = orders.select("o_orderstatus", "o_orderkey", "o_custkey").schema
    return quality.check_contract(orders, declared)


# --- streams ---------------------------------------------------------------------

EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")


def event_stream(s: StandIns) -> DataFrame:
    return s.spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(s.sf_dir)


def _stream_events(s: StandIns) -> DataFrame:
    return event_stream(s).select(
        F.concat(F.lit("SF_"), F.col("user_id").cast("string")).alias("master_customer_id"), "event_id",
        F.col("event_type").alias("event_name"), F.col("user_id").cast("string").alias("user_identifier"),
        F.col("ts").cast("timestamp").alias("timestamp"))


def stream_daily_totals(s: StandIns) -> DataFrame:
    path, checkpoint = scratch_path(s.spark, "daily"), scratch_path(s.spark, "daily-state")
    totals.keep_state_on_disk(s.spark)
    parts = totals.stream_user_days(_stream_events(s), "60 days")
    query = refresh.maintain(parts, path, checkpoint, totals.PART_KEYS, lambda current, rows: incremental.merge_upsert(
        current, rows, totals.PART_KEYS), output_mode="update")
    query.awaitTermination()
    return totals.totals_of(partitions.read_table(s.spark, path))


def _event_batches(s: StandIns, columns: list[str]) -> DataFrame:
    """The events as a stream of several micro-batches, one per file, so that users and days span batches."""
    folder = scratch_path(s.spark, "event-files")
    files = s.table("events").select(*columns).repartition(4, "event_id")
    files.write.parquet(folder)
    return s.spark.readStream.schema(files.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def stream_maintain(s: StandIns) -> DataFrame:
    """A per-user table to which micro-batches of new events add."""
    path, checkpoint = scratch_path(s.spark, "per-user"), scratch_path(s.spark, "per-user-state")
    events = _event_batches(s, ["event_id", "user_id", "value"])

    def per_user(rows: DataFrame) -> DataFrame:
        return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"),
                                           F.sum(F.col("value").cast("decimal(18,2)")).alias("value"))

    for _ in range(2):  # the second run has no new input
        refresh.maintain(events, path, checkpoint, ["user_id"], lambda current, rows: incremental.merge_add(current, rows, ["user_id"]),
                         per_user).awaitTermination()
    return partitions.read_table(s.spark, path)


def stream_microbatch(s: StandIns) -> DataFrame:
    """Days that come in several batches, and all of it twice; every tenth event has no id."""
    path = scratch_path(s.spark, "days")
    events = _event_batches(s, ["event_id", "ts", "value"]).withColumn("event_id", F.when(F.col("event_id") % 10 != 0, F.col("event_id")))
    for _ in range(2):
        refresh.replace_days(events, path, scratch_path(s.spark, "days-state"), "ts", ["event_id"]).awaitTermination()
    return s.spark.read.parquet(path)


# --- registry --------------------------------------------------------------------

EVENTS = "event_id:s event_name:s event_value:f0"
ACCOUNT = "id:s name:s balance:f4"
EVENT = "event_id:i user_id:i event_type:s ts:t value:f4"
DELTA = ("(SELECT 'C' || c_custkey AS id, UPPER(c_name) AS name, c_acctbal + 1 AS balance FROM customer WHERE "
         "c_mktsegment IN ('BUILDING', 'FURNITURE') UNION ALL SELECT 'S' || s_suppkey, s_name, s_acctbal FROM supplier)")
NOW = "(SELECT 'C' || c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer)"
UPSERTED = (f"SELECT t.id, COALESCE(d.name, t.name) AS name, COALESCE(d.balance, t.balance) AS balance FROM {NOW} t LEFT "
            f"JOIN {DELTA} d ON t.id = d.id UNION ALL SELECT d.* FROM {DELTA} d WHERE d.id NOT IN (SELECT id FROM {NOW})")
NUMBERED = (f"(SELECT *, event_type || '/' || event_id % {FILES} AS file, ROW_NUMBER() OVER (PARTITION BY event_type, event_id % {FILES} "
            f"ORDER BY event_id) AS rn, (event_type = 'error' AND value > 100 AND event_id % {FILES} < {FILES // 2}) AS bad FROM events)")
LOADED = (f"SELECT file, rn AS row_num, event_id, event_type AS event_name, ROUND(CAST(value AS DECIMAL(18,2))) AS event_value FROM {NUMBERED} "
          "QUALIFY NOT BOOL_OR(bad) OVER (PARTITION BY file)")
_date_parts = ("day", "week", "month", "quarter", "year")
_clock_parts = ("hour", "minute", "second")


def _functions_date_sql() -> str:
    d, at = "CAST(o_orderdate AS DATE)", oracle.AS_OF
    cols = ["o_orderkey", f"MAKE_DATE(YEAR({d}), MONTH({d}), 1) AS made", f"{d} + 40 AS plus_days",
            "NULL AS no_date"]
    interval = {"day": "3 DAY", "week": "21 DAY", "month": "3 MONTH", "quarter": "9 MONTH", "year": "3 YEAR"}
    for p in _date_parts:
        # Weeks start on Monday; the engine's own week difference counts from the epoch's weekday.
        diff = (f"DATE_DIFF('day', DATE_TRUNC('week', {d}), DATE_TRUNC('week', {at})) // 7" if p == "week"
                else f"DATE_DIFF('{p}', {d}, {at})")
        cols += [f"{diff} AS diff_{p}",
                 f"CAST({d} + INTERVAL {interval[p]} AS DATE) AS add_{p}",
                 f"CAST(DATE_TRUNC('{p}', {d}) AS DATE) AS trunc_{p}"]
        if p != "day":
            step = {"week": "7 DAY", "month": "1 MONTH", "quarter": "3 MONTH", "year": "1 YEAR"}[p]
            cols.append(f"CAST(DATE_TRUNC('{p}', {d}) + INTERVAL {step} - INTERVAL 1 DAY AS DATE) AS last_{p}")
    for p in _clock_parts:
        cols += [f"DATE_DIFF('{p}', CAST(o_orderdate AS TIMESTAMP), TIMESTAMP '2024-02-20 01:30:15') AS diff_{p}",
                 f"CAST(o_orderdate AS TIMESTAMP) + INTERVAL 100 {p} AS add_{p}"]
    return f"SELECT {', '.join(cols)} FROM orders"


_DATE_SPEC = "o_orderkey:i made:d plus_days:d no_date:d " + " ".join(
    f"diff_{p}:i add_{p}:d trunc_{p}:d" + ("" if p == "day" else f" last_{p}:d") for p in _date_parts)
_DATE_SPEC += "".join(f" diff_{p}:i add_{p}:t" for p in _clock_parts)

DATA_QUERIES: dict[str, Query] = {
    **{f"stg_{t}": stage_query(t) for t in STAGING},
    "stg_events_variant": paired(
        stg_events_variant, "SELECT event_id, ROUND(CAST(value AS DECIMAL(18,2))) AS value_whole, value AS value_pence, "
        "CAST(REGEXP_EXTRACT(props, '[0-9]+') AS INTEGER) AS k, ts AS seen_at, NULL AS no_date FROM events",
        "event_id:i value_whole:f0 value_pence:f2 k:i seen_at:t no_date:d"),
    "stg_lost_values": paired(stg_lost_values, "SELECT 0 AS event_id, COUNT(*) AS event_value FROM events WHERE "
                              "event_type = 'error'", "event_id:i event_value:i"),
    "ingest_jsonl": paired(ingest_jsonl, LOADED, f"file:s row_num:i {EVENTS}"),
    "ingest_validate": paired(
        ingest_validate, f"SELECT file, NOT BOOL_OR(bad) AS is_valid, MIN(CASE WHEN bad THEN rn END) "
        f"AS first_bad_line, COALESCE(MIN(CASE WHEN bad THEN rn END) - 1, COUNT(*)) AS n_records FROM {NUMBERED} "
        "GROUP BY 1", "file:s is_valid:b first_bad_line:f0 n_records:i"),
    "ingest_gate": paired(
        ingest_gate, "SELECT 'acme' AS client, 'mixpanel' AS source, 'events' AS \"table\", STRFTIME(day, '%Y-%m-%d') AS "
        "run_date, 'events.jsonl.gz' AS file FROM (SELECT CAST(ts AS DATE) AS day, COUNT(*) FILTER (event_type = "
        "'error') AS e, COUNT(*) FILTER (event_type = 'click') AS c FROM events GROUP BY 1) WHERE e <= c",
        "client:s source:s run_date:s file:s"),
    "ingest_listing": paired(
        ingest_listing, "SELECT DISTINCT 'acme' AS client, 'mixpanel' AS source, event_type AS table_name, '2024-02-20' AS run_date, TRUE AS "
        "only_data FROM events WHERE event_type <> 'error'", "client:s source:s table_name:s run_date:s only_data:b"),
    "functions_types": paired(
        functions_types, "SELECT o_orderkey, o_orderstatus AS as_string, o_orderdate AS as_timestamp, o_totalprice AS as_float, o_totalprice AS "
        "as_numeric, o_orderkey AS as_bigint, o_custkey AS as_int, o_orderdate AS as_date, o_orderstatus = 'F' AS as_boolean, TRUE AS is_past FROM "
        "orders", "o_orderkey:i as_string:s as_timestamp:t as_float:f4 as_numeric:f4 as_bigint:i as_int:i as_date:d as_boolean:b is_past:b"),
    "ingest_source_table": paired(
        file_names, "SELECT file, CASE WHEN p > 0 THEN CASE LEFT(stem, p - 1) WHEN 'sf' THEN 'salesforce' ELSE LEFT(stem, p "
        "- 1) END END AS source, CASE WHEN p > 0 THEN SUBSTR(stem, p + 1) END AS table_name FROM (SELECT file, "
        "REPLACE(file, '.jsonl', '') AS stem, POSITION('_' IN REPLACE(file, '.jsonl', '')) AS p FROM (SELECT n_name || "
        "'.jsonl' AS file FROM nation UNION ALL SELECT r_name || '.jsonl' FROM region UNION ALL SELECT 'sf_' || r_name "
        "|| '_x.jsonl' FROM region))", "file:s source:s table_name:s"),
    "ingest_catalog": paired(
        ingest_catalog, "SELECT refund_id, charge_id, created_at, amount_gbp, reason, 'ACME_DEV_RAW' AS database, FALSE AS "
        "rewritten FROM refunds", "refund_id:s charge_id:s created_at:t amount_gbp:f2 reason:s database:s rewritten:b"),
    "ingest_once": paired(ingest_once, LOADED, f"file:s row_num:i {EVENTS}"),
    "seed": paired(seed, "SELECT c_custkey, c_name, c_acctbal FROM customer", "c_custkey:i c_name:s c_acctbal:f2"),
    "sinks": paired(sinks, "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'",
                    "o_orderkey:i o_custkey:i o_orderpriority:s"),
    "audit_counts": paired(
        audit, " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in AUDITED),
        "table_name:s row_count:i"),
    "freshness": paired(
        fresh, f"SELECT MAX(ts) AS max_loaded_at, CAST({oracle.AS_OF} AS TIMESTAMP) AS snapshotted_at, CAST(FLOOR(EPOCH("
        f"CAST({oracle.AS_OF} AS TIMESTAMP)) - EPOCH(MAX(ts))) AS BIGINT) AS age_seconds FROM events WHERE event_type <> "
        "'error'", "max_loaded_at:t snapshotted_at:t age_seconds:i"),
    "select_filter_subquery": paired(
        select_filter_subquery, "SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n, SUM(CAST(o_totalprice AS "
        "DECIMAL(18,2))) AS total, 'above average' AS label FROM orders WHERE o_totalprice > (SELECT "
        "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) FROM orders) AND o_orderstatus IN ('F', 'O') "
        "AND o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') AND o_custkey IS NOT NULL AND o_orderdate BETWEEN "
        "TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31' GROUP BY 1, 2 HAVING COUNT(*) > 1",
        "o_orderpriority:s o_orderstatus:s n:i total:f2 label:s"),
    "top_n_listing": paired(top_n_listing, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS "
                            "FIRST, o_orderkey LIMIT 100", "o_orderkey:i o_totalprice:f2"),
    "best_per_group": paired(
        best_per_group, "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY "
        "o_custkey ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey) = 1", "o_custkey:i o_orderkey:i o_totalprice:f2"),
    "totals_over": paired(
        totals_over, "SELECT *, SUM(spent) OVER (PARTITION BY month) AS month_total, SUM(spent) OVER () AS grand_total FROM "
        "(SELECT o_custkey, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month, SUM(CAST(o_totalprice AS "
        "DECIMAL(18,2))) AS spent FROM orders GROUP BY 1, 2)",
        "o_custkey:i month:d spent:f2 month_total:f2 grand_total:f2"),
    "distinct_over": paired(
        distinct_over, "SELECT o_orderkey, COUNT(DISTINCT o_orderpriority) OVER (PARTITION BY o_custkey) AS priorities, "
        "COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) OVER (PARTITION BY o_custkey) AS "
        "filled_priorities FROM orders", "o_orderkey:i priorities:i filled_priorities:i"),
    "joins": paired(
        joins, "SELECT COALESCE(c_mktsegment, 'none') AS segment, COUNT(*) AS n FROM lineitem LEFT JOIN customer ON "
        "l_suppkey = c_custkey AND l_returnflag <> 'N' AND c_acctbal >= 0 GROUP BY 1 UNION ALL SELECT 'inner ' || "
        "c_mktsegment, COUNT(*) FROM lineitem JOIN customer ON l_suppkey = c_custkey WHERE l_returnflag <> 'N' AND "
        "c_acctbal >= 0 GROUP BY 1 UNION ALL SELECT 'no credit', COUNT(*) FROM lineitem l WHERE l_returnflag <> 'N' AND NOT "
        "EXISTS (SELECT 1 FROM customer WHERE c_custkey = l.l_suppkey AND c_acctbal >= 0)", "segment:s n:i"),
    "set_ops": paired(
        set_ops, " UNION ALL ".join(f"SELECT '{op}' AS op, COUNT(*) AS n, SUM(k) AS k_sum FROM ({q})" for op, q in {
            "union_distinct": "SELECT o_custkey AS k FROM orders UNION SELECT user_id FROM events",
            "union_all": "SELECT user_id AS k FROM events UNION ALL SELECT c_custkey FROM customer",
            "except": "SELECT c_custkey AS k FROM customer EXCEPT SELECT user_id FROM events",
            "intersect": "SELECT o_custkey AS k FROM orders INTERSECT SELECT user_id FROM events",
            "distinct": "SELECT DISTINCT o_custkey AS k FROM orders"}.items()), "op:s n:i k_sum:i"),
    "functions_string": paired(
        functions_string, f"SELECT p_partkey, {oracle.key('p_partkey', 'CASE WHEN p_size > 10 THEN p_brand END')} AS sk, "
        f"MD5(CAST(p_partkey AS VARCHAR)) AS h, MD5(CAST(p_partkey AS VARCHAR) || '|') AS scd, SPLIT_PART(p_name, ' ', 1) "
        "AS first, SPLIT_PART(p_name, ' ', -1) AS last, RIGHT(p_name, 3) AS r3, '' AS r0, POSITION('r' IN p_name) AS pos, "
        "LENGTH(p_name) AS len, REPLACE(p_name, ' ', '_') AS snake, 'P:' || p_brand AS prefixed, CAST(p_size > 25 AS "
        "VARCHAR) AS big, 'it''s' AS lit, TRY_CAST(p_brand AS INTEGER) AS no_int, 12 AS an_int, TRUE AS null_eq, (p_name "
        "ILIKE '%ring%' OR p_name ILIKE '%bolt%') AS has FROM part",
        "p_partkey:i sk:s h:s scd:s first:s last:s r3:s r0:s pos:i len:i snake:s prefixed:s big:s lit:s no_int:f0 an_int:i "
        "null_eq:b has:b"),
    "functions_date": paired(functions_date, _functions_date_sql(), _DATE_SPEC),
    "functions_null_rules": paired(
        functions_null_rules, "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN n IS NOT NULL THEN LEAST(n, "
        "q) END AS lo, CASE WHEN n IS NOT NULL THEN GREATEST(n, q) END AS hi, LEAST(40, GREATEST(10, q)) AS clamped, CASE "
        "WHEN n <> 1 THEN CAST(q AS DOUBLE) / (n - 1) END AS guarded, COALESCE(n, 0) AS filled, CASE WHEN n > 3 THEN 1 ELSE "
        "0 END AS flagged, COALESCE(n > 3, FALSE) AS truth, NULLIF(n, 1) AS not_one FROM (SELECT *, CASE WHEN l_linenumber "
        "< 7 THEN l_linenumber END AS n, CAST(l_quantity AS INTEGER) AS q FROM lineitem)",
        "l_orderkey:i l_partkey:i l_suppkey:i l_linenumber:i lo:f0 hi:f0 clamped:i guarded:f6 filled:i flagged:i truth:b "
        "not_one:f0"),
    "functions_array": paired(
        functions_array, "SELECT n_nationkey, CONCAT_WS(',', n_nationkey, n_regionkey, 7, 1, 2) AS joined, 5 AS n FROM "
        "nation", "n_nationkey:i joined:s n:i"),
    "functions_agg": paired(
        functions_agg, "SELECT n_regionkey, STRING_AGG(n_name, ',' ORDER BY n_name) AS names, "
        "ARRAY_TO_STRING((LIST(n_name ORDER BY n_name DESC))[1:3], '|') AS last_names, "
        "STRING_AGG(n_name, ',' ORDER BY LENGTH(n_name), n_name) AS by_length, n_regionkey * 2 AS twice, "
        "BOOL_OR(any_debit) AS any_debit, SUM(ROUND(weighted, 6)) AS weighted, SUM(ROUND(mean, 6)) AS mean, SUM(debit) AS "
        "debit, SUM(segs) AS debit_segments FROM (SELECT n_name, n_regionkey, BOOL_OR(c_acctbal < 0) AS any_debit, "
        "CAST(SUM(LENGTH(c_mktsegment) * CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / SUM(LENGTH(c_mktsegment)) AS "
        "weighted, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS mean, SUM(CASE WHEN c_acctbal < 0 "
        "THEN CAST(c_acctbal AS DECIMAL(18,2)) ELSE 0 END) AS debit, COUNT(DISTINCT CASE WHEN c_acctbal < 0 THEN "
        "c_mktsegment END) AS segs FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2) GROUP BY 1",
        "n_regionkey:i names:s last_names:s by_length:s twice:i any_debit:b weighted:f4 mean:f4 debit:f2 debit_segments:i"),
    "series_and_spines": paired(
        series_and_spines, "SELECT CAST(DATE_TRUNC('month', d) AS DATE) AS date_month, SUM(COALESCE(n, 0)) AS orders, "
        "COUNT(*) AS days, 12 AS largest FROM (SELECT CAST(UNNEST(RANGE(a, z + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS "
        "DATE) AS d FROM (SELECT MIN(CAST(o_orderdate AS DATE)) AS a, MAX(CAST(o_orderdate AS DATE)) AS z FROM orders)) LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n FROM orders GROUP BY 1) ON d "
        "= day GROUP BY 1", "date_month:d orders:i days:i largest:i"),
    "partition_dates": paired(
        partition_dates, "SELECT STRFTIME(d, '%Y%m%d') AS partition_date, n FROM (SELECT CAST(UNNEST(RANGE(DATE "
        "'2024-01-05', DATE '2024-01-26', INTERVAL 1 DAY)) AS DATE) AS d) LEFT JOIN (SELECT CAST(ts AS DATE) AS day, "
        "COUNT(*) AS n FROM events GROUP BY 1) ON d = day", "partition_date:s n:f0"),
    "sql_udf": paired(
        sql_udf, "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM "
        "lineitem", "l_orderkey:i l_partkey:i l_suppkey:i l_linenumber:i net:f4"),
    "python_model": paired(
        python_model, "SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spent FROM orders WHERE o_orderstatus "
        "= 'F' GROUP BY 1", "o_custkey:i spent:f2"),
    "append": paired(lambda s: incremental.append(accounts_now(s), accounts_delta(s)),
                     f"SELECT * FROM {NOW} UNION ALL SELECT * FROM {DELTA}", ACCOUNT),
    "upsert": paired(lambda s: incremental.merge_upsert(accounts_now(s), accounts_delta(s), "id"), UPSERTED, ACCOUNT),
    "upsert_partial": paired(
        lambda s: incremental.merge_upsert(accounts_now(s), accounts_delta(s), ["id"], exclude_cols=["name"],
                                           predicate="balance >= 0"),
        f"SELECT t.id, t.name, CASE WHEN t.balance >= 0 THEN COALESCE(d.balance, t.balance) ELSE t.balance END AS balance "
        f"FROM {NOW} t LEFT JOIN {DELTA} d ON t.id = d.id UNION ALL SELECT d.* FROM {DELTA} d WHERE d.id NOT IN (SELECT id "
        f"FROM {NOW} WHERE balance >= 0)", ACCOUNT),
    "delete_insert": paired(
        lambda s: incremental.delete_insert(event_rows(s), purchases_doubled(s), ["user_id", "event_type"], "value > 10"),
        "SELECT event_id, user_id, event_type, ts, value FROM events WHERE NOT (event_type = 'purchase' AND value > 10) "
        "UNION ALL SELECT event_id, user_id, event_type, ts, value * 2 FROM events WHERE event_type = 'purchase'", EVENT),
    "overwrite": paired(
        lambda s: incremental.insert_overwrite(event_rows(s), purchases_doubled(s), "event_type = 'purchase'"),
        "SELECT event_id, user_id, event_type, ts, CASE WHEN event_type = 'purchase' THEN value * 2 ELSE value END AS value "
        "FROM events", EVENT),
    "microbatch": paired(
        microbatch, "SELECT event_id, user_id, event_type, ts, value FROM events WHERE ts < TIMESTAMP '2024-01-10' OR ts >= "
        "TIMESTAMP '2024-01-20' UNION ALL SELECT event_id, user_id, event_type, ts, value * 2 FROM events WHERE event_type "
        "= 'purchase' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'", EVENT),
    "schema_sync": paired(
        schema_sync, f"SELECT *, NULL AS region FROM {NOW} UNION ALL SELECT *, 'EU' FROM {DELTA}", f"{ACCOUNT} region:s"),
    "schema_retype": paired(
        schema_retype, f"SELECT t.id, COALESCE(d.balance, t.balance) AS balance, CASE WHEN d.id IS NOT NULL THEN 'EU' END AS "
        f"region FROM {NOW} t LEFT JOIN {DELTA} d ON t.id = d.id UNION ALL SELECT d.id, d.balance, 'EU' FROM {DELTA} d WHERE "
        f"d.id NOT IN (SELECT id FROM {NOW})", "id:s balance:f2 region:s"),
    "incremental_runs": paired(incremental_runs, UPSERTED, ACCOUNT),
    "scd2_init": paired(
        lambda s: snapshots.snapshot_init(first_state(s), snapshots.Snapshot("id", updated_at="updated_at")),
        f"SELECT *, {oracle.scd('id', 'updated_at')} AS dbt_scd_id, updated_at AS dbt_updated_at, updated_at AS "
        f"dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM ({S1})", SCD),
    "scd2_timestamp": paired(scd2(), scd_sql("ignore", False), SCD),
    "scd2_timestamp_rerun": paired(scd2(runs=2), scd_sql("ignore", False), SCD),
    "scd2_check": paired(scd2("invalidate", "check"), scd_sql("invalidate", True), SCD),
    "scd2_deletes": paired(scd2("new_record"), scd_sql("new_record", False), f"{SCD} dbt_is_deleted:s"),
    "scd2_history": paired(scd2_history, scd_history_sql(), SCD),
    "dq_unique": paired(
        lambda s: quality.check_unique(line_keys(s), "line_key"),
        "SELECT CONCAT_WS('-', l_orderkey, l_linenumber) AS unique_field, COUNT(*) AS n_records FROM lineitem GROUP BY 1 "
        "HAVING COUNT(*) > 1", "unique_field:s n_records:i"),
    "dq_not_null": paired(
        lambda s: quality.check_not_null(s.product_events, "company_id"),
        "SELECT event_id, event_name FROM product_events WHERE company_id IS NULL", "event_id:s event_name:s"),
    "dq_accepted": paired(
        lambda s: quality.check_accepted(s.table("events"), "event_type", ["click", "view"]),
        "SELECT event_type AS value_field, COUNT(*) AS n_records FROM events WHERE event_type NOT IN ('click', 'view') "
        "GROUP BY 1", "value_field:s n_records:i"),
    "dq_fk": paired(
        lambda s: quality.check_fk(s.table("orders"), "o_custkey", s.table("customer").filter("c_acctbal >= 0"),
                                   "c_custkey"),
        "SELECT o_custkey AS from_field FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM "
        "customer WHERE c_acctbal >= 0)", "from_field:i"),
    "dq_threshold": paired(
        lambda s: quality.run_check(quality.check_unique(line_keys(s), "line_key"), "> 10", "> 100000000"),
        "SELECT COUNT(*) AS failures, COUNT(*) > 10 AS should_warn, COUNT(*) > 100000000 AS should_error FROM (SELECT 1 FROM "
        "lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)",
        "failures:i should_warn:b should_error:b"),
    "dq_suite": Query(
        lambda spark, sf_dir: finish(dq_suite(StandIns(spark, sf_dir)).withColumnsRenamed(
            {"column": "col", "check": "kind"}), "model:s col:s kind:s failures:i should_warn:b should_error:b"),
        oracle.sql(_suite_sql(), "model:s col:s kind:s failures:i should_warn:b should_error:b")),
    "assert_rows": paired(
        assert_same, "SELECT 'F' AS o_orderstatus, n, side AS actual_or_expected, 'changed' AS route FROM (SELECT COUNT(*) "
        "AS n, 'actual' AS side FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT COUNT(*) + 1, 'expected' FROM orders "
        "WHERE o_orderstatus = 'F')", "o_orderstatus:s n:i actual_or_expected:s route:s"),
    "contract": paired(contract, "SELECT o_orderstatus, o_orderkey, o_custkey FROM orders",
                       "o_orderstatus:s o_orderkey:i o_custkey:i"),
    "stream_daily_totals": paired(
        stream_daily_totals, "SELECT 'SF_' || user_id AS master_customer_id, CAST(ts AS DATE) AS event_date, COUNT(DISTINCT "
        "event_id) AS daily_events, COUNT(DISTINCT event_type) AS daily_unique_event_types, COUNT(DISTINCT CASE WHEN "
        "event_type ILIKE '%purchase%' OR event_type ILIKE '%upgrade%' THEN event_id END) AS daily_key_actions, "
        "COUNT(DISTINCT user_id) AS daily_active_users FROM events GROUP BY 1, 2",
        "master_customer_id:s event_date:d daily_events:i daily_unique_event_types:i daily_key_actions:i "
        "daily_active_users:i"),
    "stream_maintain": paired(
        stream_maintain, "SELECT user_id, COUNT(*) AS n, SUM(CAST(value AS DECIMAL(18,2))) AS value FROM events GROUP BY 1",
        "user_id:i n:i value:f2"),
    "stream_microbatch": paired(
        stream_microbatch, "SELECT NULLIF(event_id, CASE WHEN event_id % 10 = 0 THEN event_id END) AS event_id, ts, value, CAST(ts AS DATE) "
        "AS event_day FROM events", "event_id:f0 ts:t value:f2 event_day:d"),
}
