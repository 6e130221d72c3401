import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import incremental, quality
from ledgerloom.operators.session import cut_lineage, ensure_checkpoint_dir
from ledgerloom.schemas import RAW_SCHEMA, SOURCE_GROUPS, STAGING, staged_schema, tables_of
from ledgerloom.sources import catalog, landing, partitions, staging, tables
from ledgerloom.streaming import ingest, refresh, totals


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt") as f:
        f.write("\n".join(lines) + ("\n" if lines else ""))


@pytest.fixture
def lake(tmp_path):
    batch = tmp_path / "clients/acme/stripe/refunds/run_date=2024-01-02"
    put(batch, "stripe_refunds.jsonl.gz", '{"refund_id":"r1","amount_gbp":27.5,"created_at":"2024-01-01T10:00:00.000Z"}',
        "", '{"refund_id":"r2","amount_gbp":"oops","created_at":"never"}')
    put(batch, "bad.jsonl.gz", '{"refund_id":"r3"}', '{"refund_id":', '{"refund_id":"r4"}')
    put(batch, "other.csv.gz", "not,json")
    (batch / "_SUCCESS").write_text("{}")
    put(tmp_path / "clients/acme/stripe/refunds/run_date=2024-01-03", "late.jsonl.gz", '{"refund_id":"r5"}')
    return tmp_path


def test_load_skips_files_with_a_bad_line(spark, lake, rows):
    raw = landing.load_raw(spark, str(lake))
    assert [f.name for f in raw.schema] == RAW_SCHEMA.fieldNames()
    staged = staging.stage("stripe_refunds", raw, number_scale=0)
    assert rows(staged, "refund_id", "_row_num") == [("r1", 1), ("r2", 3), ("r5", 1)]
    first = staged.filter("refund_id = 'r1'").first()
    assert first.amount_gbp == 28 and str(first.created_at) == "2024-01-01 10:00:00"
    assert staging.stager("stripe_refunds", 2)(raw).filter("refund_id = 'r1'").first().amount_gbp == 27.5
    lost = staging.lost_values("stripe_refunds", raw).first()
    assert (lost.amount_gbp, lost.created_at, lost.refund_id) == (1, 1, 0)


def test_other_error_modes(spark, lake):
    assert landing.load_raw(spark, str(lake), on_error="skip_row").count() == 5
    assert landing.load_raw(spark, str(lake), on_error="keep").filter("record_content is null").count() == 1
    with pytest.raises(ValueError):
        landing.load_raw(spark, str(lake), on_error="other")


def test_validation_reports_first_bad_line(spark, lake, rows):
    put(lake / "more", "empty.jsonl.gz", "", "")
    checked = landing.validate_jsonl(landing.read_lines(spark, str(lake))).withColumn(
        "name", F.element_at(F.split("file", "/"), -1))
    assert rows(checked, "name", "is_valid", "first_bad_line", "n_records") == sorted([
        ("bad.jsonl.gz", False, 2, 1), ("empty.jsonl.gz", False, None, 0), ("late.jsonl.gz", True, None, 1),
        ("stripe_refunds.jsonl.gz", True, None, 2)], key=repr)


def test_line_numbers_run_through_the_splits_of_a_file(spark, tmp_path):
    text = tmp_path / "big.jsonl"
    text.write_text("".join(json.dumps({"n": i, "pad": "x" * 50}) + "\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = landing.read_lines(spark, str(text), "*.jsonl")
        assert lines.rdd.getNumPartitions() > 3
        wrong = lines.filter(F.get_json_object("value", "$.n").cast("long") + 1 != F.col("line_number"))
        assert lines.count() == 3000 and wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def scans(df, kind):
    return df._jdf.queryExecution().executedPlan().toString().count(f"FileScan {kind}")


def test_text_is_read_once_to_judge_and_once_to_load(spark, lake):
    assert scans(landing.validate_files(spark, str(lake)), "text") == 1
    assert scans(landing.load_raw(spark, str(lake)), "text") == 2
    assert scans(landing.read_lines(spark, str(lake)), "text") == 2


def test_validation_counts_records_before_a_bad_line_over_chunks_and_splits(spark, tmp_path, rows):
    lines = ["" if i % 7 == 3 else json.dumps({"n": i, "pad": "x" * 30}) for i in range(5000)]
    lines[4321] = lines[4800] = '{"cut'
    (tmp_path / "big.jsonl").write_text("\n".join(lines) + "\n\n \n")
    (tmp_path / "good.jsonl").write_text("\n".join(line for line in lines if "cut" not in line))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (old, "30000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            checked = landing.validate_files(spark, str(tmp_path), "*.jsonl").withColumn("name", F.element_at(F.split("file", "/"), -1))
            want = [("big.jsonl", False, 4322, sum(line != "" for line in lines[:4321])),
                    ("good.jsonl", True, None, sum(line not in ("", '{"cut') for line in lines))]
            assert rows(checked, "name", "is_valid", "first_bad_line", "n_records") == sorted(want, key=repr)
            loaded = landing.load_raw(spark, str(tmp_path), "skip_row", "*.jsonl").filter("metadata_filename like '%big.jsonl'")
            numbers = [r[0] for r in loaded.select("metadata_row_number").collect()]
            assert sorted(numbers) == [i + 1 for i, line in enumerate(lines) if line not in ("", '{"cut')]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_only_marked_batches_are_promoted(spark, lake, rows):
    files = landing.with_layout(landing.listing(spark, str(lake)))
    promoted = landing.promote_complete_batches(files)
    assert rows(promoted, "run_date", "file") == [("2024-01-02", "bad.jsonl.gz"), ("2024-01-02", "other.csv.gz"),
                                                  ("2024-01-02", "stripe_refunds.jsonl.gz")]
    assert landing.raw_path("acme", "stripe", "refunds", "2024-01-02", "x.jsonl", base="s3://b") == (
        "s3://b/clients/acme/stripe/refunds/run_date=2024-01-02/x.jsonl.gz")


def test_file_names(spark, rows):
    df = spark.createDataFrame([("sf_accounts.jsonl",), ("a/b/stripe_invoice_line_items.jsonl",), ("plain.jsonl",),
                                ("new_thing.jsonl",)], "file string")
    good, bad = landing.split_rejects(landing.with_source_table(df))
    assert rows(good, "source", "table") == [("new", "thing"), ("salesforce", "accounts"), ("stripe", "invoice_line_items")]
    assert rows(bad, "file") == [("plain.jsonl",)]


def test_catalog_and_specs(spark, lake):
    tenant = catalog.Catalog(spark, "acme", "dev", str(lake))
    assert tenant.database == "ACME_DEV_RAW" and len(tenant.groups()) == 7
    assert sum(len(tenant.tables(g)) for g in tenant.groups()) == len(STAGING) == 23
    assert tenant.source("stripe", "refunds", "2024-01-03").count() == 1
    assert quality.contract_violations(tenant.staged("stripe", "refunds"), staged_schema("stripe_refunds")) == []
    with pytest.raises(KeyError):
        tenant.source("stripe", "nothing")
    assert tables_of("salesforce") == ["sf_accounts", "sf_opportunities", "sf_users"] and "jira" in SOURCE_GROUPS


def test_variant_is_kept_whole(spark):
    raw = spark.sql("""select parse_json('{"event_id":"1","properties":{"a":[1,2]}}') as record_content""")
    row = staging.stage("mixpanel_events", raw).select(F.to_json("event_properties").alias("p"), "event_id").first()
    assert (row.p, row.event_id) == ('{"a":[1,2]}', "1")


def test_seed_types(spark, tmp_path):
    (tmp_path / "seed.csv").write_text('"a","b"\n"x, y","07"\n')
    df = catalog.load_seed(spark, str(tmp_path / "seed.csv"), {"b": "int"})
    assert df.first().asDict() == {"a": "x, y", "b": 7}
    assert catalog.load_seed(spark, str(tmp_path / "seed.csv")).first().b == "07"
    assert catalog.load_seed(spark, str(tmp_path / "seed.csv"), infer=False).dtypes == [("a", "string"), ("b", "string")]


def test_seed_types_are_inferred_from_all_rows(spark, tmp_path):
    lines = ["n,x,yes,day,moment,code,long,text.1,none,late", "1,1.5,true,2024-01-31,2024-01-31 10:00:00,007,12345678901234567890,a,,1"]
    lines += ["-20,2e3,FALSE,2024-02-01,2024-02-01T11:30,8,1,b,,2"] * 500 + [",,,,,,,,,x", "3,.25,true,2024-02-30,,,,,,3"]
    (tmp_path / "seed.csv").write_text("\n".join(lines))
    df = catalog.load_seed(spark, str(tmp_path / "seed.csv"))
    assert dict(df.dtypes) == {"n": "bigint", "x": "double", "yes": "boolean", "day": "string", "moment": "timestamp_ntz", "code": "string",
                               "long": "string", "text.1": "string", "none": "string", "late": "string"}
    assert df.filter("n = 3").first().x == 0.25 and df.filter("n is null").count() == 1


def test_listing_can_be_narrowed(spark, lake, rows):
    files = landing.with_layout(landing.listing(spark, str(lake), run_date="2024-01-03"))
    assert rows(files, "run_date", "file") == [("2024-01-03", "late.jsonl.gz")]


def test_tables_views_and_clones(spark, tmp_path, rows):
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    written = tables.write_table(df, "t_cluster", cluster_by=["k"])
    assert written.count() == 10
    tables.write_table(df, "t_bucket", buckets=(2, ["k"]))
    assert rows(tables.clone_table(spark, "t_bucket", "t_copy")) == rows(df)
    assert tables.register_view(df, "v").count() == 10
    with pytest.raises(ValueError, match="class path"):
        tables.write_table(df, "t_ice", fmt="iceberg")
    tables.export_segment(df, str(tmp_path / "seg"), "json")
    assert spark.read.json(str(tmp_path / "seg")).count() == 10


def test_jsonl_export_skips_existing_dates(spark, tmp_path):
    path = str(tmp_path / "out")
    assert tables.write_jsonl(spark.range(3), path, "2024-01-01")
    assert not tables.write_jsonl(spark.range(9), path, "2024-01-01")
    assert spark.read.json(path).count() == 3
    assert tables.write_jsonl(spark.range(9), path, "2024-01-01", force=True)
    assert tables.path_exists(spark, f"{path}/run_date=2024-01-01/_SUCCESS")
    assert landing.load_raw(spark, path, pattern="*.json.gz").count() == 9


def test_audit_and_freshness(spark, rows):
    a, b = spark.range(3), spark.range(2)
    assert [tuple(r) for r in landing.audit_counts({"b": b, "a": a}).collect()] == [("a", 3), ("b", 2)]
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' as at, 'x' as k union all select timestamp_ntz'2024-01-02', 'y'")
    now = F.lit("2024-01-02 00:01:00").cast("timestamp_ntz")
    assert landing.freshness(df, "at", now).first().age_seconds == 60
    assert landing.freshness(df, "at", now, "k = 'x'").first().age_seconds == 86460


def test_cut_lineage_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = ensure_checkpoint_dir(spark)
    assert named is None or folder == named
    cut = cut_lineage(spark.range(5))
    assert cut.count() == 5 and folder in cut.inputFiles()[0]


# --- checks ----------------------------------------------------------------------


def test_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (None, "zz")], "id int, k string")
    parent = spark.createDataFrame([(2,)], "id int")
    assert rows(quality.check_unique(df, "id")) == [(1, 2)]
    assert rows(quality.check_unique(df, "id", where="k = 'a'")) == []
    assert quality.check_not_null(df, "id").count() == 2
    assert rows(quality.check_accepted(df, "k", ["a", "b"])) == [("zz", 1)]
    assert rows(quality.check_fk(df, "id", parent, "id")) == [(1,), (1,)]
    verdict = quality.run_check(quality.check_fk(df, "id", parent, "id"), "> 1", "> 5").first()
    assert tuple(verdict) == (2, True, False)
    assert quality.run_check(quality.check_not_null(df, "id"), limit=1, store_as="failing").first().failures == 1
    assert spark.table("failing").count() == 2
    with pytest.raises(ValueError):
        quality.threshold("about 3")


def test_unit_rows_and_contracts(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType(), False), T.StructField("b", T.StringType())])
    rows = quality.fixture(spark, schema, [{"a": 1}, {"b": "x"}])
    assert [tuple(r) for r in rows.collect()] == [(1, None), (None, "x")]
    quality.assert_rows(rows, rows)
    with pytest.raises(AssertionError):
        quality.assert_rows(rows.unionByName(rows.limit(1)), rows)  # duplicates count
    with pytest.raises(ValueError):
        quality.fixture(spark, schema, [{"c": 1}])
    with pytest.raises(ValueError, match="missing column b"):
        quality.check_contract(rows.select("a"), schema)
    assert quality.contract_violations(rows.select(F.col("a").cast("long"), "b"), schema) == ["a: bigint instead of int"]


# --- streams ---------------------------------------------------------------------


def test_files_are_landed_once_and_whole(spark, lake, tmp_path, rows):
    target, state = str(tmp_path / "landed"), str(tmp_path / "state")

    def load():
        ingest.land_files(spark, str(lake / "clients"), target, state).awaitTermination()
        assert [f.name for f in ingest.landed(spark, target).schema] == RAW_SCHEMA.fieldNames()
        return rows(staging.stage("stripe_refunds", ingest.landed(spark, target)), "refund_id", "_row_num")

    assert load() == [("r1", 1), ("r2", 3), ("r5", 1)]
    put(lake / "clients/acme/stripe/refunds/run_date=2024-01-04", "next.jsonl.gz", "", '{"refund_id":"r6"}', '{"refund_id":"r7"}')
    assert load() == [("r1", 1), ("r2", 3), ("r5", 1), ("r6", 2), ("r7", 3)]
    assert load() == [("r1", 1), ("r2", 3), ("r5", 1), ("r6", 2), ("r7", 3)]


EVENTS = ("master_customer_id string, event_id string, event_name string, user_identifier string, timestamp timestamp")


def test_stream_totals_equal_batch_totals(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    df = spark.sql("""select concat('c', id % 3) as master_customer_id, cast(id % 90 as string) as event_id,
        case when id % 2 = 0 then 'Purchase' else 'view' end as event_name, concat('u', id % 7) as user_identifier,
        timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 4 as int)) as timestamp from range(90)""")
    df.unionByName(df.limit(20)).write.parquet(source)  # repeated deliveries
    parts = totals.stream_user_days(spark.readStream.schema(EVENTS).parquet(source), "30 days")
    query = (parts.writeStream.outputMode("update").format("memory").queryName("parts")
             .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    query.awaitTermination()
    batch = df.groupBy("master_customer_id", F.col("timestamp").cast("date").alias("event_date")).agg(
        F.count_distinct("event_id").alias("daily_events"), F.count_distinct("event_name").alias("daily_unique_event_types"),
        F.count_if(F.col("event_name") == "Purchase").alias("daily_key_actions"),
        F.count_distinct("user_identifier").alias("daily_active_users"))
    assert rows(totals.totals_of(spark.table("parts"))) == rows(batch)


def test_replace_days_keeps_earlier_rows_of_a_day(spark, tmp_path, rows):
    path = str(tmp_path / "days")
    batches = [[(1, "2024-01-01", "a"), (2, "2024-01-02", "a")], [(9, "2024-01-02", "b")], [(2, "2024-01-02", "c")], [(9, "2024-01-02", "b")]]
    for n, values in enumerate(batches):
        source = str(tmp_path / f"in{n}")
        spark.createDataFrame(values, "id int, at string, v string").selectExpr("id", "cast(at as timestamp_ntz) as at", "v").write.parquet(source)
        stream = spark.readStream.schema("id int, at timestamp_ntz, v string").parquet(source)
        refresh.replace_days(stream, path, str(tmp_path / f"state{n}"), "at", ["id"]).awaitTermination()
    assert rows(spark.read.parquet(path), "id", "v") == [(1, "a"), (2, "c"), (9, "b")]


def test_rows_without_keys_stay_over_replays(spark, tmp_path, rows):
    path, source = str(tmp_path / "days"), str(tmp_path / "in")
    schema = "id int, at timestamp_ntz, v string"
    values = [(None, "2024-01-01", "a"), (None, "2024-01-01", "b"), (1, "2024-01-01", "c"), (None, "2024-01-02", "b"), (None, "2024-01-02", "b")]
    frame = spark.createDataFrame(values, "id int, at string, v string").selectExpr("id", "cast(at as timestamp_ntz) as at", "v")
    frame.write.parquet(source)
    for n in range(4):
        refresh.replace_days(spark.readStream.schema(schema).parquet(source), path, str(tmp_path / f"state{n}"), "at", ["id"]).awaitTermination()
        assert rows(spark.read.parquet(path), "id", "v") == sorted(((i, v) for i, _, v in values), key=repr)


def test_the_latest_row_of_a_key_stays_and_other_days_are_not_read(spark, tmp_path, rows):
    path = str(tmp_path / "days")
    schema = "id int, at timestamp_ntz, v string"
    for n, values in enumerate([[(1, "2024-01-01 10:00:00", "late"), (1, "2024-01-01 09:00:00", "early"), (5, "2024-01-02 00:00:00", "x")],
                                [(1, "2024-01-01 08:00:00", "older"), (2, "2024-01-01 01:00:00", "new")]]):
        source = str(tmp_path / f"in{n}")
        spark.createDataFrame(values, "id int, at string, v string").selectExpr("id", "cast(at as timestamp_ntz) as at", "v").write.parquet(source)
        other = {p: p.stat().st_mtime_ns for p in (tmp_path / "days").rglob("event_day=2024-01-02/*.parquet")}
        refresh.replace_days(spark.readStream.schema(schema).parquet(source), path, str(tmp_path / f"state{n}"), "at", ["id"]).awaitTermination()
    assert rows(spark.read.parquet(path), "id", "v") == [(1, "late"), (2, "new"), (5, "x")]
    assert other and all(p.stat().st_mtime_ns == at for p, at in other.items())
    stored = partitions.read_parts(spark, path)
    plan = partitions.within(stored, "event_day", [dt.date(2024, 1, 1)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_day" in plan and "= 2024-01-01)]" in plan


def test_late_events_are_counted(spark, tmp_path):
    totals.keep_state_on_disk(spark)
    source, seen = str(tmp_path / "in"), []
    row = lambda i, day: ("c", f"e{i}", "view", "u", dt.datetime(2024, 1, day))
    for values in ([row(1, 10), row(2, 9)], [row(3, 12)], [row(4, 1), row(5, 2), row(6, 12)], [row(7, 13), row(8, 3)]):
        spark.createDataFrame(values, EVENTS).coalesce(1).write.mode("append").parquet(source)
        parts = totals.stream_user_days(spark.readStream.schema(EVENTS).parquet(source), "1 day")
        query = refresh.maintain(parts, str(tmp_path / "table"), str(tmp_path / "state"), totals.PART_KEYS,
                                 lambda current, new: incremental.merge_upsert(current, new, totals.PART_KEYS), output_mode="update")
        query.awaitTermination()
        late = totals.late_events(spark, query).agg(F.sum("late")).first()[0]
        counted = partitions.read_table(spark, str(tmp_path / "table")).agg(F.sum("n_events")).first()[0]
        seen.append((late, counted))
    assert seen == [(0, 2), (0, 3), (2, 4), (1, 5)]


def test_maintain_adds_batches_and_skips_a_replayed_one(spark, tmp_path, rows):
    source, path, state = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "state")
    total = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))

    def run():
        stream = spark.readStream.schema("k string, n long").option("maxFilesPerTrigger", 1).parquet(source)
        refresh.maintain(stream, path, state, ["k"], lambda current, batch: incremental.merge_add(current, batch, ["k"]), total).awaitTermination()
        return rows(partitions.read_table(spark, path))

    for values in ([("a", 2), ("b", 1)], [("a", 1)], [("a", 4), ("c", 1)]):
        spark.createDataFrame(values, "k string, n long").coalesce(1).write.mode("append").parquet(source)
    assert run() == [("a", 7), ("b", 1), ("c", 1)]
    last = max(int(p.name) for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):  # as if the run had ended after the table's commit and before the stream's
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    # Someone else changes the table before the batch is retried.
    partitions.merge_by_key(spark.createDataFrame([("d", 1)], "k string, n long"), path, ["k"], lambda current, new: incremental.merge_add(current, new, ["k"]))
    assert run() == [("a", 7), ("b", 1), ("c", 1), ("d", 1)]


def test_suite_verdicts_and_stored_failures(spark, rows):
    t = spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, "c", 9), (None, "c", 7), (3, None, 7)], "id int, kind string, ref int")
    other = spark.createDataFrame([(7,), (5,), (None,)], "key int")
    spec = [quality.Check("t", "id", "unique"), quality.Check("t", "id", "unique", where="kind <> 'b'"), quality.Check("t", "id", "not_null"),
            quality.Check("t", "kind", "accepted_values", values=("a", "b"), severity="warn"),
            quality.Check("t", "ref", "relationships", to="o", field="key"), quality.Check("t", "kind", "unique", fail_calc="max(n_records)", error_if="> 1"),
            quality.Check("t", "id", "unique", fail_calc="sum(n_records)", limit=1, warn_if="> 5"), quality.Check("o", "key", "not_null", error_if="> 1"),
            quality.Check("t", "kind", "accepted_values", values=("a", "b", "c"), fail_calc="sum(n_records)")]
    got = [tuple(r) for r in quality.run_suite(spec, {"t": t, "o": other}, store_as="kept_failures").collect()]
    assert sorted(got) == sorted([
        ("t", "id", "unique", 1, True, True), ("t", "id", "unique", 0, False, False), ("t", "id", "not_null", 1, True, True),
        ("t", "kind", "accepted_values", 1, True, False), ("t", "ref", "relationships", 1, True, True), ("t", "kind", "unique", 2, True, True),
        ("t", "id", "unique", 2, False, True), ("o", "key", "not_null", 1, True, False), ("t", "kind", "accepted_values", 0, False, False)])
    assert rows(spark.table("kept_failures"), "model", "column", "kind", "value", "n_records") == sorted([
        ("t", "id", "unique", "1", 2), ("t", "id", "not_null", None, 1), ("t", "kind", "accepted_values", "c", 2),
        ("t", "ref", "relationships", "9", 1), ("o", "key", "not_null", None, 1)], key=repr)
    for wrong in ({"kind": "odd"}, {"kind": "unique", "severity": "odd"}):
        with pytest.raises(ValueError):
            quality.Check("t", "id", **wrong)


def test_suite_reads_each_model_once_and_once_more_for_references(spark, tmp_path):
    models = {}
    for name in ("m", "parent"):
        spark.range(20).selectExpr("id", "id as ref", "'x' as kind").write.parquet(str(tmp_path / name))
        models[name] = spark.read.parquet(str(tmp_path / name))
    spec = [quality.Check(m, c, k) for m in models for c in ("id", "ref") for k in ("unique", "not_null")]
    spec += [quality.Check("m", c, "relationships", to="parent", field="id") for c in ("id", "ref")]
    df = quality.run_suite(spec, models)
    assert df.filter("failures > 0").count() == 0
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3


def test_quality_gate(spark):
    checks = [quality.Check("batch", "id", "not_null")]
    assert ingest.quality_gate(spark.range(3), "batch", checks)
    assert not ingest.quality_gate(spark.sql("select cast(null as int) as id"), "batch", checks)
