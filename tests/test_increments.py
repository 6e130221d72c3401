import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import incremental, snapshots
from ledgerloom.sources import partitions

ROW = "id string, name string, v int"


@pytest.fixture
def frames(spark):
    target = spark.createDataFrame([("a", "A", 1), ("b", "B", 2), (None, "N", 0)], ROW)
    source = spark.createDataFrame([("b", "BB", 20), ("c", "C", 3), (None, "M", 9)], ROW)
    return target, source


def test_upsert_updates_inserts_and_never_matches_null_keys(frames, rows):
    target, source = frames
    assert rows(incremental.merge_upsert(target, source, "id")) == sorted(
        [("a", "A", 1), ("b", "BB", 20), ("c", "C", 3), (None, "N", 0), (None, "M", 9)], key=repr)


def test_upsert_is_idempotent(frames, rows):
    target, source = (f.filter("id is not null") for f in frames)
    once = incremental.merge_upsert(target, source, "id")
    assert rows(incremental.merge_upsert(once, source, "id")) == rows(once)


def test_upsert_column_lists_and_predicate(frames, rows):
    target, source = (f.filter("id is not null") for f in frames)
    assert rows(incremental.merge_upsert(target, source, "id", update_cols=["v"])) == [
        ("a", "A", 1), ("b", "B", 20), ("c", "C", 3)]
    assert rows(incremental.merge_upsert(target, source, "id", exclude_cols=["V"])) == [
        ("a", "A", 1), ("b", "BB", 2), ("c", "C", 3)]
    # A target row outside the predicate cannot match, so its source row is inserted.
    assert rows(incremental.merge_upsert(target, source, "id", predicate="v > 100")) == [
        ("a", "A", 1), ("b", "B", 2), ("b", "BB", 20), ("c", "C", 3)]
    with pytest.raises(ValueError):
        incremental.update_columns(["a"], ["a"], ["b"])


def test_upsert_updates_every_target_row_of_a_key(spark, rows):
    target = spark.createDataFrame([("a", "1", 1), ("a", "2", 2)], ROW)
    source = spark.createDataFrame([("a", "x", 9)], ROW)
    assert rows(incremental.merge_upsert(target, source, "id")) == [("a", "x", 9), ("a", "x", 9)]


def test_duplicate_source_keys_fail(spark, frames):
    target, _ = frames
    source = spark.createDataFrame([("b", "x", 1), ("b", "y", 2)], ROW)
    with pytest.raises(Exception, match="duplicate source key"):
        incremental.merge_upsert(target, source, "id").collect()
    only_keys = spark.createDataFrame([("q",), ("q",)], "id string")
    with pytest.raises(Exception, match="duplicate source key"):
        incremental.merge_upsert(target.select("id"), only_keys, "id").collect()


def test_delete_insert_append_and_overwrite(frames, rows):
    target, source = (f.filter("id is not null") for f in frames)
    assert rows(incremental.delete_insert(target, source, ["id"])) == [("a", "A", 1), ("b", "BB", 20), ("c", "C", 3)]
    assert rows(incremental.delete_insert(target, source, ["id"], "v > 100")) == [
        ("a", "A", 1), ("b", "B", 2), ("b", "BB", 20), ("c", "C", 3)]
    assert rows(incremental.append(target, source)) == rows(target) + rows(source)
    assert rows(incremental.merge_upsert(target, source, None)) == rows(target) + rows(source)
    assert rows(incremental.insert_overwrite(target, source)) == rows(source)
    assert rows(incremental.insert_overwrite(target, source, "v = 1")) == [("b", "B", 2), ("b", "BB", 20), ("c", "C", 3)]


def test_microbatch_window_is_half_open(spark, rows):
    at = lambda day: dt.datetime(2024, 1, day)
    target = spark.createDataFrame([(1, at(1)), (2, at(2)), (3, at(3))], "id int, ts timestamp_ntz")
    source = spark.createDataFrame([(20, at(2))], "id int, ts timestamp_ntz")
    assert rows(incremental.microbatch(target, source, "ts", "2024-01-02", "2024-01-03"), "id") == [(1,), (20,), (3,)]
    with pytest.raises(ValueError):
        incremental.microbatch(target, source, "ts", None, None)


def test_schema_policies(spark):
    target = spark.createDataFrame([("a", 1, 2)], "id string, v int, old int")
    source = spark.createDataFrame([("b", 5, "x")], "id string, v long, new string")
    full = source.withColumn("old", F.lit(1))
    for policy in ("ignore", "nonsense"):
        src, dst = incremental.reconcile_schema(full, target, policy)
        assert src.columns == dst.columns == ["id", "v", "old"]
    with pytest.raises(ValueError):
        incremental.reconcile_schema(source, target, "fail")
    with pytest.raises(ValueError, match="lacks target columns"):
        incremental.reconcile_schema(source, target, "ignore")
    src, dst = incremental.reconcile_schema(source, target, "append_new_columns")
    assert dst.columns == ["id", "v", "old", "new"] and src.schema == dst.schema
    src, dst = incremental.reconcile_schema(source, target, "sync_all_columns")
    assert [f.simpleString() for f in dst.schema] == ["id:string", "v:bigint", "new:string"]


def upsert(current, source):
    return incremental.merge_upsert(current, source, "id")


def test_runs_build_merge_and_refresh(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    seen = []

    def build(is_increment):
        seen.append(is_increment)
        return spark.createDataFrame([("a", "x", len(seen))], ROW)

    for refresh in (False, False, True):
        result = incremental.run_incremental(spark, path, build, upsert, "id", full_refresh=refresh)
    assert seen == [False, True, False]
    assert rows(result) == rows(partitions.read_table(spark, path)) == [("a", "x", 3)]
    assert partitions.read_table(spark, str(tmp_path / "none")) is None
    whole = str(tmp_path / "u")
    for _ in range(2):
        result = incremental.run_incremental(spark, whole, lambda _: spark.createDataFrame([("a", "x", 1)], ROW), incremental.append)
    assert rows(result) == [("a", "x", 1)] * 2


def test_a_merge_leaves_the_files_of_other_buckets(spark, rows, tmp_path):
    path = tmp_path / "t"
    many = spark.range(1000).selectExpr("concat('k', id) as id", "'old' as name", "cast(id as int) as n")
    few = spark.createDataFrame([("k7", "new", 7), ("k900", "new", 900), ("more", "new", 1)], many.schema)
    incremental.run_incremental(spark, str(path), lambda _: many, upsert, "id", buckets=16)
    files = lambda: {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    before = files()
    result = incremental.run_incremental(spark, str(path), lambda _: few, upsert, "id", buckets=99)
    after = files()
    touched = {f"bucket_of_16={r[0]}" for r in partitions.with_bucket(few, ["id"], 16).select("bucket_of_16").collect()}
    assert 1 <= len(touched) <= 3 and len({p.parent.name for p in after}) == 16
    assert {p.parent.name for p in before if p not in after} == touched  # replaced files are gone
    assert all(after[p] == at for p, at in before.items() if p.parent.name not in touched)
    assert result.count() == 1001 and rows(result.filter("name = 'new'")) == [("k7", "new", 7), ("k900", "new", 900), ("more", "new", 1)]


def test_a_merge_reads_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    many = spark.range(100).selectExpr("concat('k', id) as id", "'old' as name", "cast(id as int) as n")
    partitions.merge_by_key(many, path, ["id"], upsert, 8)
    part = partitions.within(partitions.read_parts(spark, path), "bucket_of_8", [3])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket_of_8" in plan and "= 3)]" in plan


def test_a_change_that_was_cut_off_is_finished(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one, two = (spark.createDataFrame([("a", "x", n), (f"b{n}", "x", n)], ROW) for n in (1, 2))
    add = lambda current, source: incremental.merge_add(current, source, ["id", "name"])
    partitions.merge_by_key(one, path, ["id"], add, 4, ("s", 0))
    monkeypatch.setattr(partitions, "_finish", lambda *_: None)  # the run ends before the rows are put in place
    partitions.merge_by_key(two, path, ["id"], add, 4, ("s", 1))
    monkeypatch.undo()
    (tmp_path / "t.pending" / "bucket_of_4~parts~other~3").mkdir()  # a write without its marker counts for nothing
    assert partitions.applied(spark, path, "s") == 1 and partitions.applied(spark, path, "other") == -1
    assert rows(partitions.read_table(spark, path)) == [("a", "x", 3), ("b1", "x", 1), ("b2", "x", 2)]
    assert not (tmp_path / "t.pending").exists()


def test_a_new_column_rewrites_the_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    old, new = spark.createDataFrame([("a", 1), ("b", 1)], "id string, n int"), spark.createDataFrame([("b", 2, "x")], "id string, n int, more string")
    incremental.run_incremental(spark, path, lambda _: old, upsert, "id")
    result = incremental.run_incremental(spark, path, lambda _: new, upsert, "id", on_schema_change="append_new_columns")
    assert rows(result, "id", "n", "more") == [("a", 1, None), ("b", 2, "x")]


# --- snapshots -------------------------------------------------------------------

SCHEMA = "id string, v int, updated_at timestamp_ntz"


def at(day):
    return dt.datetime(2024, 1, day)


def versions(df):
    return sorted(((r.id, r.v, r.dbt_valid_from, r.dbt_valid_to) for r in df.collect()), key=repr)


def test_timestamp_strategy(spark):
    spec = snapshots.Snapshot("id", updated_at="updated_at")
    first = snapshots.snapshot_init(spark.createDataFrame([("a", 1, at(1)), ("b", 2, at(1))], SCHEMA), spec)
    source = spark.createDataFrame([("a", 10, at(3)), ("b", 99, at(1)), ("c", 3, at(2))], SCHEMA)
    second = snapshots.snapshot_apply(first, source, spec)
    want = sorted([("a", 1, at(1), at(3)), ("a", 10, at(3), None), ("b", 2, at(1), None), ("c", 3, at(2), None)], key=repr)
    assert versions(second) == want
    assert versions(snapshots.snapshot_apply(second, source, spec)) == want  # nothing new


def test_check_strategy_sees_null_changes(spark):
    spec = snapshots.Snapshot("id", strategy="check", check_cols=["v"], now="2024-01-05 00:00:00")
    first = snapshots.snapshot_init(spark.createDataFrame([("a", None, at(1)), ("b", 2, at(1))], SCHEMA),
                                    snapshots.Snapshot("id", strategy="check", now="2024-01-01 00:00:00"))
    second = snapshots.snapshot_apply(first, spark.createDataFrame([("a", 1, at(1)), ("b", 2, at(9))], SCHEMA), spec)
    assert versions(second) == sorted(
        [("a", None, at(1), at(5)), ("a", 1, at(5), None), ("b", 2, at(1), None)], key=repr)


def test_new_checked_column_changes_every_row(spark):
    first = snapshots.snapshot_init(spark.createDataFrame([("a", 1)], "id string, v int"),
                                    snapshots.Snapshot("id", strategy="check", now="2024-01-01 00:00:00"))
    source = spark.createDataFrame([("a", 1, "x")], "id string, v int, extra string")
    second = snapshots.snapshot_apply(first, source, snapshots.Snapshot("id", strategy="check", now="2024-01-02 00:00:00"))
    assert {(r.v, r.extra, r.dbt_valid_to) for r in second.collect()} == {(1, None, at(2)), (1, "x", None)}


@pytest.mark.parametrize("mode, gone", [
    ("ignore", [("b", 2, at(1), None)]), ("invalidate", [("b", 2, at(1), at(9))]),
    ("new_record", [("b", 2, at(1), at(9)), ("b", 2, at(9), None)])])
def test_hard_deletes(spark, mode, gone):
    spec = snapshots.Snapshot("id", updated_at="updated_at", hard_deletes=mode, now="2024-01-09 00:00:00")
    first = snapshots.snapshot_init(spark.createDataFrame([("a", 1, at(1)), ("b", 2, at(1))], SCHEMA), spec)
    second = snapshots.snapshot_apply(first, spark.createDataFrame([("a", 1, at(1))], SCHEMA), spec)
    assert versions(second) == sorted([("a", 1, at(1), None), *gone], key=repr)
    if mode == "new_record":
        assert {(r.dbt_valid_from, r.dbt_is_deleted) for r in second.filter("id = 'b'").collect()} == {
            (at(1), "False"), (at(9), "True")}


def test_custom_open_end_and_version_invariants(spark):
    spec = snapshots.Snapshot("id", updated_at="updated_at", valid_to_current="9999-12-31 00:00:00")
    state = snapshots.snapshot_init(spark.createDataFrame([("a", 1, at(1))], SCHEMA), spec)
    for day in (3, 5, 7):
        state = snapshots.snapshot_apply(state, spark.createDataFrame([("a", day, at(day))], SCHEMA), spec)
    rows = sorted((r.dbt_valid_from, r.dbt_valid_to) for r in state.collect())
    assert [a for a, _ in rows[1:]] == [b for _, b in rows[:-1]]  # no gap, no overlap
    assert rows[-1][1] == dt.datetime(9999, 12, 31)
    assert state.select("dbt_scd_id").distinct().count() == 4


def test_a_key_that_comes_back_unchanged(spark):
    source = spark.createDataFrame([("a", 1, at(1)), ("b", 2, at(1))], SCHEMA)
    only_a, newer = source.filter("id = 'a'"), spark.createDataFrame([("a", 1, at(1)), ("b", 3, at(5))], SCHEMA)
    for match, back in ((False, [("b", 2, at(1), None), ("b", 2, at(1), at(4))]), (True, [("b", 2, at(1), at(4))])):
        spec = snapshots.Snapshot("id", updated_at="updated_at", hard_deletes="invalidate", now="2024-01-04 00:00:00", match_history=match)
        gone = snapshots.snapshot_apply(snapshots.snapshot_init(source, spec), only_a, spec)
        assert versions(snapshots.snapshot_apply(gone, source, spec)) == sorted([("a", 1, at(1), None), *back], key=repr)
        again = versions(snapshots.snapshot_apply(gone, newer, spec))
        assert ("b", 3, at(5), None) in again and ("b", 2, at(1), at(4)) in again and len(again) == 3


def test_a_change_back_to_a_closed_version_closes_the_open_one(spark):
    spec = snapshots.Snapshot("id", strategy="check", check_cols=("v",), updated_at="updated_at", match_history=True)
    states = [spark.createDataFrame([("a", v, at(d))], SCHEMA) for v, d in ((1, 1), (2, 2), (1, 1))]
    state = snapshots.snapshot_init(states[0], spec)
    for source in states[1:]:
        state = snapshots.snapshot_apply(state, source, spec)
    assert versions(state) == [("a", 1, at(1), at(2)), ("a", 2, at(2), at(1))]


def test_snapshot_options_are_checked():
    with pytest.raises(ValueError):
        snapshots.Snapshot("id", strategy="other", updated_at="u")
    with pytest.raises(ValueError):
        snapshots.Snapshot("id")
    with pytest.raises(ValueError):
        snapshots.Snapshot("id", updated_at="u", hard_deletes="invalidate")
