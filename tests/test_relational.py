import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import relational

START = dt.date(2024, 1, 1)
sighting = st.tuples(st.sampled_from("AB"), st.sampled_from("uvwx"), st.integers(0, 40))


def naive_distinct(seen, grid, days):
    return {(k, g): len({m for key, m, n in seen if key == k and g - days < n <= g}) for k, g in grid}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seen=st.lists(sighting, min_size=1, max_size=40), days=st.sampled_from([1, 7, 30]))
def test_rolling_distinct_equals_brute_force(spark, seen, days):
    grid = [(k, n) for k in "AB" for n in range(-3, 75, 3)]
    day = lambda n: START + dt.timedelta(days=n)
    events = spark.createDataFrame([(k, m, day(n)) for k, m, n in seen], "k string, m string, day date")
    dates = spark.createDataFrame([(k, day(n)) for k, n in grid], "k string, day date")
    got = {(r.k, (r.day - START).days): r.n for r in
           relational.rolling_distinct(events, dates, "k", "m", "day", days, "n").collect()}
    assert got == naive_distinct(seen, grid, days)


def test_lookup_spreads_nulls_and_matches(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    dim = spark.createDataFrame([("a", 10), (None, 99)], "k2 string, v int")
    assert rows(relational.lookup(left, dim, "k", "k2", spread_by="id"), "id", "v") == [(1, 10), (2, None), (3, None)]
    assert rows(relational.attribute(left, dim, "k", "k2"), "id", "v") == [(1, 10)]
    assert rows(relational.unmatched(left, dim, "k", "k2"), "id") == [(3,)]


def test_null_keys_spread_over_partitions(spark):
    df = spark.range(10000).select(F.col("id"), F.lit(None).cast("string").alias("k"))
    spread = df.select(relational.spread_nulls("k", "id").alias("s")).agg(F.count_distinct("s").alias("n")).first().n
    assert spread == relational.NULL_SPREAD


def test_or_join_keeps_best_score_once(spark, rows):
    left = spark.createDataFrame([("x",), ("y",), (None,)], "k string")
    right = spark.createDataFrame([("m1", "x", "x"), ("m2", None, "x"), ("m3", "q", None)],
                                  "id string, a string, b string")
    joined = relational.or_join(left, right, "k", [("a", 2), ("b", 1)], "id", "score")
    assert rows(joined, "k", "id", "score") == sorted(
        [("x", "m1", 2), ("x", "m2", 1), ("y", None, 0), (None, None, 0)], key=repr)


def test_best_row_and_distinct_over(spark, rows):
    df = spark.createDataFrame([("a", 1, "p"), ("a", 3, "q"), ("a", 3, "p"), ("b", None, "p")], "k string, v int, t string")
    best = relational.top1(df, ["k"], [F.col("v").desc_nulls_first(), F.col("t").asc_nulls_last()])
    assert rows(best) == [("a", 3, "p"), ("b", None, "p")]
    counted = relational.with_distinct_over(df, ["k"], {"kinds": F.col("t")})
    assert {(r.k, r.kinds) for r in counted.collect()} == {("a", 2), ("b", 1)}


def test_totals(spark, rows):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 2), (dt.date(2024, 1, 1), 3), (None, 4)], "day date, v int")
    assert rows(relational.with_calendar_total(df, "day", "v", "t"), "v", "t") == [(2, 5), (3, 5), (4, 4)]
    assert {r.g for r in relational.with_grand_total(df, "v", "g").collect()} == {9}


def test_set_operations(spark, rows):
    a, b = (spark.createDataFrame([(v,) for v in values], "v int") for values in ([1, 1, 2], [2, 3]))
    assert rows(relational.union_distinct(a, b)) == [(1,), (2,), (3,)]
    assert rows(relational.union_all(a, b)) == [(1,), (1,), (2,), (2,), (3,)]
    assert rows(relational.except_distinct(a, b)) == [(1,)]
    assert rows(relational.intersect_distinct(a, b)) == [(2,)]


def test_band_aggregate_equals_all_pairs(spark, rows):
    import datetime as dt
    import random
    rnd = random.Random(4)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    right = [(rnd.choice(["a", "b", None]), rnd.choice([None, *map(day, range(-40, 90))]), rnd.choice([None, *range(9)])) for _ in range(600)]
    left = [(rnd.choice(["a", "b", "c", None]), rnd.choice([None, *map(day, range(60))])) for _ in range(80)]
    df = spark.createDataFrame(left, "k string, at date")
    events = spark.createDataFrame(right, "k string, seen date, v int")
    measures = {"total": ("sum", "v"), "low": ("min", "v"), "high": ("max", "v"), "n": ("count", "v"), "mean": ("avg", "v")}
    for first, last in ((-29, 0), (0, 0), (-3, 4), (5, 20)):
        want = []
        for k, at in left:
            vs = [v for k2, seen, v in right if k is not None and k == k2 and at and seen and first <= (seen - at).days <= last and v is not None]
            want.append((k, at, sum(vs) if vs else None, min(vs, default=None), max(vs, default=None), len(vs), sum(vs) / len(vs) if vs else None))
        assert rows(relational.band_aggregate(df, events, ["k"], "at", "seen", first, last, measures)) == sorted(want, key=repr)
    plan = relational.band_join(df, events.drop("v"), ["k"], "at", "seen", -29, 0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_first_values_hold_no_whole_group(spark, rows):
    df = spark.range(1000).selectExpr("id % 2 as k", "case when id % 5 > 0 then concat('v', lpad(id, 4, '0')) end as v", "-id as o")
    got = relational.first_values(df, ["k"], "v", 2, "some")
    assert rows(got) == [(0, "v0002,v0004"), (1, "v0001,v0003")]
    assert rows(relational.first_values(df, ["k"], "v", 2, "some", "|", [F.col("o")])) == [(0, "v0998|v0996"), (1, "v0999|v0997")]
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
