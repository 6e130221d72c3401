import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import aggregates, dates, keys, scalars, sqludf
from ledgerloom.functions.types import portable_type


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def d(text):
    return F.lit(text).cast("date")


def test_surrogate_key_uses_text_dash_and_placeholder(spark):
    expected = hashlib.md5(b"A-2024-01-05-_dbt_utils_surrogate_key_null_").hexdigest()
    assert one(spark, keys.surrogate_key(F.lit("A"), d("2024-01-05"), F.lit(None))) == expected
    assert one(spark, keys.scd_hash(F.lit("A"), F.lit(None))) == hashlib.md5(b"A|").hexdigest()
    assert one(spark, keys.prefixed("P:", F.lit(None))) is None


@pytest.mark.parametrize("part, a, b, want", [
    ("month", "2024-01-31", "2024-02-01", 1), ("month", "2024-02-01", "2024-01-31", -1),
    ("year", "2023-12-31", "2024-01-01", 1), ("quarter", "2024-03-31", "2024-04-01", 1),
    ("week", "2024-02-18", "2024-02-19", 1), ("week", "2024-02-19", "2024-02-25", 0),
    ("day", "2024-02-28", "2024-03-01", 2)])
def test_differences_count_boundaries_of_days(spark, part, a, b, want):
    assert one(spark, dates.date_diff(part, d(a), d(b))) == want


def test_day_difference_of_timestamps_is_calendar(spark):
    late, early = F.lit("2024-01-01 23:59:00").cast("timestamp_ntz"), F.lit("2024-01-02 00:01:00").cast("timestamp_ntz")
    assert one(spark, dates.day_diff(late, early)) == 1


def test_truncation_keeps_dates(spark):
    assert one(spark, dates.trunc_date("quarter", d("2024-05-17"))) == dt.date(2024, 4, 1)
    assert one(spark, dates.last_day_of("quarter", d("2024-05-17"))) == dt.date(2024, 6, 30)
    assert one(spark, dates.date_add_part("month", 1, d("2024-01-31"))) == dt.date(2024, 2, 29)


def test_unparsable_dates_are_null(spark):
    assert one(spark, dates.try_date(F.lit("2024-13-01"))) is None
    assert one(spark, dates.try_timestamp(F.lit("2024-04-03T01:02:03.370Z"))) == dt.datetime(2024, 4, 3, 1, 2, 3, 370000)


def test_spines(spark, rows):
    assert rows(dates.date_spine(spark, "day", "2024-01-30", "2024-02-02")) == [
        (dt.date(2024, 1, 30),), (dt.date(2024, 1, 31),), (dt.date(2024, 2, 1),)]
    assert rows(dates.date_spine(spark, "month", "2024-01-15", "2024-03-10")) == [
        (dt.date(2024, 1, 15),), (dt.date(2024, 2, 15),)]
    assert dates.date_spine(spark, "day", "2024-02-02", "2024-02-02").count() == 0
    spine = [r[0] for r in dates.trailing_days(spark, "2024-03-01", 121).collect()]
    assert len(spine) == 121 and max(spine) == dt.date(2024, 3, 1) and min(spine) == dt.date(2023, 11, 2)
    assert [r[0] for r in dates.partition_range(spark, "20240228,20240301").collect()] == [
        "20240228", "20240229", "20240301"]
    with pytest.raises(ValueError):
        dates.partition_range(spark, "1,2,3")
    with pytest.raises(Exception, match="after the end"):
        dates.dates_in_range(spark, "20240302", "20240301").collect()
    assert [r[0] for r in dates.number_series(spark, 3).collect()] == [1, 2, 3]
    with pytest.raises(ValueError):
        dates.number_series(spark, 0)


def test_null_strict_extremes_and_clamp(spark):
    null = F.lit(None).cast("int")
    assert one(spark, scalars.least_or_null(null, F.lit(100))) is None
    assert one(spark, scalars.greatest_or_null(F.lit(3), F.lit(100))) == 100
    assert one(spark, scalars.clamp(F.lit(140), 0, 100)) == 100
    assert one(spark, scalars.clamp(null, 0, 100)) is None


def test_text_helpers(spark):
    assert one(spark, scalars.split_part(F.lit("a-b-c"), "-", -2)) == "b"
    assert one(spark, scalars.right_text(F.lit("abc"), 0)) == ""
    assert one(spark, scalars.position("z", F.lit("abc"))) == 0
    assert one(spark, scalars.contains_any_ci(F.lit("Plan UPGRADE"), ["purchase", "upgrade"])) is True
    assert one(spark, scalars.safe_cast(F.lit("x"), "int")) is None
    assert one(spark, scalars.equals(F.lit(None), F.lit(None), null_safe=True)) is True
    assert one(spark, scalars.equals(F.lit(None), F.lit(1))) is None
    assert scalars.escape_single_quotes("it's") == "it''s"
    assert one(spark, scalars.ratio(F.lit(1), F.lit(0))) is None


def test_aggregates(spark):
    df = spark.createDataFrame([("b", 1, 2.0), ("a", 3, 4.0), (None, 0, 9.0)], "k string, w int, v double")
    row = df.agg(aggregates.list_agg("k").alias("l"), aggregates.list_agg("k", "|", True, 1).alias("top"),
                 aggregates.weighted_avg("w", "v").alias("avg"),
                 aggregates.sum_where(F.col("w") > 1, "w").alias("s")).first()
    assert (row.l, row.top, row.avg, row.s) == ("a,b", "b", 3.5, 3)
    by = df.agg(aggregates.list_agg("k", order_by="w").alias("up"), aggregates.list_agg("k", order_by="w", descending=True).alias("down")).first()
    assert (by.up, by.down) == ("b,a", "a,b")
    assert df.filter("k = 'none'").agg(aggregates.list_agg("k").alias("l")).first().l is None


def test_sql_function_and_types(spark):
    sqludf.register_sql_function(spark, "gross", {"net": "DOUBLE"}, "DOUBLE", "net * 1.2")
    assert spark.sql("select gross(10.0D) as x").first().x == pytest.approx(12.0)
    assert portable_type("numeric").simpleString() == "decimal(28,6)"
    assert sqludf.schema_for(None, "public") == "PUBLIC" and sqludf.schema_for("marts", "public") == "MARTS"


@pytest.mark.parametrize("part, want", [("hour", 1), ("minute", 1), ("second", 2)])
def test_parts_below_a_day(spark, part, want):
    a, b = F.lit(dt.datetime(2024, 3, 31, 0, 59, 59)), F.lit(dt.datetime(2024, 3, 31, 1, 0, 1))
    assert one(spark, dates.date_diff(part, a, b)) == want
    assert one(spark, dates.date_diff(part, b, a)) == -want
    assert one(spark, dates.date_add_part("second", 2, a)) == dt.datetime(2024, 3, 31, 1, 0, 1)
