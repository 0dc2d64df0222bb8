"""P1-P10 on literal micro-fixtures: names, casts, time parsing, recodes."""

import datetime as dt

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from zonecast.functions import columns as cols
from zonecast.functions.timecols import calendar_columns, convert_time


def test_lowercase_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "Fare int, fare int")
    with pytest.raises(ValueError, match="collide"):
        cols.lowercase_columns(df)


def test_lowercase_and_rename(spark):
    df = spark.createDataFrame([(1, 2)], "VendorID int, PULocationID int")
    out = cols.rename_columns(cols.lowercase_columns(df), {"pulocationid": "zone", "x": "y"})
    assert out.columns == ["vendorid", "zone"]


def test_drop_ignores_missing_and_keep_orders(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert cols.drop_columns(df, ["b", "nope"]).columns == ["a", "c"]
    assert cols.keep_columns(df, ["c", "a"]).columns == ["c", "a"]


def test_cast_to_schema_by_name_reordered_and_drifted(spark):
    # A reordered month is cast by name; drifted type converges; a
    # missing column becomes a typed NULL; a malformed value becomes NULL
    template = StructType([StructField("passenger_count", IntegerType()),
                           StructField("fare_amount", DoubleType()),
                           StructField("airport_fee", DoubleType())])
    month = spark.createDataFrame([("7.5", 2.0), ("bad", 3.0)],
                                  "fare_amount string, passenger_count double")
    out = cols.cast_to_schema(month, template)
    assert out.schema == template
    rows = sorted(out.collect(), key=lambda r: r.passenger_count)
    assert rows[0].passenger_count == 2 and rows[0].fare_amount == 7.5
    assert rows[1].fare_amount is None
    assert all(r.airport_fee is None for r in rows)


def test_tolerant_cast_and_bad_timestamp_give_null(spark):
    df = spark.createDataFrame([("12", "01/05/2024 01:04:05 PM"), ("n/a", "13/45/2024 99:00:00 XM")],
                               "ridership string, ts string")
    out = convert_time(df.withColumn("ridership", cols.tolerant_cast("ridership", "int")), "ts")
    got = {r.ridership: r.ts for r in out.collect()}
    assert got[12] == dt.datetime(2024, 1, 5, 13, 4, 5)
    assert got[None] is None
    assert out.columns == ["ridership", "ts"]          # parsed in place


def test_recode_passes_unknown_codes_through(spark):
    df = spark.createDataFrame([("Q",), ("BK",), ("SI",), (None,)], "borough string")
    out = [r.borough for r in cols.recode_borough(df).collect()]
    assert out == ["Queens", "Brooklyn", "SI", None]


def test_calendar_parts_sunday_is_one(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 17, 30),)], "t timestamp_ntz")
    r = df.select(*[v.alias(k) for k, v in calendar_columns("t").items()]).first()
    assert (r.year, r.month, r.dayofmonth, r.dayofweek, r.hour) == (2024, 1, 7, 1, 17)


def test_hour_start_ignores_session_time_zone(spark):
    from zonecast.functions.timecols import hour_start

    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 15),)], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 is in a DST gap
        got = df.select(hour_start("t").alias("h")).first().h
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == dt.datetime(2024, 3, 10, 2, 0)
