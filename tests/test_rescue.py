"""Bad records: what casts lose, and CSV lines that do not fit."""

import pytest
from pyspark.sql import functions as F

from zonecast.operators import rescue
from zonecast.plans.strategy import materialize
from zonecast.session import scratch_path
from zonecast.sinks import writers


@pytest.mark.parametrize("cast, text, value, reason", [
    (rescue.Cast("v", "int"), "12", 12, None), (rescue.Cast("v", "int"), "12.0", 12, None),
    (rescue.Cast("v", "int"), "12.7", 12, "fraction lost"), (rescue.Cast("v", "int"), "-0.5", 0, "fraction lost"),
    (rescue.Cast("v", "int"), "n/a", None, "not a number"), (rescue.Cast("v", "int"), "3000000000", None, "out of range"),
    (rescue.Cast("v", "int"), "1e40", None, "out of range"), (rescue.Cast("v", "bigint"), "3000000000", 3000000000, None),
    (rescue.Cast("v", "int"), None, None, None), (rescue.Cast("v", "int"), "  ", None, None),
    (rescue.Cast("v", "double"), "1.5", 1.5, None), (rescue.Cast("v", "double"), "north", None, "not a number"),
    (rescue.Cast("v", "boolean"), "Y", True, None), (rescue.Cast("v", "boolean"), "maybe", None, "not a boolean"),
    (rescue.Cast("v", "date", "yyyy-MM-dd"), "2024-02-30", None, "not a timestamp"),
])
def test_reasons(spark, cast, text, value, reason):
    df = spark.createDataFrame([(1, text)], "id int, v string")
    r = rescue.cast_with_rescue(df, [cast]).first()
    assert r.v == value and [x.reason for x in r.rescued] == ([] if reason is None else [reason])
    assert all((x.column_name, x.value, x.target) == ("v", text, cast.target) for x in r.rescued)


def test_rows_and_side_table_are_written_together(spark):
    df = spark.createDataFrame([(1, "5", "x"), (2, "q", "1.5"), (3, "9999999999", "z")], "id int, a string, b string")
    typed = rescue.cast_with_rescue(df, [rescue.Cast("a", "int"), rescue.Cast("b", "double")])
    path, side = rescue.write_with_rescue(typed, scratch_path(spark, "rescue"), ["id"])
    rows = {r.id: (r.a, r.b) for r in spark.read.parquet(path).collect()}
    assert rows == {1: (5, None), 2: (None, 1.5), 3: (None, None)}
    lost = spark.read.parquet(side)
    assert {(r.id, r.column_name, r.value) for r in lost.collect()} == {
        (1, "b", "x"), (2, "a", "q"), (3, "a", "9999999999"), (3, "b", "z")}
    assert {(r.column_name, r.reason): r.n for r in rescue.problem_counts(lost).collect()} == {
        ("b", "not a number"): 2, ("a", "not a number"): 1, ("a", "out of range"): 1}
    with pytest.raises(Exception, match="(?i)exist"):
        rescue.write_with_rescue(typed, path, ["id"])


def test_nothing_lost_gives_an_empty_side_table(spark):
    typed = rescue.cast_with_rescue(spark.createDataFrame([(1, "5")], "id int, a string"), [rescue.Cast("a", "int")])
    _, side = rescue.write_with_rescue(typed, scratch_path(spark, "rescue"), ["id"])
    assert spark.read.schema(rescue.rescued_values(typed, ["id"]).schema).parquet(side).count() == 0


def test_corrupt_csv_lines_are_kept_whole(spark):
    path = scratch_path(spark, "csv")
    lines = spark.createDataFrame([("id,n,s",), ("1,5,a",), ("2,x,b",), ("3,7",), ("4,8,c,extra",), ('5,,"d,e"',)], "value string")
    lines.coalesce(1).write.text(path)
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    schema = StructType([StructField("id", IntegerType()), StructField("n", IntegerType()), StructField("s", StringType())])
    got = {r.id: (r.n, r.s, r.corrupt_record) for r in materialize(rescue.read_csv_checked(spark, path, schema)).collect()}
    assert got == {1: (5, "a", None), 2: (None, "b", "2,x,b"), 3: (7, None, "3,7"), 4: (8, "c", "4,8,c,extra"),
                   5: (None, "d,e", None)}


def test_csv_written_by_the_library_reads_back_clean(spark, sf_small):
    from zonecast.plans.queries_io import STATION_HOUR_SCHEMA
    from zonecast.plans import demand
    from zonecast.operators import combine

    rz = combine.ridership_with_zone(demand.station_hours(spark, sf_small), demand.station_zone(spark, sf_small))
    out = scratch_path(spark, "csv")
    writers.write_csv(rz.select(*[f.name for f in STATION_HOUR_SCHEMA.fields]), out)
    assert materialize(rescue.read_csv_checked(spark, out, STATION_HOUR_SCHEMA)).where(
        F.col(rescue.CORRUPT).isNotNull()).count() == 0
