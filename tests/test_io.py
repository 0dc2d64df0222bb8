"""Idempotent reruns, typed CSV, multi-month drift."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

import __spark_entry__ as E
from zonecast.session import scratch_path
from zonecast.sinks import writers
from zonecast.sources import files
from zonecast.sources import fixtures as fx


def test_rerun_is_idempotent(spark):
    # Writing the same month twice leaves one copy; other months stay
    out = scratch_path(spark, "t_rerun")
    df = spark.createDataFrame([(1, "2022-08"), (2, "2022-08"), (3, "2022-09")],
                               "v int, source_month string")
    writers.write_months(df, out)
    writers.write_months(df.where("source_month = '2022-08'"), out)
    back = spark.read.schema(df.schema).parquet(out)
    assert sorted(r.v for r in back.collect()) == [1, 2, 3]


def test_csv_declared_schema_malformed_is_null(spark):
    out = scratch_path(spark, "t_csv")
    src = spark.createDataFrame([("a", "12"), ("b", "12.0")], "id string, n string")
    writers.write_csv(src, out)
    schema = StructType([StructField("id", StringType()), StructField("n", IntegerType())])
    got = {r.id: r.n for r in files.read_csv_typed(spark, out, schema).collect()}
    assert got == {"a": 12, "b": None}


def test_multi_month_conform_by_name(spark):
    root = scratch_path(spark, "t_months")
    m1 = spark.createDataFrame([(1, dt.datetime(2022, 8, 3), 1.5)],
                               "VendorID long, tpep_pickup_datetime timestamp_ntz, Airport_fee double")
    # drifted month: reordered, a missing column, a retyped column
    m2 = spark.createDataFrame([(dt.datetime(2022, 9, 4), 2.0)],
                               "tpep_pickup_datetime timestamp_ntz, VendorID double")
    m1.write.parquet(f"{root}/2022-08")
    m2.write.parquet(f"{root}/2022-09")
    template = files.template_from(spark, f"{root}/2022-08")
    bounds = spark.createDataFrame([(dt.datetime(2022, 8, 3), dt.datetime(2022, 9, 4))],
                                   "lo timestamp_ntz, hi timestamp_ntz")
    man = [(r.month, r.path) for r in files.month_manifest(bounds, "lo", "hi", root).collect()]
    assert [m for m, _ in man] == ["2022-08", "2022-09"]
    out = files.read_months(spark, man, template).orderBy("source_month").collect()
    assert [(r.vendorid, r.airport_fee, r.source_month) for r in out] == \
        [(1, 1.5, "2022-08"), (2, None, "2022-09")]
    assert out[1].pu_time == dt.datetime(2022, 9, 4)


def test_template_schema_from_footer(spark, sf_small):
    # A2: schema from the footer only
    from zonecast.sources.tables import table_path, template_schema

    sch = template_schema(spark, table_path(sf_small, "orders"))
    assert [f.name for f in sch.fields][:2] == ["o_orderkey", "o_custkey"]


def test_create_only_write_refuses_existing(spark):
    # K2: default mode errors if the path exists
    import pytest
    from pyspark.errors import AnalysisException

    out = scratch_path(spark, "t_k2")
    df = spark.createDataFrame([(1,)], "v int")
    writers.write_parquet(df, out)
    with pytest.raises(AnalysisException):
        writers.write_parquet(df, out)
    writers.write_parquet(df, out, mode="overwrite")
    assert spark.read.parquet(out).count() == 1


def test_geometry_layer_round_trip(spark, sf_small):
    # K5: zones with their edge arrays and bbox survive a Parquet round trip
    from zonecast.operators import spatial
    from zonecast.sources import fixtures as fx

    shapes = spatial.zone_shapes(fx.zone_vertices_view(spark, sf_small))
    out = scratch_path(spark, "t_k5")
    writers.write_parquet(shapes, out)
    back = spark.read.parquet(out)
    assert back.schema.simpleString() == shapes.schema.simpleString()
    assert back.exceptAll(shapes).count() == 0 and back.count() == 25


def test_curate_writes_every_output(spark, sf_small):
    from zonecast.plans import demand
    from zonecast.plans.curate import curate
    from zonecast.plans.queries_io import STATION_HOUR_SCHEMA
    from zonecast.sources import fixtures as fx

    paths = curate(spark, sf_small)
    assert spark.read.text(paths["zones_geojson"]).count() == 20
    assert spark.read.parquet(paths["taxi_trips"]).agg(F.sum("pu_hourly")).first()[0] \
        == demand.clean_pickups(spark, sf_small).count()
    assert spark.read.parquet(paths["raw_trips"]).count() == fx.event_trips_view(
        spark, sf_small).count()
    assert spark.read.parquet(paths["zones"]).count() == 100      # 20 zones of 5 vertices
    csv = spark.read.option("header", True).schema(STATION_HOUR_SCHEMA).csv(paths["subway_ridership"])
    assert csv.count() > 0
    lost = spark.read.parquet(paths["ridership_problems"]).collect()
    assert {(r.column_name, r.value, r.reason) for r in lost} == {("ridership", "n/a", "not a number")}
    assert len(lost) == fx.ridership_text_view(spark, sf_small).where("ridership = 'n/a'").count()
    comb = spark.read.parquet(paths["combined"])
    direct = demand.combined(spark, sf_small)
    assert comb.select(*direct.columns).exceptAll(direct).count() == 0
    assert comb.count() == spark.read.option("header", True).csv(paths["combined_csv"]).count() \
        == direct.count()


def test_raw_typed_month_converges_to_common_types(spark):
    # landed months carry doubles for counts/codes and 'Y'/'N' text flags
    from zonecast.operators.standardize import standardize_trips, trip_template

    root = scratch_path(spark, "t_rawtypes")
    raw = spark.createDataFrame([(1.0, 2.0, "Y", 3), (None, 99.0, "N", 1)],
                                "passenger_count double, RatecodeID double, "
                                "store_and_fwd_flag string, payment_type long")
    raw.write.parquet(root)
    template = trip_template(files.template_from(spark, root))
    out = standardize_trips(spark.read.parquet(root), template)
    assert dict(out.dtypes) == {"passenger_count": "int", "ratecodeid": "int",
                                "store_and_fwd_flag": "boolean", "payment_type": "int"}
    assert sorted(out.collect(), key=lambda r: r.ratecodeid) == \
        [(1, 2, True, 3), (None, 99, False, 1)]


def test_months_that_never_landed_are_skipped(spark):
    root = scratch_path(spark, "t_gaps")
    spark.createDataFrame([(1, dt.datetime(2022, 8, 3))],
                          "VendorID long, tpep_pickup_datetime timestamp_ntz").write.parquet(f"{root}/2022-08")
    spark.createDataFrame([(3, dt.datetime(2022, 10, 9))],
                          "VendorID long, tpep_pickup_datetime timestamp_ntz").write.parquet(f"{root}/2022-10")
    bounds = spark.createDataFrame([(dt.datetime(2022, 8, 1), dt.datetime(2022, 10, 31))],
                                   "lo timestamp_ntz, hi timestamp_ntz")
    man = [(r.month, r.path) for r in files.month_manifest(bounds, "lo", "hi", root).collect()]
    assert [m for m, _ in man] == ["2022-08", "2022-09", "2022-10"]
    template = files.template_from(spark, f"{root}/2022-08")
    with pytest.raises(FileNotFoundError, match="2022-09"):
        files.read_months(spark, man, template)
    assert files.missing_months(spark, man) == ["2022-09"]
    out = files.read_months(spark, man, template, missing="skip")
    assert sorted((r.vendorid, r.source_month) for r in out.collect()) == [(1, "2022-08"), (3, "2022-10")]


def test_a_path_without_a_month_raises(spark):
    root = scratch_path(spark, "t_odd")
    spark.createDataFrame([(1,)], "VendorID long").write.parquet(f"{root}/odd")
    out = files.read_months(spark, [("2022-08", f"{root}/odd")], files.template_from(spark, f"{root}/odd"))
    with pytest.raises(Exception, match="no month in the path"):
        out.collect()


def test_large_ridership_survives_the_csv(spark):
    from zonecast.plans.queries_io import STATION_HOUR_SCHEMA

    out = scratch_path(spark, "t_large")
    df = spark.createDataFrame([("s", None, 3_000_000_000, 2024, 1, 2, 1, 3, 4)], STATION_HOUR_SCHEMA)
    writers.write_csv(df, out)
    assert files.read_csv_typed(spark, out, STATION_HOUR_SCHEMA).first().hourly_ridership == 3_000_000_000


def test_a_month_is_written_to_few_files(spark):
    import glob

    out = scratch_path(spark, "t_files")
    df = spark.range(4000).selectExpr("id", "concat('2022-0', id % 5 + 1) AS source_month").repartition(16)
    writers.write_months(df, out)
    assert len(glob.glob(out.removeprefix("file:") + "/*/part-*")) == 5
    assert spark.read.parquet(out).count() == 4000


def test_shared_dir_when_unset_uses_one_own_folder():
    from zonecast import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        master = "local[2]"

        def __init__(self):
            self.dir = None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Sess:
        conf = Conf()
        sparkContext = Ctx()

    s = Sess()
    a = session.shared_dir(s)
    assert s.sparkContext.dir == a          # registered as the checkpoint dir
    assert session.shared_dir(s) == a       # later calls agree
    cluster = Sess()
    cluster.sparkContext = Ctx()
    cluster.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(cluster)


def test_roundtrip_joins_and_groups_the_trips_once(spark, sf_small, monkeypatch):
    from zonecast.plans import queries_io

    written = []
    real = writers.write_months

    def spy(df, path, *args, **kwargs):
        real(df, path, *args, **kwargs)
        plan = df._jdf.queryExecution().executedPlan().toString()
        written.append((path, df.count(), "Join" in plan or "Exchange" in plan, kwargs.get("grouped", False)))

    monkeypatch.setattr(queries_io.writers, "write_months", spy)
    got = E.queries()["parquet_partition_roundtrip"](spark, sf_small)
    rows = fx.trips_view(spark, sf_small).count()
    month = got.where("source_month = '1998-02'").count()
    assert got.count() == rows
    assert [(n, joined, grouped) for _, n, joined, grouped in written] == [
        (rows, True, False), (rows, False, True), (rows, False, True), (month, False, True)]
    assert len({path for path, *_ in written[1:]}) == 1


def test_trips_are_not_shuffled_by_customer(spark, sf_small):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fx.trips_view(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    below = plan[plan.index("hashpartitioning(o_custkey"):].split("\n")[1:]
    kinds = [line.lstrip(" :+-") for line in below]
    first = next(k for k in kinds if k.startswith(("SortMergeJoin", "FileScan", "Scan")))
    assert "o_custkey" in first and "SortMergeJoin" not in first
