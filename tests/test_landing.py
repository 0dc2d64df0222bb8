"""What the landing stage holds."""

from pyspark.sql import functions as F

from zonecast.plans import queries_io
from zonecast.sources import fixtures as fx


def test_all_trips_land(spark, sf_small):
    """Every month of the trips, in the period or not, with all its rows."""
    root = queries_io.stage_landing_months(spark, sf_small)
    months = lambda t: {r["m"]: r["count"] for r in t.groupBy("m").count().collect()}
    landed = spark.read.schema("VendorID long, month string").parquet(root)
    trips = fx.landing_trips_view(spark, sf_small)
    want = months(trips.select(F.date_format("tpep_pickup_datetime", "yyyy-MM").alias("m")))
    assert months(landed.select(F.col("month").alias("m"))) == want
    assert min(want) < "1996-03"


def test_scratch_scope_deletes_what_it_staged_and_nothing_else(spark):
    import os

    from zonecast.plans.strategy import materialize
    from zonecast.session import scratch_path, scratch_scope

    before = scratch_path(spark, "kept")
    spark.range(3).write.parquet(before)
    with scratch_scope(spark) as folder:
        assert materialize(spark.range(5)).count() == 5 and os.path.isdir(folder)
        with scratch_scope(spark) as inner:
            spark.range(1).write.parquet(scratch_path(spark, "x"))
            assert inner.startswith(folder) and os.listdir(inner)
        assert not os.path.exists(inner) and os.path.isdir(folder)
    assert not os.path.exists(folder) and spark.read.parquet(before).count() == 3
    assert not scratch_path(spark, "y").startswith(folder)


def test_curate_leaves_only_its_outputs(spark, sf_small, tmp_path):
    import os

    from zonecast.plans.curate import curate
    from zonecast.session import shared_dir

    scratch = os.path.join(shared_dir(spark), "zonecast")
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    paths = curate(spark, sf_small, str(tmp_path / "out"))
    assert all(os.listdir(p) for p in paths.values())
    assert set(os.listdir(scratch)) == before
    zones = spark.read.parquet(paths["combined"])
    assert zones.count() == spark.read.option("header", True).csv(paths["combined_csv"]).count() > 0
