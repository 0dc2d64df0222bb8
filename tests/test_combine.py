"""Invariants over the demand plan and the planted duplicate station."""

import datetime as dt
import os

import __spark_entry__ as E
from pyspark.sql import functions as F

from zonecast.operators import combine, hourly
from zonecast.plans import demand
from zonecast.sources import fixtures as fx


def test_duplicate_station_does_not_double(spark):
    # One station id reported with two coordinates
    stations = spark.createDataFrame([("s1", 1.0, 1.0), ("s1", 1.5, 1.0), ("s2", 5.0, 5.0)],
                                     "station_id string, latitude double, longitude double")
    u = combine.unique_stations(stations)
    assert u.count() == 2
    assert u.where("station_id = 's1'").first().latitude == 1.0
    sz = u.withColumn("locationid", F.when(F.col("station_id") == "s1", F.lit(7)).cast("bigint"))
    hours = spark.createDataFrame([("s1", dt.datetime(2024, 1, 1, 5), 10)],
                                  "station_id string, timestamp timestamp_ntz, hourly_ridership bigint")
    z = hourly.hourly_zone_ridership(hours, sz).collect()
    assert [(r.locationid, r.hourly_ridership) for r in z] == [(7, 10)]


def test_sum_invariants(spark, sf_small):
    pick = demand.clean_pickups(spark, sf_small)
    assert 0 < pick.count() < fx.event_trips_view(spark, sf_small).count()
    g1 = hourly.hourly_pickups(pick)
    assert g1.agg(F.sum("pu_hourly")).first()[0] == pick.count()
    comb = demand.combined(spark, sf_small)
    zh_r = demand.ridership_zone_hours(spark, sf_small)
    assert comb.agg(F.sum("hourly_ridership")).first()[0] == \
        zh_r.agg(F.sum("hourly_ridership")).first()[0]
    assert comb.agg(F.sum("pu_hourly")).first()[0] == pick.count()
    keys_p = demand.pickup_zone_hours(spark, sf_small).select("locationid", "hour_ts")
    keys_r = zh_r.select("locationid", "hour_ts")
    assert comb.count() == keys_p.union(keys_r).distinct().count()
    assert comb.where(F.col("locationid").isNull()).count() == 0


def test_full_outer_join_reuses_aggregate_partitioning(spark, sf_small):
    plan = demand.combined(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    lines = plan[plan.index("SortMergeJoin"):].split("\n")
    assert "FullOuter" in lines[0]
    # each side of the join: Sort directly on the final HashAggregate, i.e. the
    # join reuses the aggregate's hash partitioning instead of a new exchange
    sorts = [i for i, line in enumerate(lines) if line.lstrip(" :+-").startswith("Sort [")]
    assert len(sorts) >= 2
    for i in sorts[:2]:
        assert lines[i + 1].lstrip(" :+-").startswith("HashAggregate")


def test_ridership_with_zone_keeps_unmatched(spark, sf_small):
    rz = combine.ridership_with_zone(demand.station_hours(spark, sf_small),
                                     demand.station_zone(spark, sf_small))
    assert rz.count() == demand.station_hours(spark, sf_small).count()
    assert rz.where(F.col("locationid").isNull()).count() > 0


def test_hourly_pickups_of_clean_trips_sum_to_clean_rows(spark, sf_small):
    from zonecast.operators import rules
    from zonecast.plans.fixture_args import FIXTURE_RULES

    clean = rules.clean_trips(fx.trips_view(spark, sf_small), demand.curated_zones(spark, sf_small),
                              FIXTURE_RULES)
    hp = hourly.hourly_pickups(clean)
    assert hp.agg(F.sum("pu_hourly")).first()[0] == clean.count() == 428   # FIXTURES sf0.001


def test_zones_without_ridership_looks_at_the_whole_month(spark, sf_small, tmp_path):
    # one zone loses all its riders, another those of the month's first six hours
    sz = demand.station_zone(spark, sf_small).where("locationid is not null")
    picked = demand.pickup_zone_hours(spark, sf_small).select("locationid").distinct()
    ridden = demand.ridership_zone_hours(spark, sf_small).where("hour_ts >= '2024-01-01 06:00:00'")
    zones = [r[0] for r in picked.join(ridden, "locationid").select("locationid").distinct()
             .orderBy("locationid").limit(2).collect()]
    silent, late = zones
    stations = {z: [r[0] for r in sz.where(F.col("locationid") == z).select("station_id").collect()]
                for z in zones}
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    rider = F.col("event_type").isin(fx.RIDER_EVENT_TYPES)
    user = F.col("user_id").cast("string")
    gone = rider & (user.isin(stations[silent])
                    | (user.isin(stations[late]) & (F.col("ts") < F.lit("2024-01-01 06:00:00"))))
    for t in os.listdir(sf_small):
        if t != "events.parquet":
            os.symlink(f"{sf_small}/{t}", tmp_path / t)
    events.where(~gone).write.parquet(str(tmp_path / "events.parquet"))
    got = {r.locationid: r.pickups for r in
           E.queries()["zones_without_ridership"](spark, str(tmp_path)).collect()}
    want = (demand.pickup_zone_hours(spark, sf_small).where(F.col("locationid") == silent)
            .agg(F.sum("pu_hourly")).first()[0])
    assert got.get(silent) == want
    assert late not in got
