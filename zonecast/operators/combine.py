"""Joins between the station, zone and hourly tables.

The combined table (J3) is a full outer join of two zone-hour aggregates on
(locationid, hour). Both inputs come out of hash aggregates keyed on exactly
those two columns, so the sort-merge join reuses their shuffle partitioning:
no extra exchange is planned for the join itself. Each key is unique on each
side, so a hot zone cannot skew the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.timecols import CALENDAR_PARTS, calendar_columns
from zonecast.plans.strategy import join_small

STATION_MAX_ROWS = 5_000_000
ZONE_MAX_ROWS = 1_000_000

COMBINED_COLUMNS = ("locationid",) + CALENDAR_PARTS + (
    "pu_hourly", "hourly_passengers", "hourly_ridership")


def unique_stations(stations: DataFrame) -> DataFrame:
    """One row per station id (its lowest latitude, then longitude), so a
    station reported with two coordinates cannot double its ridership."""
    return (stations.groupBy("station_id")
            .agg(F.min(F.struct("latitude", "longitude")).alias("p"))
            .select("station_id", F.col("p.latitude").alias("latitude"),
                    F.col("p.longitude").alias("longitude")))


def station_zone_attrs(station_zone: DataFrame, zone_attrs: DataFrame) -> DataFrame:
    """Stations with their zone's attributes (left join: NULL when the
    station lies in no zone)."""
    return join_small(station_zone, zone_attrs.select("locationid", "borough", "zone"),
                      "locationid", "left", ZONE_MAX_ROWS)


def ridership_with_zone(station_hours: DataFrame, station_zone: DataFrame) -> DataFrame:
    """Station-hour ridership with the station's zone (left join; NULL
    zone when the station is in no zone). `station_zone` must be unique per
    station (see `unique_stations`)."""
    out = join_small(station_hours, station_zone.select("station_id", "locationid"),
                     "station_id", "left", STATION_MAX_ROWS)
    return out.withColumns(calendar_columns("timestamp"))


def combined_demand(pickups_zh: DataFrame, ridership_zh: DataFrame) -> DataFrame:
    """Full outer join of (locationid, hour) pickups and ridership; the
    join keys coalesce (USING form), the calendar parts are derived from the
    hour, and missing measures become 0 (a zone-hour with no trips or no
    riders reads as zero, as in the surveyed code).

    pickups_zh: (locationid, hour_ts, pu_hourly, hourly_passengers)
    ridership_zh: (locationid, hour_ts, hourly_ridership)
    """
    j = pickups_zh.join(ridership_zh, ["locationid", "hour_ts"], "full_outer")
    return (j.withColumns(calendar_columns("hour_ts"))
            .select(*COMBINED_COLUMNS)
            .na.fill(0, ["pu_hourly", "hourly_passengers", "hourly_ridership"]))


def zones_without_ridership(pickups_zh: DataFrame, ridership_zh: DataFrame) -> DataFrame:
    """Zones with pickups but no ridership in any hour (anti join on
    the distinct zone ids of each side).

    Both sides are aggregates of large inputs, so no eager size check (it
    would compute them twice): no hint is given and AQE picks a broadcast
    from the measured size of the finished aggregate stage, or keeps the
    sort-merge join beyond its threshold."""
    pz = pickups_zh.groupBy("locationid").agg(F.sum("pu_hourly").alias("pickups"))
    rz = ridership_zh.select("locationid").distinct()
    return pz.join(rz, "locationid", "left_anti")
