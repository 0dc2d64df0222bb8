"""Hourly aggregation (G1-G4) and sorted output (O2).

Design: every hourly aggregate groups on (key, hour-start timestamp) -- two
shuffle keys instead of six -- and derives the five calendar parts *after* the
aggregate, once per group rather than once per input row. Partial (map-side)
aggregation runs before the shuffle, so a hot zone or station that holds a
third of all rows still ships at most one partial row per (key, hour, task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.timecols import CALENDAR_PARTS, calendar_columns, hour_start

def pickups_by_zone_hour(trips: DataFrame, zone_col: str = "pulocationid",
                         ts_col: str = "pu_time") -> DataFrame:
    """(zone, pu_hour) -> pu_hourly, hourly_passengers.

    `pu_hourly` counts trips with a pickup time (the surveyed code counts
    the derived hour column, NULL exactly when the time is NULL)."""
    return (trips.groupBy(F.col(zone_col), hour_start(ts_col).alias("pu_hour"))
            .agg(F.count(ts_col).alias("pu_hourly"),
                 F.sum("passenger_count").cast("bigint").alias("hourly_passengers")))


def hourly_pickups(trips: DataFrame, zone_col: str = "pulocationid",
                   ts_col: str = "pu_time") -> DataFrame:
    """G1: hourly pickups and passengers per zone, keyed by the six ints."""
    agg = pickups_by_zone_hour(trips, zone_col, ts_col)
    return (agg.withColumns(calendar_columns("pu_hour"))
            .select(zone_col, *CALENDAR_PARTS, "pu_hourly", "hourly_passengers"))


def ridership_by_station_hour(ridership: DataFrame) -> DataFrame:
    """(station_id, hour) -> hourly_ridership; the aggregate runs *before* any
    join to zones (push-aggregate-below-join, done by hand)."""
    return (ridership.groupBy("station_id", hour_start("timestamp").alias("timestamp"))
            .agg(F.sum("ridership").cast("bigint").alias("hourly_ridership")))


def hourly_station_ridership(ridership: DataFrame) -> DataFrame:
    """Hourly ridership per station with calendar parts."""
    return (ridership_by_station_hour(ridership)
            .withColumns(calendar_columns("timestamp")))


def hourly_zone_ridership(station_hours: DataFrame, station_zone: DataFrame) -> DataFrame:
    """Hourly ridership per zone.

    `station_hours` is G2's (station_id, timestamp, hourly_ridership);
    `station_zone` maps each station to at most one zone (NULL when in none).
    Stations without a zone are dropped here (they have no zone grain).
    Since sum is associative, station-hour partial sums roll up exactly. The
    join takes no hint: Spark knows the size of the written map and broadcasts
    it, or shuffles station hours (never raw rows)."""
    zoned = station_zone.select("station_id", "locationid").where(F.col("locationid").isNotNull())
    return (station_hours.join(zoned, "station_id")
            .groupBy("locationid", "timestamp")
            .agg(F.sum("hourly_ridership").cast("bigint").alias("hourly_ridership")))


def zone_hour_ridership(ridership: DataFrame, station_zone: DataFrame) -> DataFrame:
    """(locationid, hour) -> hourly_ridership from ridership rows: summed by
    station and hour first, so that no join moves raw rows."""
    return hourly_zone_ridership(ridership_by_station_hour(ridership), station_zone)


def distinct_stations(ridership: DataFrame) -> DataFrame:
    """Distinct (station_id, latitude, longitude)."""
    return ridership.select("station_id", "latitude", "longitude").dropDuplicates()


def hourly_sorted(hourly: DataFrame, zone_col: str = "pulocationid") -> DataFrame:
    """O2: the surveyed write order as a global sort. Spark range-partitions
    on sampled key bounds (balanced tasks at any size, no single-task sort)
    and sorts inside each range; written out, files are globally ordered."""
    return hourly.orderBy("year", "month", "dayofweek", zone_col,
                          "dayofmonth", "hour")
