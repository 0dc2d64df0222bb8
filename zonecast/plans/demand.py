"""End-to-end demand plans over the fixture views.

trips -> rules, kept zones -> (zone, hour) pickups  ----+
                                                        +-- full outer --> combined
ridership text -> typed -> period -> (station, hour) -+  |
stations -> unique -> point-in-zone ------------------+-> (zone, hour) ridership
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.operators import combine, hourly, rules, spatial, standardize
from zonecast.plans.strategy import materialize
from zonecast.plans.fixture_args import EVENT_RULES, EXCLUDED_BOROUGHS, RIDER_PERIOD
from zonecast.sources import fixtures as fx


def curated_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone attributes outside the excluded boroughs (F13): the zone set."""
    return rules.filter_exclude(fx.zone_attrs_view(spark, sf_dir), "borough",
                                EXCLUDED_BOROUGHS)


def curated_zone_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices of the kept zones only (stations are assigned to these)."""
    keep = curated_zones(spark, sf_dir).select("locationid")
    # dimension-to-dimension: no hint, the planner sizes both sides
    return fx.zone_vertices_view(spark, sf_dir).join(keep, "locationid", "left_semi")


def station_zone(spark: SparkSession, sf_dir: str, broadcast: bool | None = None,
                 keep: bool = True) -> DataFrame:
    """Stations (one row per id) with the kept zone they lie in (or NULL).

    The result is a small dimension (one row per station) joined by several
    plans; with `keep` it is materialised in the shared checkpoint folder, so
    the containment test runs once, the broadcast size check counts stored
    rows, and lineage is cut."""
    stations = combine.unique_stations(fx.stations_view(spark, sf_dir))
    shapes = spatial.zone_shapes(curated_zone_vertices(spark, sf_dir))
    out = spatial.assign_zone(stations, shapes, x="longitude", y="latitude",
                              broadcast=broadcast)
    return materialize(out) if keep else out


def ridership_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw ridership text standardised (names, tolerant casts, parsed
    timestamp, borough names)."""
    return standardize.standardize_ridership(fx.ridership_text_view(spark, sf_dir))


def ridership_in_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.filter_time_range(ridership_typed(spark, sf_dir), *RIDER_PERIOD)


def station_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 core over the standardised ridership of the period."""
    return hourly.ridership_by_station_hour(ridership_in_period(spark, sf_dir))


def ridership_zone_hours(spark: SparkSession, sf_dir: str,
                         stations: DataFrame | None = None) -> DataFrame:
    """(locationid, hour_ts, hourly_ridership) for stations in a zone,
    over the ridership period (F11). `stations` reuses an already built
    station -> zone map."""
    rid = ridership_in_period(spark, sf_dir)
    sz = stations if stations is not None else station_zone(spark, sf_dir)
    zh = hourly.zone_hour_ridership(rid, sz)
    return zh.withColumnRenamed("timestamp", "hour_ts")


def clean_pickups(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    """F10 over the trips of the ridership's month: all nine rules, both ends
    in the kept zones. `trips` reuses a landed table."""
    if trips is None:
        trips = fx.event_trips_view(spark, sf_dir)
    return rules.clean_trips(trips, curated_zones(spark, sf_dir), EVENT_RULES)


def pickup_zone_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 core over the cleaned trips: (locationid, hour_ts, pu_hourly,
    hourly_passengers)."""
    return (hourly.pickups_by_zone_hour(clean_pickups(spark, sf_dir))
            .withColumnsRenamed({"pulocationid": "locationid", "pu_hour": "hour_ts"}))


def zone_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(locationid, pu_hourly, hourly_ridership): the demand table's sums per
    zone. Each side is brought to one row per zone before both meet, so no
    zone-hours are joined."""
    pick = (clean_pickups(spark, sf_dir).groupBy(F.col("pulocationid").alias("locationid"))
            .agg(F.count("pu_time").alias("pu_hourly")))
    ride = (ridership_zone_hours(spark, sf_dir).groupBy("locationid")
            .agg(F.sum("hourly_ridership").cast("bigint").alias("hourly_ridership")))
    zero = F.lit(0).cast("bigint")
    return pick.join(ride, "locationid", "full_outer").select(
        "locationid", F.coalesce("pu_hourly", zero).alias("pu_hourly"),
        F.coalesce("hourly_ridership", zero).alias("hourly_ridership"))


def zone_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept zones as one layer: vertices with borough and zone name."""
    return curated_zone_vertices(spark, sf_dir).join(curated_zones(spark, sf_dir), "locationid")


def combined(spark: SparkSession, sf_dir: str, stations: DataFrame | None = None) -> DataFrame:
    """The flagship zone-hour demand table."""
    return combine.combined_demand(pickup_zone_hours(spark, sf_dir),
                                   ridership_zone_hours(spark, sf_dir, stations))
