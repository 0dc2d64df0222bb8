"""Registered queries over the fixture views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.timecols import calendar_columns
from zonecast.operators import combine, hourly, polygons, rules, spatial
from zonecast.plans import demand
from zonecast.plans.demand import curated_zones
from zonecast.plans.fixture_args import FIXTURE_RULES, TILE_SIZE
from zonecast.plans.registry import query
from zonecast.plans.strategy import materialize
from zonecast.sources import fixtures as fx


# --- G1: the minimum slice -------------------------------------------------

@query("hourly_pickups")
def q_hourly_pickups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.hourly_pickups(fx.pickups_view(spark, sf_dir))


# --- F1-F10: cleaning rules on trips_v ------------------------------------

def _rule_query(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rules.apply_rule(fx.trips_view(spark, sf_dir), name, FIXTURE_RULES,
                                curated_zones(spark, sf_dir))
    run.__doc__ = f"Rule '{name}' alone over the whole trips_v."
    return run


for _name in rules.RULE_ORDER:
    query(f"filter_{_name}")(_rule_query(_name))


@query("clean_trips")
def q_clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.clean_trips(fx.trips_view(spark, sf_dir),
                             curated_zones(spark, sf_dir), FIXTURE_RULES)


@query("attrition_funnel")
def q_attrition_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.attrition_funnel(fx.trips_view(spark, sf_dir),
                                  curated_zones(spark, sf_dir), FIXTURE_RULES)


@query("rule_rejections")
def q_rule_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_rejections(fx.trips_view(spark, sf_dir),
                                 curated_zones(spark, sf_dir), FIXTURE_RULES)


# --- spatial (A8, P11, J4) --------------------------------------------------

@query("polygon_edges")
def q_polygon_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.polygon_edges(fx.zone_vertices_view(spark, sf_dir))


@query("station_points")
def q_station_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts = spatial.point_tiles(fx.stations_view(spark, sf_dir), "longitude", "latitude",
                              TILE_SIZE)
    return pts.select("station_id", F.col("point.lon").alias("lon"),
                      F.col("point.lat").alias("lat"), "tx", "ty")


@query("point_in_zone")
def q_point_in_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer point with the zone (of all 25) containing it, or NULL."""
    shapes = spatial.zone_shapes(fx.zone_vertices_view(spark, sf_dir))
    return spatial.assign_zone(fx.customer_points_view(spark, sf_dir), shapes,
                               x="lon", y="lat")


# --- zones of several parts (A8, J4) ----------------------------------------

@query("polygon_parts")
def q_polygon_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rings of the multipart zones are shells and which holes, and of
    which part."""
    parts = polygons.ring_parts(fx.multipart_vertices_view(spark, sf_dir))
    return parts.select("locationid", "ring", "part", "hole", "depth", F.round("area", 9).alias("area"))


@query("point_in_multipart_zone")
def q_point_in_multipart_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer point with the multipart zone that holds it, or NULL;
    the points and the leaves are shuffled."""
    shapes = spatial.zone_shapes(fx.multipart_vertices_view(spark, sf_dir))
    return spatial.assign_zone(fx.customer_points_view(spark, sf_dir), shapes, broadcast=False,
                               max_edges=16)


@query("polygon_wkt_edges")
def q_polygon_wkt_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The multipart zones as WKT texts, written, read back and cut into
    edges."""
    layer = materialize(polygons.to_wkt(fx.multipart_vertices_view(spark, sf_dir)), "zones-wkt")
    vertices = polygons.wkt_vertices(polygons.read_wkt(layer))
    return spatial.polygon_edges(vertices).select(
        "locationid", *[F.round(c, 9).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query("wkt_problems")
def q_wkt_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with the texts of a layer of which some are damaged."""
    return polygons.read_wkt(fx.wkt_text_view(spark, sf_dir)).select(
        "locationid", "problem", F.size("polygons").alias("n_parts"))


@query("station_zone")
def q_station_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations with the kept zone they lie in (NULL when in none)."""
    return demand.station_zone(spark, sf_dir)


# --- G2-G4, J1-J3, J6 -------------------------------------------------------

@query("hourly_station_ridership")
def q_hourly_station_ridership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.hourly_station_ridership(demand.ridership_in_period(spark, sf_dir))


@query("hourly_zone_ridership")
def q_hourly_zone_ridership(spark: SparkSession, sf_dir: str) -> DataFrame:
    zh = demand.ridership_zone_hours(spark, sf_dir)
    return zh.withColumns(calendar_columns("hour_ts")).drop("hour_ts")


@query("distinct_stations")
def q_distinct_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 on the typed raw ridership rows (one row per reading)."""
    raw = demand.ridership_typed(spark, sf_dir)
    return hourly.distinct_stations(raw)


@query("station_zone_attrs")
def q_station_zone_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine.station_zone_attrs(demand.station_zone(spark, sf_dir),
                                      fx.zone_attrs_view(spark, sf_dir))


@query("ridership_with_zone")
def q_ridership_with_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine.ridership_with_zone(demand.station_hours(spark, sf_dir),
                                       demand.station_zone(spark, sf_dir))


@query("combined_demand")
def q_combined_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.combined(spark, sf_dir)


@query("zones_without_ridership")
def q_zones_without_ridership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine.zones_without_ridership(demand.pickup_zone_hours(spark, sf_dir),
                                           demand.ridership_zone_hours(spark, sf_dir))
