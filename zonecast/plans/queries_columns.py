"""Registered column-work and filter queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions import columns as cols
from zonecast.functions.geometry import NY_LONG_ISLAND_FTUS, lcc_inverse
from zonecast.functions.timecols import convert_time, with_calendar
from zonecast.operators import rules, standardize
from zonecast.plans import demand
from zonecast.plans.fixture_args import EXCLUDED_BOROUGHS, KEPT_BOROUGH_PATTERN
from zonecast.plans.registry import query
from zonecast.sources import fixtures as fx

# Stand-in projected coordinates for the zone vertices: the unit grid placed
# inside the city's state-plane extent, 15,000 ft per unit.
PROJ_ORIGIN = (913000.0, 120000.0)
PROJ_SCALE = 15000.0


@query("lowercase_columns")
def q_lowercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cols.lowercase_columns(fx.landing_trips_view(spark, sf_dir))


@query("drop_columns")
def q_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cols.drop_columns(fx.trips_view(spark, sf_dir),
                             standardize.TRIP_DROP + ("not_a_column",))


@query("keep_columns")
def q_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cols.keep_columns(demand.ridership_typed(spark, sf_dir),
                             ["station_id", "latitude", "longitude"])


@query("rename_columns")
def q_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cols.rename_columns(cols.lowercase_columns(fx.landing_trips_view(spark, sf_dir)),
                               standardize.TRIP_RENAMES)


@query("cast_to_schema")
def q_cast_to_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drifted month (columns reversed, passenger_count as double, the
    airport fee missing) conformed by name to the normal layout."""
    normal = cols.lowercase_columns(fx.landing_trips_view(spark, sf_dir))
    drifted = (fx.landing_trips_view(spark, sf_dir)
               .withColumn("passenger_count", F.col("passenger_count").cast("double"))
               .drop("Airport_fee"))
    drifted = drifted.select(*reversed(drifted.columns))
    return cols.cast_to_schema(drifted, normal.schema)


@query("time_features")
def q_time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_calendar(fx.pickups_view(spark, sf_dir), "pu_time")


@query("parse_timestamp")
def q_parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.ridership_text_view(spark, sf_dir).select("station_complex_id",
                                                       "transit_timestamp")
    return convert_time(raw, "transit_timestamp")


@query("recode_borough")
def q_recode_borough(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.ridership_text_view(spark, sf_dir).select("station_complex_id", "borough")
    return cols.recode_borough(raw)


@query("reproject_vertices")
def q_reproject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State-plane feet -> WGS84-style lon/lat degrees (LCC inverse)."""
    v = fx.zone_vertices_view(spark, sf_dir).select(
        "locationid", "ring", "seq",
        (F.lit(PROJ_ORIGIN[0]) + F.col("x") * PROJ_SCALE).alias("x_ft"),
        (F.lit(PROJ_ORIGIN[1]) + F.col("y") * PROJ_SCALE).alias("y_ft"))
    out = lcc_inverse(v, "x_ft", "y_ft", NY_LONG_ISLAND_FTUS)
    return out.select("locationid", "ring", "seq", F.round("lon", 9).alias("lon"),
                      F.round("lat", 9).alias("lat"))


@query("filter_time_range")
def q_filter_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.filter_time_range(fx.ridership_view(spark, sf_dir),
                                   "2024-01-08 00:00:00", "2024-01-15 00:00:00")


@query("filter_regex")
def q_filter_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.filter_regex(fx.zone_attrs_view(spark, sf_dir), "borough",
                              KEPT_BOROUGH_PATTERN)


@query("filter_exclude")
def q_filter_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.filter_exclude(fx.zone_attrs_view(spark, sf_dir), "borough",
                                EXCLUDED_BOROUGHS)
