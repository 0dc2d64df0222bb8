"""Registered exploration queries (G5-G12, O2, O3) over the demand table; what is
asked per zone is summed per zone before both sides are joined."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.columns import lowercase_columns, tolerant_cast
from zonecast.operators import explore, hourly, sketches
from zonecast.plans import demand
from zonecast.plans.registry import query
from zonecast.session import scratch_path
from zonecast.sinks import writers
from zonecast.sources import fixtures as fx


@query("log_pickups_by_zone")
def q_log_pickups(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = explore.log_total_by_zone(demand.zone_totals(spark, sf_dir), "pu_hourly",
                                    "total_pickups", "log_pickups")
    # math libraries may differ in the last bit
    return out.withColumn("log_pickups", F.round("log_pickups", 9))


@query("log_ridership_by_zone")
def q_log_ridership(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = explore.log_total_by_zone(demand.zone_totals(spark, sf_dir), "hourly_ridership",
                                    "total_ridership", "log_ridership")
    return out.withColumn("log_ridership", F.round("log_ridership", 9))


@query("borough_totals")
def q_borough_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.borough_totals(demand.zone_totals(spark, sf_dir),
                                  fx.zone_attrs_view(spark, sf_dir))


@query("weekday_hour_profile")
def q_weekday_hour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.weekday_hour_profile(demand.combined(spark, sf_dir))


@query("peak_hour_by_weekday")
def q_peak_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.peak_hour_by_weekday(demand.combined(spark, sf_dir))


@query("dataset_shape")
def q_dataset_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.dataset_shape({
        "trips": fx.trips_view(spark, sf_dir),
        "ridership": fx.ridership_text_view(spark, sf_dir),
        "zones": fx.zone_attrs_view(spark, sf_dir),
    })


@query("null_profile")
def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.null_profile(fx.trips_view(spark, sf_dir))


@query("constant_columns")
def q_constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.constant_columns(lowercase_columns(fx.ridership_text_view(spark, sf_dir)))


@query("transfer_subset_check")
def q_transfer_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.ridership_text_view(spark, sf_dir).select(
        tolerant_cast("transfers", "int").alias("transfers"),
        tolerant_cast("ridership", "int").alias("ridership"))
    return explore.subset_check(raw, "transfers", "ridership")


@query("hourly_pickups_sorted")
def q_hourly_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.hourly_sorted(hourly.hourly_pickups(fx.pickups_view(spark, sf_dir)))


@query("top_zones")
def q_top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.top_zones(demand.zone_totals(spark, sf_dir), k=10)


PROFILED = ("pu_time", "passenger_count", "trip_distance", "total_amount", "ratecodeid", "pulocationid",
            "store_and_fwd_flag")


@query("merged_profile")
def q_merged_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G11 from sketches: all trips profiled month by month, the months' rows
    stored, read back and merged; the estimates are held against the exact
    figures of the whole table."""
    trips = fx.trips_view(spark, sf_dir).withColumn("source_month", F.date_format("pu_time", "yyyy-MM"))
    rows = sketches.month_sketches(trips, "source_month", PROFILED)
    out = scratch_path(spark, "month_sketches")
    writers.write_months(rows, out)
    got = sketches.merged_profile(spark.read.schema(rows.schema).parquet(out), [0.5])
    # exact: distinct values, and the rows at or below the estimated median
    medians = {r["column_name"]: r["q50"] for r in got.collect()}      # one row a column
    exact = []
    for c in PROFILED:
        x = sketches.as_number(trips, c)
        exact.append(F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("distinct"),
                              F.count_if(x < medians[c]).alias("below"), F.count_if(x <= medians[c]).alias("upto")))
    held = trips.agg(F.array(*exact).alias("e")).select(F.inline("e"))
    some = F.col("n") - F.col("n_null")
    return got.join(held, "column_name").select(
        "column_name", "n", "n_null", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"),
        (F.abs(F.col("n_distinct") - F.col("distinct")) <= F.greatest(
            F.col("distinct") * sketches.DISTINCT_ERROR, F.lit(1.0))).alias("distinct_within_error"),
        ((F.col("below") <= some * (0.5 + sketches.RANK_ERROR))
         & (F.col("upto") >= some * (0.5 - sketches.RANK_ERROR))).alias("median_within_error"))
