"""Registered source/sink round-trip queries.

Round trips write under the session's shared folder (`spark.checkpoint.dir`)
in a fresh sub-folder per call, then read back with the library's readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from zonecast.functions.timecols import RIDERSHIP_TS_FORMAT
from zonecast.operators import combine, hourly, polygons, rescue, rules, standardize
from zonecast.plans import demand
from zonecast.plans.fixture_args import FIXTURE_RULES
from zonecast.plans.registry import query
from zonecast.plans.strategy import materialize
from zonecast.session import scratch_path
from zonecast.sinks import clustered, commits, writers
from zonecast.sources import files
from zonecast.sources import fixtures as fx
from zonecast.sources.tables import read_table, table_path, template_schema

# Landed months given drifted layouts in the multi-month stage.
REORDERED_MONTH = "1997-01"      # same columns, reversed order
RETYPED_MONTH = "1998-06"        # passenger_count as double, airport fee missing

# The columns of the station-hour ridership CSV (A6), with the
# types that the library writes.
STATION_HOUR_SCHEMA = StructType([
    StructField("station_id", StringType(), True),
    StructField("timestamp", TimestampNTZType(), True),
    StructField("hourly_ridership", LongType(), True),
    StructField("year", IntegerType(), True),
    StructField("dayofmonth", IntegerType(), True),
    StructField("dayofweek", IntegerType(), True),
    StructField("month", IntegerType(), True),
    StructField("hour", IntegerType(), True),
    StructField("locationid", LongType(), True),
])


@query("scan_parquet")
def q_scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: a whole table, all columns."""
    return read_table(spark, sf_dir, "events")


@query("schema_template")
def q_schema_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: names and types from the footer alone; the table is then scanned
    with that schema, and the values of each column are counted."""
    path = table_path(sf_dir, "orders")
    schema = template_schema(spark, path)
    row = spark.read.schema(schema).parquet(path).agg(
        *[F.count(f.name).alias(f"n{i}") for i, f in enumerate(schema.fields)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("type_name"),
                 F.col(f"n{i}").alias("n_values"))
        for i, f in enumerate(schema.fields)])))


@query("parquet_create")
def q_parquet_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: all trips written once (create-only) and read with the schema of
    the written footer."""
    out = scratch_path(spark, "created_trips")
    writers.write_parquet(fx.trips_view(spark, sf_dir), out)
    return spark.read.schema(template_schema(spark, out)).parquet(out)


@query("zone_layer")
def q_zone_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the layer of the kept zones written and read back."""
    layer = demand.zone_layer(spark, sf_dir)
    out = scratch_path(spark, "zone_layer")
    writers.write_parquet(layer, out)
    return spark.read.schema(layer.schema).parquet(out)


@query("station_layer")
def q_station_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the layer of the stations, with their zones, written and read back."""
    layer = demand.station_zone(spark, sf_dir)
    out = scratch_path(spark, "station_layer")
    writers.write_parquet(layer, out)
    return spark.read.schema(layer.schema).parquet(out)


def _period_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.filter_time_range(fx.trips_view(spark, sf_dir), FIXTURE_RULES.period_start,
                                   FIXTURE_RULES.period_end, ts_col="pu_time")


def stage_landing_months(spark: SparkSession, sf_dir: str) -> str:
    """Land all trips as one folder per pickup month (landing names), two
    months with drifted layouts. Returns the landing root.

    One pass over the trips lands all months; the two drifted ones are then
    rewritten from their landed files."""
    root = scratch_path(spark, "landing")
    landing = fx.landing_trips_view(spark, sf_dir).withColumn(
        "month", F.date_format("tpep_pickup_datetime", "yyyy-MM"))
    writers.write_months(landing, root, "month")
    landed = spark.read.schema(landing.schema).parquet(root)

    def one_month(m: str) -> DataFrame:
        # a folder is not overwritten while it is read
        return materialize(landed.where(F.col("month") == m), "month")

    reordered = one_month(REORDERED_MONTH)
    cols = [c for c in reordered.columns if c != "month"]
    writers.write_months(reordered.select(*reversed(cols), "month"), root, "month")
    writers.write_months(one_month(RETYPED_MONTH)
                         .withColumn("passenger_count", F.col("passenger_count").cast("double"))
                         .drop("Airport_fee"), root, "month")
    return root


@query("month_manifest")
def q_month_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: months spanned by the period's pickups, with their landing paths."""
    bounds = _period_trips(spark, sf_dir).agg(
        F.min("pu_time").alias("lo"), F.max("pu_time").alias("hi"))
    return files.month_manifest(bounds, "lo", "hi", "landing", prefix="month=")


@query("scan_multi_month")
def q_scan_multi_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all trips by month (two months drifted); build
    the A4 manifest of the period's months (one candidate folder per month,
    no listing of the landing root); read every month that landed: conformed
    by name to the common schema (one normal month's footer with the count,
    code and flag types set), tagged with source_month, unioned."""
    root = stage_landing_months(spark, sf_dir)
    bounds = spark.createDataFrame(
        [(FIXTURE_RULES.period_start, FIXTURE_RULES.period_end)], "lo string, hi string")
    manifest = files.month_manifest(
        bounds, F.to_date("lo"), F.date_sub(F.to_date("hi"), 1), root, prefix="month=")
    # the manifest is metadata (one row per month) needed at planning time
    paths = [(r["month"], r["path"]) for r in manifest.collect()]
    normal = next(p for m, p in paths if m not in (REORDERED_MONTH, RETYPED_MONTH))
    template = standardize.trip_template(files.template_from(spark, normal))
    return files.read_months(spark, paths, template)


@query("parquet_partition_roundtrip")
def q_parquet_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: write by source month twice (the rerun replaces, never appends),
    then rewrite one month alone; read everything back.

    The trips are joined and brought together by month once, into landed
    files; the three writes take them from there without a shuffle."""
    t = fx.trips_view(spark, sf_dir).withColumn(
        "source_month", F.date_format("pu_time", "yyyy-MM"))
    landing = scratch_path(spark, "landed_trips")
    writers.write_months(t, landing)
    landed = spark.read.schema(t.schema).parquet(landing)
    out = scratch_path(spark, "raw_trips")
    writers.write_months(landed, out, grouped=True)
    writers.write_months(landed, out, grouped=True)
    writers.write_months(landed.where(F.col("source_month") == "1998-02"), out, grouped=True)
    return spark.read.schema(t.schema).parquet(out)


@query("year_split")
def q_year_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 + F14: hourly pickups of the clean trips written by year, one
    year read back (partition-pruned)."""
    clean = rules.clean_trips(fx.trips_view(spark, sf_dir), demand.curated_zones(spark, sf_dir),
                              FIXTURE_RULES)
    hp = hourly.hourly_pickups(clean)
    out = scratch_path(spark, "hourly_by_year")
    writers.write_by_year(hp, out)
    return rules.year_slice(spark.read.schema(hp.schema).parquet(out), 1997)


@query("csv_strings_cast")
def q_csv_strings_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + P5/P8/P10: raw ridership through CSV text and back, standardised."""
    out = scratch_path(spark, "ridership_csv")
    writers.write_csv(fx.ridership_text_view(spark, sf_dir), out)
    return standardize.standardize_ridership(files.read_csv_text(spark, out))


@query("csv_typed_roundtrip")
def q_csv_typed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + A6: station-hour ridership with zone to CSV, read back with the
    declared schema."""
    rz = combine.ridership_with_zone(demand.station_hours(spark, sf_dir),
                                     demand.station_zone(spark, sf_dir))
    out = scratch_path(spark, "station_hours_csv")
    writers.write_csv(rz.select(*[f.name for f in STATION_HOUR_SCHEMA.fields]), out)
    return files.read_csv_typed(spark, out, STATION_HOUR_SCHEMA)


@query("zone_geojson")
def q_zone_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: kept zones as GeoJSON lines (one feature per line, encoded once),
    read back and checked field by field."""
    feats = polygons.zone_features(demand.curated_zone_vertices(spark, sf_dir),
                                   demand.curated_zones(spark, sf_dir))
    out = scratch_path(spark, "zones_geojson")
    writers.write_lines(feats, "feature", out)
    parsed = polygons.parse_features(spark.read.text(out))
    ring = F.col("coordinates")[0]
    return parsed.select(
        "locationid", "borough", "zone", "feature_type", "geometry_type",
        F.size("coordinates").alias("n_rings"), F.size(ring).alias("n_points"),
        F.round(F.aggregate(ring, F.lit(0.0), lambda a, p: a + p[0]), 9).alias("x_sum"),
        F.round(F.aggregate(ring, F.lit(0.0), lambda a, p: a + p[1]), 9).alias("y_sum"))


@query("multipart_geojson")
def q_multipart_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 on zones of several parts with holes: one row per ring of the
    features read back; ring 0 of a part is its shell. Areas tell the
    direction: shells run counter-clockwise, holes clockwise."""
    feats = polygons.zone_features(fx.multipart_vertices_view(spark, sf_dir),
                                   fx.zone_attrs_view(spark, sf_dir))
    out = scratch_path(spark, "multipart_geojson")
    writers.write_lines(feats, "feature", out)
    parsed = polygons.parse_features(spark.read.text(out))
    rows = (parsed.select("locationid", "borough", "zone", "geometry_type", F.posexplode("polygons").alias("part", "p"))
            .select("*", F.posexplode("p").alias("place", "r")))
    twice = F.aggregate(F.sequence(F.lit(0), F.size("r") - 2), F.lit(0.0), lambda a, i: a + (
        F.get("r", i)[0] * F.get("r", i + 1)[1] - F.get("r", i + 1)[0] * F.get("r", i)[1]))
    closed = (F.col("r")[0][0] == F.element_at("r", -1)[0]) & (F.col("r")[0][1] == F.element_at("r", -1)[1])
    return rows.select("locationid", "borough", "zone", "geometry_type", "part", "place",
                       F.size("r").alias("n_points"), closed.alias("closed"), F.round(twice / 2, 9).alias("area"))


# --- bad records (A5, A6, P5) -------------------------------------------------

RIDERSHIP_CASTS = (rescue.Cast("transit_timestamp", "timestamp_ntz", RIDERSHIP_TS_FORMAT),
                   rescue.Cast("ridership", "int"), rescue.Cast("latitude", "double"))


def _rescued_ridership(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Typed rows and lost values of the damaged ridership feed, written side
    by side and read back."""
    typed = rescue.cast_with_rescue(fx.damaged_ridership_view(spark, sf_dir), RIDERSHIP_CASTS)
    out, side = rescue.write_with_rescue(typed, scratch_path(spark, "typed_ridership"), ["event_id"])
    lost = rescue.rescued_values(typed, ["event_id"])
    return spark.read.schema(typed.schema).parquet(out), spark.read.schema(lost.schema).parquet(side)


@query("rescued_values")
def q_rescued_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: each value of the feed that a cast lost or changed, and why."""
    return _rescued_ridership(spark, sf_dir)[1]


@query("cast_problem_counts")
def q_cast_problem_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counted by column and reason, beside the column's NULLs in the
    typed rows."""
    typed, lost = _rescued_ridership(spark, sf_dir)
    nulls = typed.agg(*[F.count_if(F.col(c.column).isNull()).alias(c.column) for c in RIDERSHIP_CASTS])
    nulls = nulls.select(F.inline(F.array(*[F.struct(F.lit(c.column).alias("column_name"), F.col(c.column).alias("n_null"))
                                            for c in RIDERSHIP_CASTS])))
    return rescue.problem_counts(lost).join(nulls, "column_name")


@query("csv_corrupt_records")
def q_csv_corrupt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged feed as CSV, read with a declared schema: the lines
    that do not fit it, whole, with what could be read of them."""
    out = scratch_path(spark, "damaged_csv")
    feed = fx.damaged_ridership_view(spark, sf_dir).select("event_id", "ridership", "latitude")
    writers.write_csv(feed, out)
    schema = StructType([StructField("event_id", LongType()), StructField("ridership", IntegerType()),
                         StructField("latitude", StringType())])
    read = materialize(rescue.read_csv_checked(spark, out, schema), "checked_csv")
    return read.where(F.col(rescue.CORRUPT).isNotNull()).select(
        "event_id", "ridership", "latitude", F.col(rescue.CORRUPT).alias("line"))


# --- clustered layout, month commits (O2, K4, K1) -------------------------------

def clustered_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of the demand join, written in buckets by its keys."""
    keys = ["locationid", "hour_ts"]
    picked = clustered.write_clustered(demand.pickup_zone_hours(spark, sf_dir),
                                       scratch_path(spark, "clustered_pickups"), keys)
    ridden = clustered.write_clustered(demand.ridership_zone_hours(spark, sf_dir),
                                       scratch_path(spark, "clustered_ridership"), keys)
    return clustered.read_clustered(spark, picked), clustered.read_clustered(spark, ridden)


@query("combined_from_clustered")
def q_combined_from_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2 / K4 + J3: the demand table from clustered sides, without an
    exchange."""
    return combine.combined_demand(*clustered_sides(spark, sf_dir))


# Fixed value: the month whose trips change between two commits.
CHANGED_MONTH = "1998-02"


def committed_trips(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, list[commits.Commit]]:
    """All trips committed by month; committed again as they are; and once
    more after the changed month lost its trips of more than six items."""
    trips = materialize(fx.trips_view(spark, sf_dir).withColumn(
        "source_month", F.date_format("pu_time", "yyyy-MM")), "landed_trips")
    root = scratch_path(spark, "committed_trips")
    changed = trips.where((F.col("source_month") != CHANGED_MONTH)
                          | (F.coalesce("passenger_count", F.lit(0)) <= 6))
    done = [commits.commit_months(trips, root), commits.commit_months(trips.orderBy("pu_time"), root),
            commits.commit_months(changed, root)]
    return root, trips, done


@query("month_commits")
def q_month_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: what is seen of each month, and how often it was written."""
    root, _, _ = committed_trips(spark, sf_dir)
    return commits.manifest(spark, root).select("month", "n_rows", "number", "n_commits")


@query("read_committed_months")
def q_read_committed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the trips of all committed months, each in its last version."""
    root, trips, _ = committed_trips(spark, sf_dir)
    return commits.read_months(spark, root, trips.schema)
