"""End-to-end curation: every curated output of the demand workload in one
run, written under one folder (the counterpart of a preprocessing script).

    python -m zonecast.plans.curate <sf_dir> [out_dir]

Outputs (out_dir defaults to a fresh folder under `spark.checkpoint.dir`):
  zones/, stations/  the zone layer and the stations with their zones (K5)
  zones_geojson/     kept zones, one GeoJSON feature per line        (K6)
  raw_trips/         the trips as landed, by source month            (K1)
  taxi_trips/        hourly pickups of the clean trips, by year      (F10, G1, K4)
  subway_ridership/  station-hour ridership with zone, CSV           (G2, J2, K3)
  ridership_problems/  values of the raw ridership that a cast lost    (P5)
  combined_csv/      the zone-hour demand table, CSV                 (J3, K3)
  combined/          the same table, Parquet partitioned by year     (K4, M2)

Each step reads what the step before it wrote: the trips are cleaned from the
landed months, and the demand table joins the written hourly pickups with the
written station hours rolled up to zones. Nothing passes through the driver.
Writes overwrite (reruns replace their output).
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from zonecast.operators import combine, hourly, polygons, rescue, rules
from zonecast.plans import demand
from zonecast.plans.fixture_args import EVENT_RULES
from zonecast.plans.queries_io import RIDERSHIP_CASTS, STATION_HOUR_SCHEMA
from zonecast.session import scratch_path, scratch_scope
from zonecast.sinks import writers
from zonecast.sources import files
from zonecast.sources import fixtures as fx


def curate(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
           trip_rules: rules.TripRules = EVENT_RULES) -> dict[str, str]:
    """Write every curated output; returns {name: path}."""
    out = out_dir or scratch_path(spark, "curated")
    with scratch_scope(spark):      # what is staged on the way goes at the end
        return _curate(spark, sf_dir, out, trip_rules)


def _curate(spark: SparkSession, sf_dir: str, out: str, trip_rules: rules.TripRules) -> dict[str, str]:
    paths = {k: os.path.join(out, k) for k in
             ("zones", "stations", "zones_geojson", "raw_trips", "taxi_trips",
              "subway_ridership", "ridership_problems", "combined_csv", "combined")}
    zones = demand.curated_zones(spark, sf_dir)

    writers.write_parquet(demand.zone_layer(spark, sf_dir), paths["zones"], mode="overwrite")
    feats = polygons.zone_features(demand.curated_zone_vertices(spark, sf_dir), zones)
    writers.write_lines(feats, "feature", paths["zones_geojson"])

    landed = fx.event_trips_view(spark, sf_dir).withColumn(
        "source_month", F.date_format("pu_time", "yyyy-MM"))
    writers.write_months(landed, paths["raw_trips"])
    raw = spark.read.schema(landed.schema).parquet(paths["raw_trips"])
    pickups = hourly.hourly_pickups(rules.clean_trips(raw, zones, trip_rules))
    writers.write_by_year(pickups, paths["taxi_trips"])

    station_zone = demand.station_zone(spark, sf_dir)
    writers.write_parquet(station_zone, paths["stations"], mode="overwrite")
    rz = combine.ridership_with_zone(demand.station_hours(spark, sf_dir), station_zone)
    writers.write_csv(rz.select(*[f.name for f in STATION_HOUR_SCHEMA.fields]),
                      paths["subway_ridership"])

    cast = rescue.cast_with_rescue(fx.ridership_text_view(spark, sf_dir), RIDERSHIP_CASTS)
    writers.write_parquet(rescue.rescued_values(cast, ["station_complex_id"]), paths["ridership_problems"],
                          mode="overwrite")

    hour = F.make_timestamp_ntz("year", "month", "dayofmonth", "hour", F.lit(0), F.lit(0))
    picked = (spark.read.schema(pickups.schema).parquet(paths["taxi_trips"])
              .select(F.col("pulocationid").alias("locationid"), hour.alias("hour_ts"),
                      "pu_hourly", "hourly_passengers"))
    ridden = (files.read_csv_typed(spark, paths["subway_ridership"], STATION_HOUR_SCHEMA)
              .where("locationid IS NOT NULL")
              .groupBy("locationid", F.col("timestamp").alias("hour_ts"))
              .agg(F.sum("hourly_ridership").cast("bigint").alias("hourly_ridership")))
    comb = combine.combined_demand(picked, ridden)
    writers.write_by_year(comb, paths["combined"])
    # the CSV copy reads the written table instead of recomputing the plan
    written = spark.read.schema(comb.schema).parquet(paths["combined"])
    writers.write_csv(written.select(*combine.COMBINED_COLUMNS), paths["combined_csv"])
    return paths


def main(argv: list[str]) -> None:
    from zonecast.session import local_session

    if not argv:
        raise SystemExit(__doc__)
    spark = local_session()
    for name, path in curate(spark, argv[0], argv[1] if len(argv) > 1 else None).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main(sys.argv[1:])
