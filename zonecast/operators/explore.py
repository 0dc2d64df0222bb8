"""Exploratory profiles of the demand tables.

All profiles are single aggregates (partial + final) over the input; where a
second step needs the whole result (a share of the total, a top-k), it runs
on the already aggregated rows, whose count is bounded by the number of
zones, boroughs or weekday-hours -- never by the number of trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType, TimestampNTZType, TimestampType

from zonecast.plans.strategy import join_small


def log_total_by_zone(df: DataFrame, measure: str, total_name: str, log_name: str,
                      zone_col: str = "locationid") -> DataFrame:
    """Total of `measure` per zone and its natural log (NULL for a
    zero total, where engines disagree on log 0)."""
    agg = df.groupBy(zone_col).agg(F.sum(measure).cast("bigint").alias(total_name))
    t = F.col(total_name)
    return agg.withColumn(log_name, F.when(t > 0, F.log(t.cast("double"))))


def borough_totals(df: DataFrame, zone_attrs: DataFrame,
                   zone_col: str = "locationid") -> DataFrame:
    """Pickups and ridership per borough and each borough's share of all
    pickups. Aggregates by zone first (map-side), joins the size-checked zone
    attributes, then aggregates by borough; the share's total is a window
    over the handful of borough rows."""
    by_zone = df.groupBy(zone_col).agg(F.sum("pu_hourly").alias("p"),
                                       F.sum("hourly_ridership").alias("r"))
    j = join_small(by_zone, zone_attrs.select(zone_col, "borough"), zone_col, "left")
    b = (j.groupBy("borough")
         .agg(F.sum("p").cast("bigint").alias("pickups"),
              F.sum("r").cast("bigint").alias("ridership")))
    total = F.sum("pickups").over(Window.partitionBy())
    return b.withColumn("pickup_share", F.col("pickups") / total)


def weekday_hour_profile(df: DataFrame) -> DataFrame:
    """Demand by (dayofweek, hour): totals, zone-hours and the mean."""
    return (df.groupBy("dayofweek", "hour")
            .agg(F.sum("pu_hourly").cast("bigint").alias("pickups"),
                 F.sum("hourly_ridership").cast("bigint").alias("ridership"),
                 F.count(F.lit(1)).alias("zone_hours"),
                 F.avg("pu_hourly").alias("mean_pickups")))


def peak_hour_by_weekday(df: DataFrame) -> DataFrame:
    """Per weekday the busiest and the quietest hour by pickups; ties go
    to the earliest hour."""
    prof = df.groupBy("dayofweek", "hour").agg(F.sum("pu_hourly").alias("n"))
    h = F.col("hour")
    return (prof.groupBy("dayofweek")
            .agg(F.max_by(h, F.struct(F.col("n"), -h)).alias("peak_hour"),
                 F.max("n").cast("bigint").alias("peak_pickups"),
                 F.min_by(h, F.struct(F.col("n"), h)).alias("trough_hour"),
                 F.min("n").cast("bigint").alias("trough_pickups")))


def dataset_shape(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table (one aggregate per table, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows",
                     F.lit(len(df.columns)).alias("n_columns"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column the NULL count and the range -- one aggregate, then
    unpivoted. Numbers: min_value and max_value (double); integers also
    min_int and max_int, exact; timestamps: min_time and max_time."""
    cols = list(columns or df.columns)

    def of(*types) -> set[str]:
        return {f.name for f in df.schema.fields if isinstance(f.dataType, types)}

    kinds = [("value", "double", of(NumericType)), ("int", "bigint", of(IntegralType)),
             ("time", "timestamp_ntz", of(TimestampNTZType, TimestampType))]
    ranged = set().union(*(names for _, _, names in kinds))
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n{i}"))
        if c in ranged:
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    row = df.agg(*aggs)

    def bound(end: str, i: int, kind: str, cast: str, names: set[str]):
        x = F.col(f"{end}{i}") if cols[i] in names else F.lit(None)
        return x.cast(cast).alias(f"{'min' if end == 'lo' else 'max'}_{kind}")

    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.col(f"n{i}").cast("bigint").alias("n_null"),
                 *[bound(end, i, *kind) for kind in kinds for end in ("lo", "hi")])
        for i, c in enumerate(cols)])))


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Which columns hold a single value. A column is constant when it
    has no NULLs and min = max -- exact, and a plain aggregate (no
    count-distinct expansion)."""
    cols = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"c{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    row = df.agg(*aggs)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.coalesce((F.col(f"c{i}") == F.col("_n"))
                            & (F.col(f"lo{i}") == F.col(f"hi{i}")), F.lit(False))
                 .alias("is_constant"))
        for i, c in enumerate(cols)])))


def subset_check(df: DataFrame, part: str, whole: str) -> DataFrame:
    """Does `part <= whole` hold on every row where both are known?"""
    both = F.col(part).isNotNull() & F.col(whole).isNotNull()
    return df.agg(F.count_if(both).alias("n_checked"),
                  F.count_if(both & (F.col(part) > F.col(whole))).alias("n_violations")
                  ).withColumn("holds", F.col("n_violations") == 0)


def top_zones(df: DataFrame, k: int = 10, measure: str = "pu_hourly",
              zone_col: str = "locationid") -> DataFrame:
    """O3: the k heaviest zones by total `measure` (ties by zone id); the
    limit is the feature. Planned as TakeOrderedAndProject: each task keeps
    its own top k, the driver merges k rows per task."""
    tot = df.groupBy(zone_col).agg(F.sum(measure).cast("bigint").alias("total"))
    return tot.orderBy(F.col("total").desc(), F.col(zone_col)).limit(k)
