"""Trip cleaning rules (F1-F16).

Every threshold is an argument (`TripRules`). The rules are ANDed; a NULL in
any tested column drops the row (three-valued `where`). The nine rules are
column predicates except area membership, which is a semi join against the
zone set -- broadcast after a size check -- plus an id bound.

Scale notes:
* F1 is written as a half-open timestamp range, so Parquet row groups are
  skipped by their min/max statistics (`year(ts) IN (...)` is not pushed).
* All column predicates go into one `Filter`, which Catalyst pushes into the
  scan (`PushedFilters`).
* The funnel (F15) and rejection report (F16) are ONE aggregate over one
  scan: a `count_if` per prefix of rules, never nine `count()` jobs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.plans import strategy

# The rule order of the cleaning funnel.
RULE_ORDER = ("period", "area", "duration", "distance", "tip", "fare",
              "surcharges", "passengers", "categories")

ZONE_SET_MAX_ROWS = 1_000_000


@dataclass(frozen=True)
class TripRules:
    """Rule arguments; defaults are the surveyed workload's constants."""
    period_start: str = "2022-08-01 00:00:00"   # F1, inclusive
    period_end: str = "2023-04-01 00:00:00"     # F1, exclusive
    max_zone_id: int = 263                      # F2 id bound
    max_distance: float = 50.0                  # F4: 0 < d <= max
    tip_factor: float = 1.0                     # F5: 0 <= tip < factor * total
    min_charge: float = 2.5                     # F6: fare, total >= min
    max_fare: float = 500.0                     # F6: fare < max
    max_mta_tax: float = 0.5                    # F7
    max_tolls: float = 256.95                   # F7
    max_passengers: int = 6                     # F8: 0 < n <= max
    max_category: int = 6                       # F9


def ts_lit(text: str) -> Column:
    """A typed timestamp_ntz literal (constant-folded, pushable)."""
    return F.lit(text).cast("timestamp_ntz")


def rule_columns(r: TripRules, pu_ok: Column | None = None,
                 do_ok: Column | None = None) -> dict[str, Column]:
    """The nine predicates by name. `pu_ok` / `do_ok` are the area
    membership flags; when None the area rule is the id bound only (the
    membership part is then applied as semi joins)."""
    c = F.col
    area = (c("pulocationid") <= r.max_zone_id) & (c("dolocationid") <= r.max_zone_id)
    if pu_ok is not None:
        area = pu_ok & do_ok & area
    return {
        "period": (c("pu_time") >= ts_lit(r.period_start))
                  & (c("pu_time") < ts_lit(r.period_end)),
        "area": area,
        # pu != do is implied by pu < do
        "duration": c("pu_time") < c("do_time"),
        "distance": (c("trip_distance") > 0) & (c("trip_distance") <= r.max_distance),
        "tip": (c("tip_amount") >= 0)
               & (c("tip_amount") < F.lit(r.tip_factor) * c("total_amount")),
        "fare": (c("fare_amount") >= r.min_charge) & (c("total_amount") >= r.min_charge)
                & (c("fare_amount") < r.max_fare),
        "surcharges": (c("mta_tax") >= 0) & (c("mta_tax") <= r.max_mta_tax)
                      & (c("tolls_amount") >= 0) & (c("tolls_amount") <= r.max_tolls)
                      & (c("extra") >= 0),
        "passengers": (c("passenger_count") > 0)
                      & (c("passenger_count") <= r.max_passengers),
        "categories": (c("ratecodeid") <= r.max_category)
                      & (c("payment_type") <= r.max_category),
    }


def _zone_ids(zone_set: DataFrame) -> tuple[DataFrame, bool]:
    """Distinct zone ids and whether they passed the broadcast size check
    (checked once, used for both ends of the trip). The bound is checked on
    the zone rows before `distinct`: sufficient, and no shuffle."""
    ids = zone_set.select(F.col("locationid").cast("bigint").alias("locationid"))
    return ids.distinct(), strategy.has_at_most(ids, ZONE_SET_MAX_ROWS)


def _dim(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def semi_join_areas(trips: DataFrame, zone_set: DataFrame) -> DataFrame:
    """F2 / J5 membership: keep trips whose pickup AND dropoff zone are in the
    zone set. Two map-side broadcast semi joins when the zone set passes the
    size check; shuffle semi joins otherwise."""
    ids, small = _zone_ids(zone_set)
    pu = _dim(ids.withColumnRenamed("locationid", "pulocationid"), small)
    do = _dim(ids.withColumnRenamed("locationid", "dolocationid"), small)
    return trips.join(pu, "pulocationid", "left_semi").join(do, "dolocationid", "left_semi")


def with_area_flags(trips: DataFrame, zone_set: DataFrame) -> DataFrame:
    """Membership as boolean columns `_pu_ok`, `_do_ok` (left joins on the
    size-checked, de-duplicated zone set, so no row is duplicated)."""
    ids, small = _zone_ids(zone_set)
    pu = _dim(ids.select(F.col("locationid").alias("pulocationid"),
                         F.lit(True).alias("_pu_ok")), small)
    do = _dim(ids.select(F.col("locationid").alias("dolocationid"),
                         F.lit(True).alias("_do_ok")), small)
    out = trips.join(pu, "pulocationid", "left").join(do, "dolocationid", "left")
    return out.withColumns({"_pu_ok": F.coalesce("_pu_ok", F.lit(False)),
                            "_do_ok": F.coalesce("_do_ok", F.lit(False))})


def apply_rule(trips: DataFrame, name: str, rules: TripRules,
               zone_set: DataFrame | None = None) -> DataFrame:
    """One rule alone (F1-F9 keys)."""
    if name == "area":
        if zone_set is None:
            raise ValueError("the area rule needs the zone set")
        trips = semi_join_areas(trips, zone_set)
    return trips.where(rule_columns(rules)[name])


def clean_trips(trips: DataFrame, zone_set: DataFrame, rules: TripRules) -> DataFrame:
    """all nine rules -- one combined `where` plus two semi joins."""
    preds = rule_columns(rules)
    return semi_join_areas(trips.where(reduce(lambda a, b: a & b, preds.values())),
                           zone_set)


def _ok(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def attrition_funnel(trips: DataFrame, zone_set: DataFrame, rules: TripRules) -> DataFrame:
    """rows left after each rule in order, in one pass.

    Output (step int, rule string, rows_left bigint); step 0 is the input."""
    flagged = with_area_flags(trips, zone_set)
    preds = rule_columns(rules, F.col("_pu_ok"), F.col("_do_ok"))
    aggs, prefix = [F.count(F.lit(1)).alias("n0")], F.lit(True)
    for i, name in enumerate(RULE_ORDER, start=1):
        prefix = prefix & _ok(preds[name])
        aggs.append(F.count_if(prefix).alias(f"n{i}"))
    row = flagged.agg(*aggs)
    labels = ("start",) + RULE_ORDER
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(lbl).alias("rule"),
                 F.col(f"n{i}").cast("bigint").alias("rows_left"))
        for i, lbl in enumerate(labels)])))


def rule_rejections(trips: DataFrame, zone_set: DataFrame, rules: TripRules) -> DataFrame:
    """F16: per rule, rows failing it alone and rows for which it is the
    first failed rule (in funnel order), in one pass.

    Output (step, rule, failed_alone, first_failed); the extra row
    `step = 0, rule = 'none'` counts rows passing every rule."""
    flagged = with_area_flags(trips, zone_set)
    preds = rule_columns(rules, F.col("_pu_ok"), F.col("_do_ok"))
    aggs, prefix = [], F.lit(True)
    for i, name in enumerate(RULE_ORDER, start=1):
        ok = _ok(preds[name])
        aggs.append(F.count_if(~ok).alias(f"a{i}"))
        aggs.append(F.count_if(prefix & ~ok).alias(f"f{i}"))
        prefix = prefix & ok
    aggs.append(F.count_if(prefix).alias("a0"))
    row = flagged.agg(*aggs)
    entries = [F.struct(F.lit(0).alias("step"), F.lit("none").alias("rule"),
                        F.lit(None).cast("bigint").alias("failed_alone"),
                        F.col("a0").cast("bigint").alias("first_failed"))]
    entries += [F.struct(F.lit(i).alias("step"), F.lit(name).alias("rule"),
                         F.col(f"a{i}").cast("bigint").alias("failed_alone"),
                         F.col(f"f{i}").cast("bigint").alias("first_failed"))
                for i, name in enumerate(RULE_ORDER, start=1)]
    return row.select(F.inline(F.array(*entries)))


# --- F11-F14: the other filters -------------------------------------------

def filter_time_range(df: DataFrame, start: str, end: str,
                      ts_col: str = "timestamp") -> DataFrame:
    """half-open [start, end) on a timestamp column, typed literals."""
    return df.where((F.col(ts_col) >= ts_lit(start)) & (F.col(ts_col) < ts_lit(end)))


def filter_regex(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """keep rows whose column contains a regex match."""
    return df.where(F.col(column).rlike(pattern))


def filter_exclude(df: DataFrame, column: str, excluded: list[str]) -> DataFrame:
    """drop rows whose column equals one of the excluded values; a NULL
    is not equal to them, so it is kept (as a `!=` filter on a frame keeps
    missing values)."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(excluded))


def year_slice(df: DataFrame, year: int, year_col: str = "year") -> DataFrame:
    """One year's rows (partition-pruned on year-partitioned data)."""
    return df.where(F.col(year_col) == year)
