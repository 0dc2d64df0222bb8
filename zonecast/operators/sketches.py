"""A profile that adds up (G11): sketches per month, stored and merged.

Exact counts, NULLs and ranges add up by themselves; distinct values are kept
as a HyperLogLog sketch and quantiles as a KLL sketch, a few kilobytes each. A
month is profiled once, when it lands; the profile of any period is a merge of
its months' rows, and a new month costs only itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, TimestampNTZType, TimestampType

LG_CONFIG = 14              # HyperLogLog: 2^14 buckets
KLL_K = 400
# Relative error of the distinct count, and rank error of a quantile, that hold
# for 99 of 100 sketches of these sizes.
DISTINCT_ERROR = 0.025
RANK_ERROR = 0.01


def as_number(df: DataFrame, column: str) -> Column | None:
    """The column as a double; timestamps as seconds; None for text."""
    kind = df.schema[column].dataType
    if isinstance(kind, NumericType):
        return F.col(column).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        # microseconds first: casts of zone-less times to numbers are not allowed
        return (F.unix_micros(F.col(column).cast("timestamp")) / 1e6).cast("double")
    if isinstance(kind, BooleanType):
        return F.col(column).cast("int").cast("double")
    return None


def month_sketches(df: DataFrame, month_col: str, columns: Sequence[str]) -> DataFrame:
    """One row per month and column: column_name, n, n_null, low, high (as
    numbers), distinct_sketch, quantile_sketch. One aggregate of all columns."""
    aggs = []
    for i, c in enumerate(columns):
        number = as_number(df, c)
        x = F.lit(None).cast("double") if number is None else number
        aggs += [F.count(F.lit(1)).alias(f"n{i}"), F.count_if(F.col(c).isNull()).alias(f"z{i}"),
                 F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}"),
                 F.hll_sketch_agg(F.col(c).cast("string"), LG_CONFIG).alias(f"h{i}"),
                 F.kll_sketch_agg_double(x, KLL_K).alias(f"k{i}")]
    each = F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"z{i}").alias("n_null"),
        F.col(f"a{i}").alias("low"), F.col(f"b{i}").alias("high"), F.col(f"h{i}").alias("distinct_sketch"),
        F.col(f"k{i}").alias("quantile_sketch")) for i, c in enumerate(columns)]))
    return df.groupBy(month_col).agg(*aggs).select(month_col, each)


def merged_profile(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column over all months of `sketches`: n, n_null, low, high,
    n_distinct (an estimate) and q<percent> (values; NULL for text)."""
    m = sketches.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.hll_union_agg("distinct_sketch").alias("_h"),
        F.kll_merge_agg_double("quantile_sketch").alias("_k"))
    some = F.col("low").isNotNull()
    return m.select("column_name", "n", "n_null", "low", "high",
                    F.hll_sketch_estimate("_h").alias("n_distinct"),
                    *[F.when(some, F.kll_sketch_get_quantile_double("_k", F.lit(float(q))))
                      .alias(f"q{round(q * 100)}") for q in quantiles])
