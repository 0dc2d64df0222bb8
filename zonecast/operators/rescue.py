"""Bad records made visible.

A tolerant cast gives NULL for what it cannot read. Here each such value is
also kept: its column, its text, the type it should have and the reason, in an
array beside the row, so one pass gives both the typed rows and the side table
of what was lost. The side table is written beside the output, and counts per
column and reason say at a glance what a feed got wrong.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from zonecast.functions.columns import tolerant_cast

RESCUED = "rescued"
RESCUED_TYPE = "array<struct<column_name:string,value:string,target:string,reason:string>>"
CORRUPT = "corrupt_record"
SIDE = "_rescued"           # ending of the side table's path

INTEGERS = ("int", "bigint", "long", "smallint", "tinyint")


@dataclass(frozen=True)
class Cast:
    """`column` should be of type `target`; timestamps have a format."""
    column: str
    target: str
    format: str | None = None

    def typed(self) -> Column:
        if self.format:
            return F.try_to_timestamp(F.col(self.column), F.lit(self.format)).cast(self.target)
        return tolerant_cast(self.column, self.target)

    def reason(self) -> Column:
        """Why the value is not read as it stands; NULL where it is, and where
        there is none."""
        text = F.trim(F.col(self.column).cast("string"))
        if self.format:
            why = F.when(self.typed().isNull(), "not a timestamp")
        elif self.target in INTEGERS:
            number = text.try_cast("decimal(38,6)")
            why = (F.when(number.isNull() & text.try_cast("double").isNull(), "not a number")
                   .when(self.typed().isNull(), "out of range")
                   .when(number != F.floor(number), "fraction lost"))
        elif self.target == "boolean":
            why = F.when(self.typed().isNull(), "not a boolean")
        else:
            why = F.when(self.typed().isNull(), "not a number")
        return F.when(text != "", why)


def cast_with_rescue(df: DataFrame, casts: Sequence[Cast]) -> DataFrame:
    """`df` with the columns of `casts` typed, and `rescued`: what was lost or
    changed on the way, an empty array in most rows."""
    lost = F.array(*[F.when(c.reason().isNotNull(), F.struct(
        F.lit(c.column).alias("column_name"), F.col(c.column).cast("string").alias("value"),
        F.lit(c.target).alias("target"), c.reason().alias("reason"))) for c in casts])
    return df.withColumns({RESCUED: F.filter(lost, lambda x: x.isNotNull()).cast(RESCUED_TYPE),
                           **{c.column: c.typed() for c in casts}})


def rescued_values(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per lost value: the keys, column_name, value, target, reason."""
    return df.select(*keys, F.inline(RESCUED))


def problem_counts(rescued: DataFrame) -> DataFrame:
    return rescued.groupBy("column_name", "reason").agg(F.count(F.lit(1)).alias("n"))


def write_with_rescue(df: DataFrame, path: str, keys: Sequence[str],
                      mode: str = "errorifexists") -> tuple[str, str]:
    """The typed rows at `path` and the lost values beside it; returns both
    paths. The rows are written once with what was lost, and the side table
    is read off the written rows, so no cast runs twice."""
    df.write.mode(mode).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    side = path.rstrip("/") + SIDE
    rescued_values(written.where(F.size(RESCUED) > 0), keys).write.mode(mode).parquet(side)
    return path, side


def read_csv_checked(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A6 with its bad records: a CSV with header and declared schema, and the
    whole line as `corrupt_record` where a field does not fit its type or the
    number of fields is wrong. All columns are read, since which records are
    corrupt depends on the columns that are looked at; stage the result before
    taking columns of it."""
    full = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    return (spark.read.format("csv").option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).schema(full).load(path))
