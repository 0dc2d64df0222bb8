"""File sources beyond a single Parquet scan.

* A4 month manifest: the months to load, generated by Spark from the data's
  own time span (`sequence` + `explode`), never a hand-written list.
* A3 multi-month scan: each month is read on its own (its footer types may
  drift), conformed **by name** to a template schema, tagged with its
  `source_month`, and the months are unioned. No month is collected.
* A5 CSV with header as all-strings; A6 CSV with a declared schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zonecast.operators.standardize import standardize_trips

# The month label (yyyy-MM) in the name of the directory holding a file.
MONTH_IN_PATH = r"([0-9]{4}-[0-9]{2})[^/]*/[^/]+$"


def month_manifest(bounds: DataFrame, start: Column | str, end: Column | str,
                   root: str, prefix: str = "", suffix: str = "") -> DataFrame:
    """A4: one row per month from month(start) to month(end), inclusive:
    (month_start date, month 'yyyy-MM', path). `bounds` is a one-row frame
    holding the two timestamps (e.g. the min/max of a pickup column)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    months = bounds.select(F.explode(F.sequence(
        F.trunc(s.cast("date"), "month"), F.trunc(e.cast("date"), "month"),
        F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    label = F.date_format("month_start", "yyyy-MM")
    return months.select("month_start", label.alias("month"),
                         F.concat(F.lit(root.rstrip("/") + "/" + prefix), label,
                                  F.lit(suffix)).alias("path"))


def month_of_file(pattern: str = MONTH_IN_PATH) -> Column:
    """The month label in the directory holding each row's file; a path
    without one raises."""
    path = F.col("_metadata.file_path")
    label = F.regexp_extract(path, pattern, 1)
    error = F.raise_error(F.concat(F.lit("no month in the path of "), path)).cast("string")
    return F.when(label == "", error).otherwise(label)


def footer_schemas(spark: SparkSession, paths: Sequence[str],
                   threads: int = 8) -> dict[str, StructType]:
    """Each existing path's footer schema (metadata only, no job over rows),
    discovered concurrently from the driver; paths that do not exist (a
    month that never landed) are left out."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.errors import AnalysisException

    def schema(p: str) -> StructType | None:
        try:
            return spark.read.parquet(p).schema
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
                return None
            raise

    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(paths)))) as ex:
        found = dict(zip(paths, ex.map(schema, paths)))
    return {p: s for p, s in found.items() if s is not None}


def read_months(spark: SparkSession, paths: Sequence[tuple[str, str]],
                template: StructType, pattern: str = MONTH_IN_PATH,
                missing: str = "raise") -> DataFrame:
    """Months whose files share a footer schema are read by ONE scan
    (with that schema, so nothing is inferred again) and conformed **by name**
    to the template once; `source_month` comes from each row's file path.
    The few schema groups are unioned by name. Months with drifted types or
    layouts land in their own group, so no file is read with a wrong type.
    A manifest month that never landed raises, unless `missing` is "skip"
    (`missing_months` lists what that leaves out)."""
    if missing not in ("raise", "skip"):
        raise ValueError(f"missing: {missing!r}")
    schemas = footer_schemas(spark, [p for _, p in paths])
    absent = [m for m, p in paths if p not in schemas]
    if absent and missing == "raise" or not schemas:
        raise FileNotFoundError(f"months that have not landed: {', '.join(absent)}")
    groups: dict[str, list[str]] = {}
    for _, p in paths:
        if p in schemas:
            groups.setdefault(schemas[p].json(), []).append(p)
    parts = []
    for plist in groups.values():
        raw = spark.read.schema(schemas[plist[0]]).parquet(*plist)
        parts.append(standardize_trips(raw, template)
                     .withColumn("source_month", month_of_file(pattern)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def missing_months(spark: SparkSession, paths: Sequence[tuple[str, str]]) -> list[str]:
    """The manifest months that have not landed."""
    schemas = footer_schemas(spark, [p for _, p in paths])
    return [m for m, p in paths if p not in schemas]


def template_from(spark: SparkSession, path: str) -> StructType:
    """A2 + P1: one month's footer schema with lower-cased names."""
    schema = spark.read.parquet(path).schema
    return StructType([f.__class__(f.name.lower(), f.dataType, f.nullable)
                       for f in schema.fields])


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """A5: CSV with a header row, every column read as text (no inference)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header row and a declared schema (PERMISSIVE: a value
    that does not parse becomes NULL)."""
    return (spark.read.format("csv").option("header", True).option("mode", "PERMISSIVE")
            .schema(schema).load(path))
