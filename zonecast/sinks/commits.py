"""Month commits (K1): a month is seen whole, old or new, and written only when
it changed.

    root/data/<version>/source_month=2024-01/...   rows, never overwritten
    root/commits/<version>/...                     one small file per commit

A commit takes three steps: a digest of each landed month, one write of the
months whose digest differs from the committed one into a new version, and,
after the written rows have been read back and have the same digests, one file
that names the version for these months. Readers go by the last record of each
month, so a write that dies before that file leaves everything as it was, and
its files are never read. One writer at a time.

A digest is a count and two sums over hashes of the rows: it does not depend on
their order, and Spark adds it up before any shuffle.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "month string, n_rows long, digest string, version string, number long"
LABEL_IN_PATH = "/{column}=([^/]+)/[^/]+$"


@dataclass(frozen=True)
class Commit:
    version: str | None         # None: nothing changed, nothing was written
    written: tuple[str, ...]    # months
    unchanged: tuple[str, ...]


def month_digests(df: DataFrame, month_col: str = "source_month") -> DataFrame:
    """(month, n_rows, digest) of each month's rows, whatever their order and
    whatever order the columns come in."""
    columns = sorted(c for c in df.columns if c != month_col)
    # a missing value must not hash like the value beside it
    cells = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    first, second = F.xxhash64(*cells), F.xxhash64(F.lit("again"), *cells)
    sums = [F.sum(h.cast("decimal(38,0)")).cast("string") for h in (first, second)]
    return (df.groupBy(F.col(f"`{month_col}`").alias("month"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws(":", *sums).alias("digest")))


def records(spark: SparkSession, root: str) -> DataFrame:
    """All commit records, one per month and commit."""
    from pyspark.errors import AnalysisException

    empty = spark.createDataFrame([], RECORD)
    try:
        return (spark.read.schema(RECORD).option("recursiveFileLookup", True)
                .parquet(f"{root}/commits"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return empty
        raise


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(month, n_rows, digest, version, number, n_commits): what is seen of
    each month."""
    got = records(spark, root).groupBy("month").agg(
        F.max(F.struct("number", "n_rows", "digest", "version")).alias("r"),
        F.count(F.lit(1)).alias("n_commits"))
    return got.select("month", "r.n_rows", "r.digest", "r.version", "r.number", "n_commits")


def write_version(df: DataFrame, root: str, version: str, month_col: str = "source_month") -> None:
    """The rows of a version; seen by nobody until it is committed."""
    (df.hint("rebalance", month_col).write.mode("errorifexists").partitionBy(month_col)
     .parquet(f"{root}/data/{version}"))


def read_version(spark: SparkSession, root: str, version: str, schema, month_col: str = "source_month") -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/data/{version}")


def commit_months(df: DataFrame, root: str, month_col: str = "source_month") -> Commit:
    """Write the months of `df` that changed. Months that `df` does not have
    stay as they are. A NULL month is an error. The driver holds one record a
    month."""
    spark = df.sparkSession
    landed = {r["month"]: (r["n_rows"], r["digest"]) for r in month_digests(df, month_col).collect()}
    if None in landed:
        raise ValueError(f"{landed[None][0]} rows without a month")
    seen = {r["month"]: r for r in manifest(spark, root).collect()}
    changed = sorted(m for m, now in landed.items()
                     if m not in seen or (seen[m]["n_rows"], seen[m]["digest"]) != now)
    same = tuple(sorted(set(landed) - set(changed)))
    if not changed:
        return Commit(None, (), same)
    version = uuid.uuid4().hex[:12]
    write_version(df.where(F.col(month_col).isin(changed)), root, version, month_col)
    written = month_digests(read_version(spark, root, version, df.schema, month_col), month_col)
    if {r["month"]: (r["n_rows"], r["digest"]) for r in written.collect()} != {m: landed[m] for m in changed}:
        raise OSError(f"version {version} differs from what was to be written; it is not committed")
    number = max((r["number"] for r in seen.values()), default=0) + 1
    rows = [(m, *landed[m], version, number) for m in changed]
    # one row a month, one file: it is there or not
    spark.createDataFrame(rows, RECORD).coalesce(1).write.parquet(f"{root}/commits/{version}")
    return Commit(version, tuple(changed), same)


def read_months(spark: SparkSession, root: str, schema, month_col: str = "source_month") -> DataFrame:
    """All committed months, each from its own version; the month comes from
    the path of a row's file."""
    seen = manifest(spark, root).collect()      # one row a month
    if not seen:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/data/{r['version']}/{month_col}={r['month']}" for r in seen]
    inner = [f for f in schema.fields if f.name != month_col]
    rows = spark.read.schema(type(schema)(inner)).parquet(*paths)
    month = F.regexp_extract(F.col("_metadata.file_path"), LABEL_IN_PATH.format(column=month_col), 1)
    return rows.withColumn(month_col, month).select(*[f.name for f in schema.fields])
