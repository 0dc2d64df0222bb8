"""Writers (K1-K6).

Every write targets a path under the cluster's shared folder or a path the
caller names; nothing is written to a machine-local temp folder by library
code. Writes are idempotent: a rerun replaces what it wrote before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_months(df: DataFrame, path: str, month_col: str = "source_month",
                 grouped: bool = False) -> None:
    """K1: partition by source month with *dynamic* overwrite: a rerun of a
    month replaces exactly that month's partition and leaves the others. The
    rebalance hint brings a month's rows together, so each month gets few
    files, and lets AQE split a large month over several tasks. `grouped`: the
    rows were read from files of one month each, so they are not shuffled
    again (a task writes as many files as it reads, at most)."""
    rows = df if grouped else df.hint("rebalance", month_col)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(month_col).parquet(path))


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K2/K5: plain Parquet write (create-only by default)."""
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: CSV with a header row."""
    df.write.mode(mode).option("header", True).csv(path)


def write_by_year(df: DataFrame, path: str, year_col: str = "year") -> None:
    """K4: one directory per year, so `where(year = Y)` prunes partitions.
    Rows are rebalanced by year (AQE splits a large year; a `repartition`
    would put it into one task) and sorted by year inside each task, so a
    task writes its years one after the other."""
    (df.hint("rebalance", year_col).sortWithinPartitions(year_col).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(year_col).parquet(path))


def write_lines(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    """K6: one text line per row (e.g. one GeoJSON feature per line)."""
    df.select(column).write.mode(mode).text(path)
