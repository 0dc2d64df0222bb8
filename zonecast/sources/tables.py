"""Parquet scans of the input tables (A1, A2)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A1: lazy Parquet scan; later selects and filters prune and push down."""
    return spark.read.parquet(table_path(sf_dir, name))


def template_schema(spark: SparkSession, path: str) -> StructType:
    """A2: the schema of one file, from its footer only (no job over rows)."""
    return spark.read.parquet(path).schema
