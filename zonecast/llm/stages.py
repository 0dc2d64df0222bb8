"""The corpus pipeline's stages: each calls one operator, and its decision
takes effect. (spark, docs, sf_dir) -> kept rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import mixing, pu_quality, simhash, suffix_arrays, tree_dedup
from zonecast.llm.common import free_name, read, with_free_columns


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score below 0.5) go.
    The rows pass through the scoring tasks whole, so nothing is joined."""
    learn = ~pu_quality.held_out(F.col("doc_id"), 3, 1)
    model = pu_quality.train(docs.where(learn), read(spark, sf_dir, "labels").where(learn))
    inner = free_name(["text", "score"], "_zc_row")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(inner)
    scored = pu_quality.scores(docs.select(row, F.col("text")), model, [inner])
    return scored.where("score >= 0.5").select(f"{inner}.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return tree_dedup.drop_duplicates(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component the row with the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return suffix_arrays.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, one row each: the columns of `docs`,
    taken (words, repeats counted) and copies (how often it is taken)."""
    return mixing.take_mix(docs)
