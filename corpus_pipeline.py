"""The corpus pipeline: documents through five operators of `zonecast.llm`.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept, and returns the kept rows; all but the last return the columns of
`docs`. `run` writes each stage's result as Parquet into the session's shared
folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonecast.llm import stages
from zonecast.llm.common import read, staged

STAGES = [
    ("quality classifier", stages.quality),
    ("exact dedup", stages.exact_dedup),
    ("SimHash near-dedup", stages.simhash_dedup),
    ("benchmark decontamination", stages.decontaminate),
    ("mixing sources to target weights", stages.mix_sources),
]

# The learned classifier of the first stage has no SQL form; the stages are
# tested against brute force in tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{i}")
    return docs
