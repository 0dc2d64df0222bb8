"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition sorts its digests into a run and collapses equal ones.
The digest space is cut into ordered ranges, and in each round `fan_in` runs
of a range meet in one task, which merges them (Spark's sort merges the
fetched runs) and keeps, for every text, the identifier that stays and the
number of rows. After log(runs) rounds one run per range is left, so no task
ever holds more than a range, and a text that makes up a third of the rows
crosses the network once per run.

Two texts count as equal if their SHA-256, their XXH64 and their length agree;
all three are compared at every merge, so no digest stands in for another.

Defined cases: null text counts as empty; null ids lose against any id, and a
group of null ids only has a null keep_id; rows that repeat an id with the
same text are one document, reported on each row; an empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import keep_rows, shares, staged

FAN_IN = 8
HOT_LEAST, HOT_GROUPS = 1000, 10_000   # hot groups: bounds the broadcast
KEY = ["digest", "check", "length"]
RUN_SCHEMA = ("slot int, run int, digest binary, check long, length int, "
              "keep_id long, n long, n_keep long")


def text_digests(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.unhex(F.sha2(text, 256)).alias("digest"),
                       F.xxhash64(text).alias("check"), F.length(text).alias("length"))


def _collapse(batches: Iterator[pa.RecordBatch], largest: bool) -> Iterator[pa.RecordBatch]:
    """Sorted rows in, one row per (slot, run, key) out. The last group of a
    batch is held back until the next batch shows whether it goes on."""
    held: pa.RecordBatch | None = None
    best = np.maximum if largest else np.minimum
    none = np.iinfo(np.int64).min if largest else np.iinfo(np.int64).max
    for batch in batches:
        if batch.num_rows == 0:
            continue
        # field by field: Spark's batches differ in what they declare nullable
        batch = pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names)
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        rows = batch.num_rows
        same = np.ones(rows - 1, bool)
        for name in ("slot", "run", *KEY):
            col = batch.column(name)
            same &= pc.equal(col.slice(1), col.slice(0, rows - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        ids = batch.column("keep_id").fill_null(int(none)).to_numpy()
        top = best.reduceat(ids, starts)
        group = np.cumsum(np.concatenate([[0], (~same).astype(np.int64)]))
        holds = np.where(ids == top[group], batch.column("n_keep").to_numpy(), 0)
        out = batch.take(pa.array(starts))
        cols = [out.column(c) for c in ("slot", "run", *KEY)]
        cols += [pa.array(top, mask=top == none, type=pa.int64()),
                 pa.array(np.add.reduceat(batch.column("n").to_numpy(), starts)),
                 pa.array(np.add.reduceat(holds, starts))]
        out = pa.RecordBatch.from_arrays(cols, names=["slot", "run", *KEY, "keep_id", "n", "n_keep"])
        held = out.slice(out.num_rows - 1)
        if out.num_rows > 1:
            yield out.slice(0, out.num_rows - 1)
    if held is not None:
        yield held


def merged_runs(digests: DataFrame, largest: bool = True, fan_in: int = FAN_IN) -> DataFrame:
    """(digest, check, length, keep_id, n, n_keep), one row per text.
    `digests`: doc_id, digest, check, length, run (the number of the run that
    the row starts in). n_keep: rows that hold keep_id."""
    spark = digests.sparkSession
    last = digests.agg(F.max("run")).first()[0]
    runs = 1 if last is None else last + 1
    slots = 4 * max(runs, int(spark.conf.get("spark.sql.shuffle.partitions")))
    prefix = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    one = F.lit(1).cast("long")
    level = digests.select(
        F.floor(prefix * slots / F.lit(2.0 ** 32)).cast("int").alias("slot"), "run", *KEY,
        F.col("doc_id").alias("keep_id"), one.alias("n"), one.alias("n_keep"))

    def collapse(df: DataFrame) -> DataFrame:
        return df.sortWithinPartitions("slot", "run", *KEY).mapInArrow(
            lambda batches: _collapse(batches, largest), RUN_SCHEMA)

    level = collapse(level)
    while True:
        level = level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        level = collapse(level.repartition("slot", "run"))
        runs = -(-runs // fan_in)
        if runs <= 1:
            return level.select(*KEY, "keep_id", "n", "n_keep")


def duplicate_groups(docs: DataFrame, largest: bool = True, fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of `docs`: doc_id, the key columns, keep_id,
    group_size, kept, n_keep."""
    digests = staged(text_digests(docs).withColumn("run", F.spark_partition_id()), "runs")
    groups = staged(merged_runs(digests, largest, fan_in), "merged")
    total = groups.agg(F.sum("n")).first()[0] or 0
    hot_from = shares(total, HOT_LEAST, HOT_GROUPS)
    many = groups.where("n > 1")
    hot = F.broadcast(many.where(F.col("n") >= hot_from))   # HOT_GROUPS rows at most
    rows = digests.select("doc_id", *KEY)
    in_hot = rows.join(hot, KEY, "inner")
    rest = rows.join(hot.select(*KEY), KEY, "left_anti").join(
        many.where(F.col("n") < hot_from), KEY, "left")
    both = in_hot.unionByName(rest.select(*in_hot.columns))
    single = F.col("n").isNull()
    return both.select(
        "doc_id", *KEY, F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        (single | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.coalesce("n_keep", F.lit(1)).alias("n_keep"))


def drop_duplicates(docs: DataFrame, largest: bool = True) -> DataFrame:
    """`docs` with one row of each text, all columns kept."""
    digests = staged(text_digests(docs).withColumn("run", F.spark_partition_id()), "runs")
    groups = staged(merged_runs(digests, largest), "merged")
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = {"id": F.col("doc_id").cast("long"), "digest": F.unhex(F.sha2(text, 256))}
    keep = groups.select(F.col("keep_id").alias("id"), "digest", F.col("n_keep").alias("n"))
    return keep_rows(docs, keys, keep)
