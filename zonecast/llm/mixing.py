"""Mixing sources to target weights by weighted fair queueing.

Each source queues its documents in a shuffled order (md5 of the id, so that
reruns agree), up to three times over. The entry that brings a source's queue
to c words has the virtual finish time c / target. Entries are served by
finish time over all sources until the total budget is reached, so each source
is served in proportion to its target.

DataFrame and SQL functions only. Nothing is sorted in one task: running sums
are built from buckets of bounded size, their blocks and the blocks' sums, and
the place where the budget ends is found by range: sums of coarse ranges of
finish time, then of the parts of the one that holds the end, and only that
last part (about a millionth of the time) is sorted.

Defined cases: null or empty text has size 0 and takes 0; null sources form
one source, last in order; a source without words has target 0; repeated rows
queue as rows of their own; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonecast.llm.common import WORD, keep_rows, staged

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BUCKET_ROWS = 512        # rows of a source expected in one bucket
BLOCK_BUCKETS = 1024     # buckets of one block
RANGES = 1024            # ranges of all finish times, and parts of a range
BROADCAST_SOURCES = 10_000


def word_count(text):
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, n_docs, rank, target) from (source, size).

    Sources by code point, null last, take `weights` in turn and share the
    sum of all sizes. A target stops at `max_repeats` times the source's
    size; the excess goes to the others by weight until none is above. With
    the sources in order of the share at which they stop, the stopped ones
    are a prefix: that of all sources whose limit lies below their share of
    what the sources before them leave. One row per source is sorted in one
    task; texts and documents never are.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.count(F.lit(1)).alias("n_docs"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    per = per.withColumn("rank", F.row_number().over(order))
    weight = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                          ((F.col("rank") - 1) % n + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("long")).withColumn(
        "limit", F.col("source_size") * max_repeats)
    stops = W.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = stops.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    per = (per
           .withColumn("left_words", F.sum("source_size").over(whole)
                       - F.coalesce(F.sum("limit").over(before), F.lit(0)))
           .withColumn("left_weight", F.sum("weight").over(whole)
                       - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    fits = F.col("limit") * F.col("left_weight") <= F.col("left_words") * F.col("weight")
    # stopped: this source and all before it are at their limit
    per = per.withColumn("open", F.max(F.when(fits, 0).otherwise(1)).over(
        stops.rowsBetween(W.unboundedPreceding, 0)))
    rest = F.when(F.col("open") == 1, F.struct("limit", "left_words", "left_weight"))
    first = F.first(rest, ignorenulls=True).over(
        stops.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    per = per.withColumn("rest", first)
    target = F.when(F.col("open") == 0, F.col("limit").cast("double")).otherwise(
        F.col("rest.left_words").cast("double") * F.col("weight") / F.col("rest.left_weight"))
    return per.select("source", "source_size", "n_docs", "rank", target.alias("target"))


def _queued(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Each document with `upto`, the words of its source's queue up to and
    with it, in shuffled order."""
    t = F.broadcast(targets) if targets.count() <= BROADCAST_SOURCES else targets
    rows = sizes.join(t.withColumnRenamed("source", "_source"),
                      sizes["source"].eqNullSafe(F.col("_source")), "inner").drop("_source")
    buckets = F.ceil(F.col("n_docs") / F.lit(BUCKET_ROWS))
    place = F.conv(F.substring("turn", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("bucket", F.floor(place * buckets / F.lit(2.0 ** 32)).cast("long"))
    rows = rows.withColumn("block", F.floor(F.col("bucket") / BLOCK_BUCKETS))
    sums = rows.groupBy("rank", "block", "bucket").agg(F.sum("size").alias("words"))
    blocks = sums.groupBy("rank", "block").agg(F.sum("words").alias("words"))
    past = (W.unboundedPreceding, -1)
    blocks = blocks.select("rank", "block", F.coalesce(F.sum("words").over(
        W.partitionBy("rank").orderBy("block").rowsBetween(*past)), F.lit(0)).alias("block_start"))
    sums = sums.select("rank", "block", "bucket", F.coalesce(F.sum("words").over(
        W.partitionBy("rank", "block").orderBy("bucket").rowsBetween(*past)),
        F.lit(0)).alias("bucket_start"))
    starts = sums.join(blocks, ["rank", "block"]).select(
        "rank", "bucket", (F.col("block_start") + F.col("bucket_start")).alias("start"))
    w = W.partitionBy("rank", "bucket").orderBy("turn", "doc_id", "size", "text_hash").rowsBetween(
        W.unboundedPreceding, 0)
    rows = rows.withColumn("inside", F.sum("size").over(w))
    return rows.join(starts, ["rank", "bucket"]).select(
        "doc_id", "source", "text_hash", "size", "source_size", "target", "rank",
        (F.col("start") + F.col("inside")).alias("upto"))


def _last_served(entries: DataFrame, budget: int) -> tuple[float, int] | None:
    """Finish time and source rank of the last entry within the budget.
    `entries`: finish, rank, size."""
    def cut(ranges: DataFrame, before: int) -> tuple[int, int] | None:
        w = W.orderBy("r").rowsBetween(W.unboundedPreceding, 0)
        got = (ranges.groupBy("r").agg(F.sum("size").alias("words"))
               .withColumn("upto", F.sum("words").over(w) + F.lit(before))
               .where(F.col("upto") > budget).orderBy("r").limit(1).collect())
        return (got[0]["r"], got[0]["upto"] - got[0]["words"]) if got else None

    # as many ranges however large finish times get
    latest = entries.agg(F.max("finish")).first()[0]
    if not latest:
        return None
    coarse = F.floor(F.col("finish") * F.lit(RANGES / latest))
    found = cut(entries.select(coarse.alias("r"), "size"), 0)
    if found is None:
        return None
    inside = entries.where(coarse == found[0])
    fine = F.floor(F.col("finish") * F.lit(RANGES * RANGES / latest))
    finer = cut(inside.select(fine.alias("r"), "size"), found[1])
    if finer is None:
        return None
    w = W.orderBy("finish", "rank").rowsBetween(W.unboundedPreceding, 0)
    within = (inside.where(fine == finer[0])
              .withColumn("upto", F.sum("size").over(w) + F.lit(finer[1])))
    end = (within.where(F.col("upto") <= budget).orderBy(F.desc("finish"), F.desc("rank"))
           .limit(1).collect())
    if end:
        return end[0]["finish"], end[0]["rank"]
    # nothing of this range is served: the last entry of those before it
    before = entries.where((coarse < found[0]) | ((coarse == found[0]) & (fine < finer[0])))
    best = before.agg(F.max(F.struct("finish", "rank"))).first()[0]
    return (best["finish"], best["rank"]) if best else (-1.0, 0)


def _mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS,
        max_repeats: int = MAX_REPEATS) -> DataFrame:
    sizes = staged(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("turn")),
        "mix-sizes")
    targets = staged(source_targets(sizes, weights, max_repeats), "mix-targets")
    budget = targets.agg(F.sum("source_size")).first()[0] or 0
    queue = staged(_queued(sizes, targets), "mix-queue")

    def finish(turn_no: int):
        return F.when(F.col("target") > 0,
                      (F.lit(turn_no) * F.col("source_size") + F.col("upto"))
                      / F.col("target"))

    turns = F.explode(F.array(*[finish(i) for i in range(max_repeats)])).alias("finish")
    entries = queue.where("size > 0").select("rank", "size", turns).where("finish is not null")
    last = _last_served(entries, budget)
    served = F.lit(0)
    for i in range(max_repeats):
        v = finish(i)
        in_time = F.lit(True) if last is None else (
            (v < last[0]) | ((v == last[0]) & (F.col("rank") <= last[1])))
        served = served + F.when(v.isNotNull() & in_time, 1).otherwise(0)
    return queue.withColumn("copies", F.when(F.col("size") > 0, served).otherwise(0).cast("int"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS,
        max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words
    the mix takes of it, repeats counted) and copies. Budget: the sum of all
    sizes."""
    return _mixed(docs, weights, max_repeats).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies")


def take_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS,
             max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The rows of `docs` that the mix takes, with all their columns, taken
    and copies. Rows that repeat each other in id, source and text become one
    row with their copies added."""
    rows = _mixed(docs, weights, max_repeats)
    key = ["doc_id", "source", "text_hash"]
    keep = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.sum("copies").cast("int").alias("copies"),
        F.sum(F.col("size") * F.col("copies")).cast("long").alias("taken")).where("copies > 0")
    keys = {"doc_id": F.col("doc_id"), "source": F.col("source"),
            "text_hash": F.xxhash64(F.coalesce("text", F.lit("")))}
    return keep_rows(docs, keys, keep, ["taken", "copies"])
