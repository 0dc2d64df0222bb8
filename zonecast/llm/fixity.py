"""Fixity audit of WARC replicas by Merkle trees.

A replica is a table of records: file, offset, content (bytes). A record's
leaf is the SHA-256 of its offset and content. Records are grouped by ordered
ranges of their byte offset, `FIRST_RANGE` bytes at the lowest level and
`FAN_OUT` times as many at each next, up to one node per file; files go on by
ranges of the hash of their name up to one root. A node is the SHA-256 of the
children's places and hashes in order. Ranges of bytes, not of record
numbers: a lost record changes its own branch only.

The audit compares the roots and goes down: at each level only the children of
nodes that differ are compared. Every level is a table in the order of its
nodes, in files of ranges. As long as few nodes differ (`PUSHED` at most) their
children's ranges are pushed into the scan, and Parquet's statistics leave out
the files and row groups beside them, so a descent reads little more than what
lies under a difference; where more differ, the level is read and semi-joined.
Nothing is gathered in one task; the number of levels and at most `PUSHED` + 1
nodes a level reach the driver.

Defined cases: a null content is distinct from an empty one; records that share
file and offset are one leaf, over their contents in order (repeated rows
differ from single ones); null files or offsets are places of their own; equal
or empty replicas give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonecast.llm.common import staged

FIRST_RANGE = 1 << 16
FAN_OUT = 16
PUSHED = 64              # differing nodes whose children are filtered in the scan
PLACE = ["group", "file", "node"]


def leaves(records: DataFrame) -> DataFrame:
    """(file, offset, hash): one row per place of a record."""
    content = F.concat(F.when(F.col("content").isNull(), F.lit("0")).otherwise(F.lit("1")).cast("binary"),
                       F.coalesce("content", F.lit("").cast("binary")))
    one = records.select("file", F.col("offset").cast("long").alias("offset"),
                         F.sha2(content, 256).alias("h"))
    # most places have one record; the hashes of others are few
    return one.groupBy("file", "offset").agg(F.sha2(F.concat_ws(
        ",", F.coalesce(F.col("offset").cast("string"), F.lit("null")),
        F.array_sort(F.collect_list("h"))).cast("binary"), 256).alias("hash"))


def _parents(children: DataFrame, keys: dict[str, object]) -> DataFrame:
    """Nodes over `children` (place, hash), grouped by `keys`."""
    kids = F.array_sort(F.collect_list(F.struct("place", "hash")))
    text = F.array_join(F.transform(kids, lambda k: F.concat_ws("=", k["place"], k["hash"])), "\n")
    return children.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
        F.sha2(text.cast("binary"), 256).alias("hash"))


def _level(nodes: DataFrame, name: str) -> DataFrame:
    """A level of a tree, written in the order of its nodes."""
    return staged(nodes.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE), name)


def tree(records: DataFrame, levels: int, name_levels: int) -> list[DataFrame]:
    """The levels from the leaves to the root, each written to the shared
    folder. A node has group (the name's hash range), file, node (the range
    of offsets) and hash; levels above the files have a null file and node."""
    group = F.pmod(F.xxhash64("file"), F.lit(FAN_OUT ** name_levels))
    level = _level(leaves(records).select(group.alias("group"), "file",
                                          F.col("offset").alias("node"), "hash"), "leaves")
    out = [level]
    for i in range(levels):
        size = FIRST_RANGE if i == 0 else FAN_OUT
        up = _parents(level.withColumn("place", F.coalesce(F.col("node").cast("string"), F.lit("null"))),
                      {"group": F.col("group"), "file": F.col("file"),
                       "node": F.floor(F.col("node") / size)})
        level = _level(up, "nodes")
        out.append(level)
    whole = {"file": F.lit(None).cast("string"), "node": F.lit(None).cast("long")}
    level = level.withColumn("place", F.concat_ws(
        "/", F.coalesce("file", F.lit("")), F.coalesce(F.col("node").cast("string"), F.lit("null"))))
    for i in range(name_levels + 1):
        g = F.col("group") if i == 0 else F.floor(F.col("group") / FAN_OUT)
        level = _level(_parents(level, {"group": g, **whole}), "nodes")
        out.append(level)
        level = level.withColumn("place", F.col("group").cast("string"))
    return out


def _parent_keys(level: int, levels: int) -> list:
    """The place of a node's parent, as (group, file, node)."""
    if level < levels:
        size = FIRST_RANGE if level == 0 else FAN_OUT
        return [F.col("group"), F.col("file"), F.floor(F.col("node") / size)]
    g = F.col("group") if level == levels else F.floor(F.col("group") / FAN_OUT)
    return [g, F.lit(None).cast("string"), F.lit(None).cast("long")]


def children(nodes: DataFrame, wrong: DataFrame, level: int, levels: int) -> DataFrame:
    """The `nodes` of `level` whose parent is in `wrong`."""
    few = wrong.select(*PLACE).limit(PUSHED + 1).collect()
    if len(few) > PUSHED:
        bad = wrong.select(*[F.col(c).alias(f"_{c}") for c in PLACE])
        on = [k.eqNullSafe(F.col(f"_{c}")) for k, c in zip(_parent_keys(level, levels), PLACE)]
        return nodes.join(bad, on, "left_semi")

    def inside(name: str, at: int | None, size: int) -> Column:
        c = F.col(name)
        return c.isNull() if at is None else (c >= at * size) & (c < (at + 1) * size)

    keep = F.lit(False)
    for r in few:
        if level < levels:
            size = FIRST_RANGE if level == 0 else FAN_OUT
            file = F.col("file").isNull() if r["file"] is None else F.col("file") == r["file"]
            keep = keep | ((F.col("group") == r["group"]) & file & inside("node", r["node"], size))
        else:
            keep = keep | inside("group", r["group"], 1 if level == levels else FAN_OUT)
    return nodes.where(keep)


def depth(replicas: Sequence[DataFrame]) -> tuple[int, int]:
    """Levels over the offsets (until a range holds the longest file) and
    over the file names (until about `FAN_OUT` files share a range)."""
    far, names = 0, 0
    for r in replicas:
        a, b = r.agg(F.max(F.col("offset").cast("long")), F.approx_count_distinct("file")).first()
        far, names = max(far, a or 0), max(names, b)
    levels, span = 1, FIRST_RANGE
    while span <= far:
        levels, span = levels + 1, span * FAN_OUT
    name_levels, n = 0, FAN_OUT
    while n < names:
        name_levels, n = name_levels + 1, n * FAN_OUT
    return levels, name_levels


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Places where two replicas (file, offset, content) differ: file, offset,
    status (`corrupt`: both have a record there; `missing`: only the left
    has; `extra`: only the right has), left_hash, right_hash."""
    levels, name_levels = depth([left, right])
    a, b = tree(left, levels, name_levels), tree(right, levels, name_levels)
    wrong = None
    for i in range(len(a) - 1, -1, -1):
        x = a[i].withColumnRenamed("hash", "left_hash")
        y = b[i].withColumnRenamed("hash", "right_hash")
        if wrong is not None:       # only below nodes that differ
            x, y = (children(nodes, wrong, i, levels) for nodes in (x, y))
        y = y.select(*[F.col(c).alias(f"_{c}") for c in PLACE], "right_hash")
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLACE]
        both = x.withColumn("has_left", F.lit(True)).join(
            y.withColumn("has_right", F.lit(True)), on, "full_outer")
        differ = both.where(~F.col("left_hash").eqNullSafe(F.col("right_hash")))
        wrong = staged(differ.select(
            *[F.when(F.col("has_left"), F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in PLACE],
            "left_hash", "right_hash"), "differences")
    status = (F.when(F.col("right_hash").isNull(), "missing")
              .when(F.col("left_hash").isNull(), "extra").otherwise("corrupt"))
    return wrong.select("file", F.col("node").alias("offset"), status.alias("status"),
                        "left_hash", "right_hash")


def warc_records(pages: DataFrame, per_file: int = 500) -> DataFrame:
    """Pages (page_id, url, html) as WARC response records: `per_file` ids a
    file, in order of their ids; file, offset, page_id, content."""
    body = F.coalesce("html", F.lit("")).cast("binary")
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "),
                    F.coalesce("url", F.lit("")), F.lit("\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n")).cast("binary")
    content = F.concat(head, body, F.lit("\r\n\r\n").cast("binary"))
    rows = pages.select("page_id", content.alias("content"), F.format_string(
        "crawl-%08d.warc", F.floor(F.col("page_id") / per_file)).alias("file"))
    before = W.partitionBy("file").orderBy("page_id", F.xxhash64("content")).rowsBetween(
        W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.octet_length("content").cast("long")).over(before), F.lit(0))
    return rows.withColumn("offset", offset).select("file", "offset", "page_id", "content")
