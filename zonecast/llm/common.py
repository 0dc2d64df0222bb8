"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonecast.session import scratch_path

# A word ends at a blank or one of the control characters TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """`df` written as Parquet into the shared folder and read back: cuts the
    lineage, and a lost executor costs no more than its running tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(taken: Iterable[str], base: str) -> str:
    """`base`, lengthened until it clashes with none of `taken` (Spark
    resolves names without regard to case)."""
    have = {t.lower() for t in taken}
    while base.lower() in have:
        base += "_"
    return base


def with_free_columns(df: DataFrame, **columns) -> tuple[DataFrame, dict[str, str]]:
    """Add columns under names that clash with none of `df`; returns the
    names used."""
    names: dict[str, str] = {}
    for base, col in columns.items():
        names[base] = free_name([*df.columns, *names.values()], f"_zc_{base}")
        df = df.withColumn(names[base], col)
    return df, names


def keep_rows(docs: DataFrame, keys: dict[str, object], keep: DataFrame,
              carry: Sequence[str] = ()) -> DataFrame:
    """The rows of `docs` whose key occurs in `keep`, one row per key.

    `keys` maps a key name to its expression over `docs`; `keep` has those
    names and `n`, the number of rows of `docs` with that key, and may have
    columns to `carry` over (renamed if `docs` has such names). Keys compare
    null-safely. Rows that repeat a key (n > 1) take the only second shuffle;
    which of them stays is settled by their column values.
    """
    keep = staged(keep, "keep")         # read twice
    work, names = with_free_columns(docs, **keys)
    n = free_name(work.columns, "_zc_n")
    added = {c: free_name(work.columns, c) for c in carry}
    k = keep.select(*[F.col(c).alias(f"_zk_{c}") for c in keys], F.col("n").alias(n),
                    *[F.col(c).alias(a) for c, a in added.items()])
    on = [work[names[c]].eqNullSafe(k[f"_zk_{c}"]) for c in keys]
    hit = work.join(k, on, "inner").select(work["*"], k[n], *[k[a] for a in added.values()])
    out = [*[f"`{c}`" for c in docs.columns], *added.values()]
    once = hit.where(F.col(n) == 1).select(*out)
    if keep.where("n > 1").limit(1).count() == 0:
        return once
    rn = free_name(hit.columns, "_zc_rn")
    orderable = [F.col(f"`{f.name}`") for f in docs.schema.fields
                 if f.dataType.typeName() not in ("map", "variant")]
    w = W.partitionBy(*names.values()).orderBy(*orderable)
    more = (hit.where(F.col(n) > 1).withColumn(rn, F.row_number().over(w))
            .where(F.col(rn) == 1).select(*out))
    return once.unionByName(more)


def shares(total_rows: int, least: int, most_groups: int) -> int:
    """The size from which a group counts as hot: at most `most_groups`
    groups of a table of `total_rows` can reach it."""
    return max(least, -(-total_rows // most_groups))


HOT_LEAST = 1_000        # rows from which a key can be hot
HOT_KEYS = 1_000         # keys that can be hot at once


def join_apart(big: DataFrame, small: DataFrame, on: str, rows: str) -> DataFrame:
    """`big` joined with `small`, which has each key of `on` once, and how many
    rows of `big` have it in `rows` (dropped). Hot keys, `HOT_KEYS` at most,
    meet their rows by broadcast and never share a task; all others by
    shuffle. Both sides should be staged."""
    total, most = small.agg(F.sum(rows), F.max(rows)).first()
    hot_from = shares(total or 0, HOT_LEAST, HOT_KEYS)
    if (most or 0) < hot_from:
        return big.join(small.drop(rows), on)
    hot = F.broadcast(small.where(F.col(rows) >= hot_from).drop(rows))
    rest = big.join(hot.select(on), on, "left_anti").join(
        small.where(F.col(rows) < hot_from).drop(rows), on)
    return big.join(hot, on).unionByName(rest)
