"""Join strategy helpers: broadcast only behind a size check.

A side is broadcast only after one plain aggregate (rows and bytes, computed
in parallel, no limit) proves it small. Beyond the bounds
the join is left to the planner: sort-merge or shuffle-hash on the join keys,
which AQE may still re-plan from runtime statistics (and split skewed
partitions of).

Where the explicit check is used: dimension sides (zone sets, zone
attributes, the tile table built from the zone layer) and derived sides that
are materialised first in the shared checkpoint folder (the station -> zone
map), so the count and the join read the same, already computed rows. A side
that is an aggregate of a large input gets no hint and no eager check (it
would be computed twice); AQE decides from its measured size at runtime.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default row bound for a broadcast dimension (narrow rows: ids + a few
# numbers). 2M narrow rows stay well under 100 MB on every executor.
DEFAULT_BROADCAST_ROWS = 2_000_000
# And in bytes: what every executor holds of one broadcast side, at most.
MAX_BROADCAST_BYTES = 64 << 20


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when `df` has at most `max_rows` rows and `MAX_BROADCAST_BYTES`
    bytes (text by its length, other values as 8 bytes, 16 bytes a row)."""
    width = F.lit(16).cast("long")
    for f in df.schema.fields:
        text = f.dataType.typeName() == "string"
        width = width + (F.coalesce(F.octet_length(f.name), F.lit(0)) if text else F.lit(8))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= MAX_BROADCAST_BYTES


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the size check passes."""
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def join_small(big: DataFrame, small: DataFrame, on: str | Sequence[str] | object,
               how: str = "inner", max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """`big.join(small)` with `small` broadcast when proven small."""
    return big.join(maybe_broadcast(small, max_rows), on, how)


def materialize(df: DataFrame, name: str = "kept") -> DataFrame:
    """Cut lineage: `df` written as Parquet into the session's shared folder
    (`spark.checkpoint.dir`) and read back. It survives executor loss, and
    readers take only the columns they need. Never a machine-local
    checkpoint."""
    from zonecast.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
