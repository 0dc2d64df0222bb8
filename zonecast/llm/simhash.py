"""SimHash near-duplicates, candidates thinned by pivot distance tables.

Fingerprint: 64 bits by majority over the XXH64 values of a text's word
shingles. Two fingerprints link at `max_bits` or fewer differing bits; a
component is everything reachable over links.

Pivot tables. Distances obey the triangle inequality, so two fingerprints
within `max_bits` have distances to any reference fingerprint that differ by
at most `max_bits`. Distances to `PIVOTS` fixed reference fingerprints are
computed once per distinct fingerprint, stored beside it (a byte each) and go
with it into its blocks; a candidate pair is discarded by its largest
coordinate difference, and only survivors are compared bit by bit.

A pivot table alone would still have to look at all pairs (one random pivot
keeps about 57 % of them), so fingerprints first meet in blocks that lose no
link: the 64 bits are cut into `b` blocks, two fingerprints at `max_bits` or
fewer differing bits agree on at least b - max_bits blocks, and each
combination of that many blocks is one key. `b` grows with the number of
fingerprints so that a key value stays shared by few unrelated ones. Equal
fingerprints are merged before.

Dense blocks (large groups of near copies) are not expanded into pairs: inside
a block, fingerprints next to a pivot of the block join its ball in one
vectorised step, only fingerprints outside all earlier balls become pivots,
and balls that already hang together are never compared again. The output is
at most one edge per fingerprint and block, and components are found by
alternating large-star and small-star steps, each written to the shared
folder. Nodes, roots and fingerprints that very many rows share (a component or
a group of exact copies may hold a third of all) are joined by broadcast.

Defined cases: null text is empty; a text without words has fingerprint zero
and links like any other; repeated rows share a fingerprint and a component;
null ids lose against any id (a component of null ids has a null id); an empty
table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import join_apart, keep_rows, staged

SHINGLE = 4
MAX_BITS = 4
SEED = 42
PIVOTS = 16
CHUNK = 1 << 18          # shingles hashed at once; bounds memory on long texts
SHARED_BY = 16           # unrelated fingerprints expected per key value, at most
MANY = 48                # block size from which balls replace shifted comparison


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: XXH64 of the pivot's number."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(n)], np.uint64)


def distances(fp) -> list:
    """The pivot table's row of a fingerprint, as long columns: eight
    distances (0 to 64) a long, a byte each."""
    words = []
    for at in range(0, PIVOTS, 8):
        word = F.lit(0).cast("long")
        for i, p in enumerate(pivots()[at:at + 8].view(np.int64).tolist()):
            d = F.bit_count(fp.bitwiseXOR(F.lit(p).cast("long"))).cast("long")
            word = word.bitwiseOR(F.shiftleft(d, 8 * i))
        words.append(word.alias(f"pivots_{at // 8}"))
    return words


TABLE = [f"pivots_{i}" for i in range(PIVOTS // 8)]


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - np.array([len(w) + 1 for w in words])).tolist()
    ends = (ends - 1).tolist()
    joined = b" ".join(words)
    n = max(1, len(words) - width + 1)
    last = min(width, len(words)) - 1
    hash64 = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        to = min(n, at + CHUNK)
        h = np.array([hash64(joined[s:e], SEED)
                      for s, e in zip(starts[at:to], ends[at + last:to + last])], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE, text: str = "text",
                 keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keys` and `fp` (the fingerprint as a signed long) of every row."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), width) for t in b.column(text)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in keys], pa.array(fp.view(np.int64))], [*keys, "fp"])

    source = docs.select(*keys, text)
    fields = ", ".join(f"`{k}` {source.schema[k].dataType.simpleString()}" for k in keys)
    return source.mapInArrow(hashed, f"{fields}, fp long")


def block_keys(n_rows: int, max_bits: int = MAX_BITS) -> list[list[tuple[int, int]]]:
    """The keys' bit ranges [(shift, width), ...]: combinations of blocks."""
    for b in range(max_bits + 2, 33):
        edges = [round(64 * i / b) for i in range(b + 1)]
        blocks = [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]
        keys = [list(c) for c in combinations(blocks, b - max_bits)]
        bits = min(sum(w for _, w in k) for k in keys)
        if n_rows <= SHARED_BY << bits or len(keys) > 500:
            return keys
    raise ValueError("max_bits is too large for block keys")


class _Sets:
    """Union-find over 0..n-1; the smallest member is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _near(x: np.ndarray, y: np.ndarray, tx: np.ndarray, ty: np.ndarray, max_bits: int):
    """Which aligned pairs link: pivot coordinates first, then all bits."""
    ok = np.abs(tx - ty).max(axis=1) <= max_bits
    ok[ok] = np.bitwise_count(x[ok] ^ y[ok]) <= max_bits
    return ok


def link_small(key: np.ndarray, fps: np.ndarray, table: np.ndarray, max_bits: int):
    """Links inside runs of equal `key` (short runs): row pairs. `table`: the
    distances to the pivots."""
    left, right = [], []
    shift = 1
    at = np.flatnonzero(key[1:] == key[:-1])
    while at.size:
        ok = _near(fps[at], fps[at + shift], table[at], table[at + shift], max_bits)
        left.append(at[ok])
        right.append(at[ok] + shift)
        shift += 1
        at = at[at + shift < len(key)]
        at = at[key[at] == key[at + shift]]
    cat = lambda a: np.concatenate(a) if a else np.zeros(0, np.int64)
    return cat(left), cat(right)


def link_dense(fps: np.ndarray, table: np.ndarray, max_bits: int):
    """Edges that connect exactly what links connect among distinct `fps`."""
    n = len(fps)
    sets, ball = _Sets(n), np.full(n, -1, np.int64)
    centres: list[int] = []
    edges: list[tuple[int, int]] = []
    open_at = 0
    while True:
        while open_at < n and ball[open_at] >= 0:
            open_at += 1
        if open_at == n:
            break
        c = open_at
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[c]) <= max_bits).tolist():
            if ball[j] < 0:
                ball[j] = len(centres)
            if sets.join(c, j):
                edges.append((c, j))
        centres.append(c)
    # links between members of different balls
    order = np.argsort(ball, kind="stable")
    members = np.split(order, np.flatnonzero(np.diff(ball[order])) + 1)
    mid = fps[centres]
    for a, c in enumerate(centres):
        close = np.flatnonzero(np.bitwise_count(mid[a + 1:] ^ fps[c]) <= 3 * max_bits) + a + 1
        for b in close.tolist():
            if sets.root(c) == sets.root(centres[b]):
                continue
            xs = members[a][np.bitwise_count(fps[members[a]] ^ mid[b]) <= 2 * max_bits]
            ys = members[b][np.bitwise_count(fps[members[b]] ^ fps[c]) <= 2 * max_bits]
            for x in xs.tolist():
                ok = _near(np.broadcast_to(fps[x], ys.shape), fps[ys],
                           np.broadcast_to(table[x], (len(ys), table.shape[1])), table[ys], max_bits)
                if ok.any():
                    y = int(ys[np.argmax(ok)])
                    sets.join(x, y)
                    edges.append((x, y))
                    break
    return edges


def _links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Edges from rows sorted by (key, fp). A block that a batch cuts off is
    held until its end."""
    key_parts: list[np.ndarray] = []
    fp_parts: list[np.ndarray] = []
    table_parts: list[np.ndarray] = []

    def edges(key: np.ndarray, fps: np.ndarray, table: np.ndarray):
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        small = np.repeat(sizes < MANY, sizes)
        k, f = key[small], fps[small]
        i, j = link_small(k, f, table[small], max_bits)
        a, b = [f[i]], [f[j]]
        for s, m in zip(starts[sizes >= MANY].tolist(), sizes[sizes >= MANY].tolist()):
            block = fps[s:s + m]
            got = np.array(link_dense(block, table[s:s + m], max_bits), np.int64).reshape(-1, 2)
            a.append(block[got[:, 0]])
            b.append(block[got[:, 1]])
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))],
                                          ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        fps = batch.column("fp").to_numpy().view(np.uint64)
        table = np.stack([batch.column(c).to_numpy() for c in TABLE], axis=1).astype("<i8").view(np.int8)
        if key[0] == key[-1] and (not key_parts or key_parts[-1][-1] == key[0]):
            key_parts.append(key)
            fp_parts.append(fps)
            table_parts.append(table)
            continue
        cut = int(np.searchsorted(key, key[-1], "left"))
        yield edges(np.concatenate([*key_parts, key[:cut]]), np.concatenate([*fp_parts, fps[:cut]]),
                    np.concatenate([*table_parts, table[:cut]]))
        key_parts, fp_parts, table_parts = [key[cut:]], [fps[cut:]], [table[cut:]]
    if key_parts:
        yield edges(np.concatenate(key_parts), np.concatenate(fp_parts), np.concatenate(table_parts))


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a > b: edges that connect what links connect. `distinct`: fp,
    each once, and its row of the pivot table (made here where it is missing)."""
    if not set(TABLE) <= set(distinct.columns):
        distinct = distinct.select("fp", *distances(F.col("fp")))
    keys = block_keys(distinct.count(), max_bits)
    values = []
    for i, blocks in enumerate(keys):
        value, at = F.lit(0).cast("long"), 0
        for shift, width in blocks:
            part = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
            value = value.bitwiseOR(F.shiftleft(part, at))
            at += width
        # beyond 55 bits the block values no longer fit beside the number of the key
        values.append(F.shiftleft(F.lit(i).cast("long"), at).bitwiseOR(value) if at <= 54
                      else F.xxhash64(F.lit(i), value))
    rows = distinct.select("fp", *TABLE, F.explode(F.array(*values)).alias("key"))
    return (rows.repartition("key").sortWithinPartitions("key", "fp")
            .mapInArrow(lambda batches: _links(batches, max_bits), "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable; nodes without edges
    do not occur. `edges`: a, b with a > b."""
    edges = staged(edges.select("a", "b"), "edges")
    digest = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    state = edges.agg(*digest).first()
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = staged(both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select(
            "a", F.least("a", "m").alias("m"), "n"), "low")
        large = staged(join_apart(both.where("b > a"), low, "a", "n")
                       .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        low = staged(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "low")
        small = join_apart(large, low, "a", "n")
        edges = staged(small.select("a", F.col("m").alias("b")).unionByName(
            small.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .distinct(), "edges")
        now = edges.agg(*digest).first()
        if now == state:
            roots = edges.select("b").distinct().select(F.col("b").alias("node"),
                                                        F.col("b").alias("root"))
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        state = now


def near_duplicates(docs: DataFrame, width: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of `docs`: doc_id, text_hash, fp (signed long),
    component_id (the smallest doc_id of its component), first (whether this
    is the component's first row by doc_id, then by text_hash; rows that
    repeat both share the mark)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    fps = staged(fingerprints(rows, width, keys=("doc_id", "text_hash")), "fps")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    distinct = fps.groupBy("fp").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n"))
    distinct = staged(distinct.select("*", *distances(F.col("fp"))), "distinct-fps")
    linked = components(links(distinct.select("fp", *TABLE), max_bits))
    member = staged(distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "place", "n", F.coalesce("root", "fp").alias("root")), "members")
    firsts = staged(member.groupBy("root").agg(F.min("place").alias("first_place"),
                                               F.count(F.lit(1)).alias("members")), "firsts")
    named = staged(join_apart(member.select("fp", "n", "root"), firsts, "root", "members").select(
        "fp", "first_place", "n"), "named")
    marked = join_apart(fps, named, "fp", "n")
    return marked.select(
        "doc_id", "text_hash", "fp", F.col("first_place.doc_id").alias("component_id"),
        place.eqNullSafe(F.col("first_place")).alias("first"))


def drop_near_duplicates(docs: DataFrame, width: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """`docs` with one row of each component, its first one."""
    keep = (near_duplicates(docs, width, max_bits).where("first")
            .groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
            .agg(F.count(F.lit(1)).alias("n")))
    return keep_rows(docs, {"id": F.col("doc_id").cast("long"),
                            "hash": F.xxhash64(F.coalesce("text", F.lit("")))}, keep)
