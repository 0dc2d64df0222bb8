"""Benchmark decontamination with suffix arrays over the training text.

The documents of a task are cut into shards of about `SHARD_WORDS` words.
Each shard becomes a word-level suffix array, and every suffix of every
benchmark item is looked up in it by binary search, word by word: the
interval after d words holds exactly the places where its first d words occur
verbatim, the last non-empty interval gives its longest match, and the
interval after `WINDOW` words gives the occurrences of the window that starts
there.

A shard's suffix array is sparse, without loss: a suffix that starts with
fewer benchmark words in a row than the shortest window can hold no window,
so only runs of that many words from the benchmark's vocabulary are sorted.

The benchmark goes to the tasks in blocks of at most `BLOCK_BYTES` of text;
a larger benchmark takes several rounds over the documents, with the state
of a round (hit words and items so far) written to the shared folder.

Defined cases: null or wordless texts have no words and no hits; wordless
items have no window; an item of fewer than `WINDOW` words is one window;
items with equal ids count as one item, null item ids hit but are not listed;
repeated documents are judged each; an empty table on either side gives no
hits. Documents of any length are searched whole (a long one is its own
shard); other columns of the inputs are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import free_name, staged, with_free_columns

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 32 << 20

# Bytes to words: A-Z lower-cased; 0-9, a-z and all bytes of non-ASCII
# characters are kept; everything else parts words.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A
    else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
    else 0x20
    for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Benchmark:
    """Suffixes and windows of one block of items, as word numbers (from 1;
    0 stands for any word outside the block's vocabulary)."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        self.items: list[str | None] = []
        words: list[int] = []
        depth: list[int] = []       # words from here to the item's end
        need: list[int] = []        # length of the window that starts here, or 0
        owner: list[int] = []
        for item_id, text in items:
            found = words_of(text)
            n = len(found)
            if not n:
                continue
            words += [self.vocab.setdefault(w, len(self.vocab) + 1) for w in found]
            depth += range(n, 0, -1)
            size = min(window, n)
            need += [size if i + size <= n else 0 for i in range(n)]
            owner += [len(self.items)] * n
            self.items.append(None if item_id is None else str(item_id))
        self.words = np.array(words + [-1], np.int64)
        self.depth, self.need, self.owner = (np.array(x, np.int64) for x in (depth, need, owner))
        self.shortest = int(self.need[self.need > 0].min()) if words else 0

    def search(self, text: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Binary search of all suffixes in suffix array `sa` of `text`:
        their longest match, and the interval of their window (empty if it
        does not occur)."""
        n = len(self.depth)
        longest, w_lo, w_hi = (np.zeros(n, np.int64) for _ in range(3))
        who = np.arange(n)
        lo, hi = np.zeros(n, np.int64), np.full(n, len(sa), np.int64)
        d = 0
        while who.size:
            want = self.words[who + d]

            def bound(low, high, right):
                low, high = low.copy(), high.copy()
                while (go := low < high).any():
                    mid = (low + high) // 2
                    at = text[np.minimum(sa[np.minimum(mid, len(sa) - 1)] + d, len(text) - 1)]
                    up = go & ((at <= want) if right else (at < want))
                    low = np.where(up, mid + 1, low)
                    high = np.where(go & ~up, mid, high)
                return low

            lo, hi = bound(lo, hi, False), bound(lo, hi, True)
            d += 1
            live = lo < hi
            who, lo, hi = who[live], lo[live], hi[live]
            longest[who] = d
            at_window = self.need[who] == d
            w_lo[who[at_window]], w_hi[who[at_window]] = lo[at_window], hi[at_window]
            go_on = self.depth[who] > d
            who, lo, hi = who[go_on], lo[go_on], hi[go_on]
        return longest, w_lo, w_hi


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes of `text` by their first `depth` words at least
    (prefix doubling); words past the end count as smallest."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    k = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:-k or None] = rank[k:] if k < n else 0
        pair = rank * (n + 2) + ahead
        sa = np.argsort(pair, kind="stable")
        ordered = pair[sa]
        new = np.cumsum(np.concatenate([[1], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
        rank = np.empty(n, np.int64)
        rank[sa] = new
        k *= 2
        if k >= depth or k >= n or new[-1] == n:
            return sa


def _runs(ids: np.ndarray, shortest: int) -> np.ndarray:
    """Positions in runs of at least `shortest` vocabulary words."""
    known = np.concatenate([[0], (ids > 0).astype(np.int8), [0]])
    step = np.diff(known)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    long_enough = ends - starts >= shortest
    mark = np.zeros(len(ids) + 1, np.int64)
    np.add.at(mark, starts[long_enough], 1)
    np.add.at(mark, ends[long_enough], -1)
    return np.flatnonzero(np.cumsum(mark)[:-1])


def shard_matches(bench: Benchmark, texts: list[list[bytes]]):
    """For each document of a shard: (hit spans [(start, end), ...] merged,
    item numbers, longest match as (item number, words, start) or None)."""
    out = [([], [], None) for _ in texts]
    get = bench.vocab.get
    parts = []
    for words in texts:
        parts.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
        parts.append(np.zeros(1, np.int64))
    if not parts or not bench.shortest:
        return out
    ids = np.concatenate(parts)
    ends = np.cumsum([len(w) + 1 for w in texts])
    at = _runs(ids, bench.shortest)
    if not at.size:
        return out
    # runs stay apart: a gap in the positions gets a separator of its own
    gap = np.concatenate([np.diff(at) != 1, [True]])
    place = np.arange(len(at)) + np.concatenate([[0], np.cumsum(gap)[:-1]])
    text = np.zeros(place[-1] + 2, np.int64)
    origin = np.full(len(text), -1, np.int64)
    text[place], origin[place] = ids[at], at
    sa = suffix_array(text, int(bench.depth.max()))
    longest, lo, hi = bench.search(text, sa)

    best: dict[int, tuple[int, int, int]] = {}
    hits: dict[int, tuple[list, set]] = {}
    seen: set[tuple[int, int]] = set()
    for j in np.flatnonzero(hi > lo).tolist():
        at, size = np.sort(sa[lo[j]:hi[j]]), int(bench.need[j])
        length = np.full(len(at), size)
        on, d = np.arange(len(at)), size
        while on.size and d < longest[j]:       # how far each occurrence goes on
            on = on[text[at[on] + d] == bench.words[j + d]]
            d += 1
            length[on] = d
        where = origin[at]
        doc = np.searchsorted(ends, where, "right")
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        window = (int(lo[j]), size)
        for s, e in zip(first.tolist(), [*first[1:].tolist(), len(doc)]):
            k = int(doc[s])
            begin = int(ends[k]) - len(texts[k]) - 1
            spans, items = hits.setdefault(k, ([], set()))
            items.add(int(bench.owner[j]))
            if window not in seen:              # else an equal window has told its places
                spans += [(p - begin, p - begin + size) for p in where[s:e].tolist()]
            far = s + int(np.argmax(length[s:e]))
            if length[far] > best.get(k, (0, 0, 0))[1]:
                best[k] = (int(bench.owner[j]), int(length[far]), int(where[far]) - begin)
        seen.add(window)
    for k, (spans, items) in hits.items():
        out[k] = (merge_spans(spans), sorted(items), best[k])
    return out


def merge_spans(spans) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    return [tuple(x) for x in merged]


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The benchmark's items in blocks of bounded size, streamed."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        block.append((row[0], row[1]))
        size += 64 + len(row[1] or "")
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


STATE = ("spans array<struct<start:long,end:long>>, items array<string>, "
         "longest struct<item_id:string,words:long,start:long>")


def _search(batches: Iterator[pa.RecordBatch], shared, keep: list[str]) -> Iterator[pa.RecordBatch]:
    """One shard after another; adds what it finds to the rows' state."""
    bench = shared.value
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    match = pa.struct([("item_id", pa.string()), ("words", pa.int64()), ("start", pa.int64())])

    def searched(rows: pa.Table, texts: list[list[bytes]]):
        state = zip(shard_matches(bench, texts), *[rows.column(c).to_pylist() for c in (
            "spans", "items", "longest")])
        spans, items, longest = [], [], []
        for (new, who, best), old, names, was in state:
            spans.append([{"start": s, "end": e} for s, e in merge_spans(
                [*[(x["start"], x["end"]) for x in old or ()], *new])])
            items.append(sorted({*(names or ()), *(
                bench.items[w] for w in who if bench.items[w] is not None)}))
            if best and (was is None or best[1] > was["words"]):
                was = {"item_id": bench.items[best[0]], "words": best[1], "start": best[2]}
            longest.append(was)
        out = [pa.array(spans, span), pa.array(items, pa.list_(pa.string())),
               pa.array(longest, match), pa.array([len(t) for t in texts], pa.int64())]
        table = pa.Table.from_arrays([*[rows.column(k) for k in keep], *out],
                                     names=[*keep, "spans", "items", "longest", "n_words"])
        return table.combine_chunks().to_batches()

    parts: list[pa.RecordBatch] = []
    texts: list[list[bytes]] = []
    size = 0
    for batch in batches:
        start = 0
        for i, text in enumerate(batch.column("text")):
            texts.append(words_of(text.as_py()))
            size += len(texts[-1])
            if size >= SHARD_WORDS:
                parts.append(batch.slice(start, i + 1 - start))
                yield from searched(pa.Table.from_batches(parts), texts)
                parts, texts, size, start = [], [], 0, i + 1
        if start < batch.num_rows:
            parts.append(batch.slice(start))
    if texts:
        yield from searched(pa.Table.from_batches(parts), texts)


def matches(docs: DataFrame, benchmark: DataFrame, keys: list[str], window: int = WINDOW,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`keys` of every row of `docs` (its columns other than `keys` and `text`
    are not read), and n_words, spans (merged hits, in words), items (ids with
    an occurring window), longest (the longest verbatim match of at least a
    window, and where it starts)."""
    spark = docs.sparkSession
    fields = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    none = spark.createDataFrame([], STATE).schema.fields
    rows = docs.select(*keys, "text", *[F.lit(None).cast(f.dataType).alias(f.name) for f in none])
    todo = blocks(benchmark, block_bytes)
    block = next(todo, [])
    while True:
        after = next(todo, None)
        kept, schema = (keys, fields) if after is None else ([*keys, "text"], f"{fields}, text string")
        shared = spark.sparkContext.broadcast(Benchmark(block, window))
        rows = rows.mapInArrow(lambda b, s=shared, k=kept: _search(b, s, k),
                               f"{schema}, {STATE}, n_words long")
        if after is None:
            return rows
        rows, block = staged(rows, "matches").drop("n_words"), after


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated."""
    rows = matches(docs, benchmark, ["doc_id"], window, block_bytes)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"),
                        lambda n, s: n + s["end"] - s["start"])
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` without the rows that hold a window of the benchmark. The rows
    pass through the search with all their columns, so nothing is joined."""
    work, names = with_free_columns(docs, text=F.col("text"))
    inner = free_name(docs.columns, "_zc_row")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(inner)
    found = matches(work.select(row, F.col(names["text"]).alias("text")), benchmark, [inner],
                    window, block_bytes)
    return found.where(F.size("spans") == 0).select(f"{inner}.*")
