"""URL filtering with a Bloom filter cascade.

A rule is a host and the start of a path; it fits its host, all subdomains,
and every path that starts so. A page's keys are therefore the suffixes of
its host (by label) joined with the starts of its path; of the latter only
lengths that some rule has can be listed, so only these are formed.

Per verdict (allow, block) one cascade holds the listed keys. Level 0 is a
Bloom filter of the listed keys; level 1 encodes the keys of the corpus that
level 0 takes for listed ones; level 2 the listed keys that level 1 takes for
one of these; and so on until nothing is left. The first level that does not
hold a key settles it by its parity. Since the levels are built against the
complete key universe of the corpus, membership is exact for each of its keys,
and pages are judged by lookups alone: no join. Keys are compared by 128 bits
of hash.

The universe never leaves the tasks: it is counted (for the filters' sizes)
and filtered by level 0 there, and only the false positives, about as many as
listed keys, reach the driver, in bounded number: a level that lets more
through is built anew with more bits. `MAX_LISTED` bounds the listed keys, and
with them all filters that are sent to the tasks.

Defined cases: a url without `://`, empty or null has empty host and path and
fits no rule; a page that no rule fits is allowed; of fitting rules the
longest (host and path together) wins, by code point if equally long; repeated
rows are judged each; an empty table gives an empty result; no rules: all
pages are allowed; other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LISTED = 4_000_000
MAX_LEVELS = 200         # a level halves what is left
SEEDS = (42, 43)
PART = "\x1f"            # between host and path of a key; occurs in no host

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url):
    """(host, path) columns of a url column."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(F.coalesce(after, F.lit("")), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def key_hashes(host: str, path: str) -> tuple[int, int]:
    """Two 64-bit hashes of a key, as signed numbers."""
    raw = f"{host}{PART}{path}".encode()
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    return tuple(signed(xxhash.xxh64_intdigest(raw, s)) for s in SEEDS)


class Bloom:
    def __init__(self, keys: np.ndarray, rate: float, salt: int):
        n = max(1, len(keys))
        self.hashes = max(1, round(-math.log2(rate)))
        self.bits = max(64, math.ceil(n * self.hashes / math.log(2)))
        self.salt = np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        self.table = np.zeros((self.bits + 7) // 8, np.uint8)
        for at in self._places(keys):
            np.bitwise_or.at(self.table, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def _places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        # both hashes are mixed with the level's salt, so that keys which
        # collide on one level do not do so on the next
        a = np.ascontiguousarray(keys[:, 0]).view(np.uint64) + self.salt
        b = np.ascontiguousarray(keys[:, 1]).view(np.uint64)
        for i in range(self.hashes):
            step = np.uint64(i * int(self.salt) & (1 << 64) - 1)
            mixed = (a ^ (b + step)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            yield ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(self.bits)).astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in self._places(keys):
            out &= (self.table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


class Cascade:
    """Exact membership over a universe: `levels` alternate listed keys and
    false positives."""

    def __init__(self, listed: np.ndarray, first: Bloom, wrong: np.ndarray):
        self.levels = [first]
        inside, outside = wrong, listed     # the next level encodes `inside`
        while len(inside):
            if len(self.levels) > MAX_LEVELS:
                raise ValueError("a listed key and another one have the same hashes")
            level = Bloom(inside, 0.5, len(self.levels))
            self.levels.append(level)
            inside, outside = outside[level.holds(outside)], inside

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        open_ = np.arange(len(keys))
        for i, level in enumerate(self.levels):
            passed = level.holds(keys[open_])
            out[open_[~passed]] = i % 2 == 1
            open_ = open_[passed]
        out[open_] = (len(self.levels) - 1) % 2 == 0
        return out


def candidate_keys(pages: DataFrame, lengths: list[int], keep: list[str]) -> DataFrame:
    """`keep`, host, path and keys: an array of (rule, a, b), the page's
    candidate keys with their hashes, longest first."""
    host, path = split_url(F.col("url"))
    rows = pages.select(*keep, host.alias("host"), path.alias("path"))
    # host suffixes of one label, two labels, ...
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, -i, i), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"),
                       lambda n: n <= F.length("path"))
    def key(h, n):
        start = F.substring(F.col("path"), F.lit(1), n)
        name = F.concat(h, F.lit(PART), start)
        return F.struct(F.length(F.concat(h, start)).alias("n"), F.concat(h, start).alias("rule"),
                        name.alias("name"))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(fitting, lambda n: key(h, n))))
    keys = F.when(F.col("host") == "", F.array().cast("array<struct<n:int,rule:string,name:string>>")
                  ).otherwise(F.reverse(F.array_sort(keys)))
    return rows.select(*keep, "host", "path", keys.alias("keys"))


def _hashed(names: pa.Array) -> np.ndarray:
    """(n, 2) signed hashes of key names."""
    out = np.empty((len(names), 2), np.int64)
    for i, name in enumerate(names.to_pylist()):
        raw = name.encode()
        for j, seed in enumerate(SEEDS):
            out[i, j] = np.uint64(xxhash.xxh64_intdigest(raw, seed)).astype(np.int64)
    return out


def build(keys: DataFrame, listed: list[tuple[str, str]], universe: int) -> Cascade:
    """`keys`: name, the corpus's candidate keys; `universe`: about how many
    distinct ones there are."""
    if len(listed) > MAX_LISTED:
        raise ValueError(f"more than {MAX_LISTED} listed keys: split the list")
    mine = np.array([key_hashes(*k) for k in listed], np.int64).reshape(-1, 2)
    own = {tuple(k) for k in mine.tolist()}
    # a rate at which about as many false positives come as keys are listed
    rate = min(0.5, max(1e-12, math.sqrt(2) * max(1, len(own)) / max(1, universe)))
    most = 10 * len(own) + 1000
    while True:
        first = Bloom(mine, rate, 0)
        if not len(mine):
            return Cascade(mine, first, np.zeros((0, 2), np.int64))

        def passed(batches, first=first):
            for b in batches:
                h = _hashed(b.column("name"))
                h = h[first.holds(h)]
                h = h[[tuple(k) not in own for k in h.tolist()]] if len(h) else h
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1])], ["a", "b"])

        wrong = (keys.select("name").mapInArrow(passed, "a long, b long").distinct()
                 .limit(most + 1).collect())
        if len(wrong) <= most:
            return Cascade(mine, first, np.array([tuple(r) for r in wrong], np.int64).reshape(-1, 2))
        rate /= 16          # too many: a larger first level, all keys once more


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], keep: list[str],
          default: str = "allow") -> DataFrame:
    """`keep`, host, path, rule (the rule that decides, or null), verdict.
    `rules`: (verdict, host, path). Pages without a rule get `default`."""
    spark = pages.sparkSession
    lengths = sorted({len(p) for _, _, p in rules})
    cand = candidate_keys(pages, lengths, keep)
    names = cand.select(F.explode("keys").alias("k")).select("k.name")
    universe = names.agg(F.approx_count_distinct("name")).first()[0] if rules else 0
    verdicts = sorted({v for v, _, _ in rules})
    cascades = {v: build(names, [(h, p) for x, h, p in rules if x == v], universe)
                for v in verdicts}
    shared = spark.sparkContext.broadcast(cascades)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column("keys")
            flat = keys.flatten()
            owner = np.repeat(np.arange(b.num_rows), np.diff(keys.offsets.to_numpy()))
            h = _hashed(flat.field("name"))
            rule: list[str | None] = [None] * b.num_rows
            verdict = [default] * b.num_rows
            best = np.full(b.num_rows, len(flat))
            for v, cascade in shared.value.items():
                at = np.flatnonzero(cascade.holds(h)) if len(h) else np.zeros(0, np.int64)
                # keys are in order, longest first
                for i in at[::-1].tolist():
                    k = int(owner[i])
                    if i < best[k]:
                        best[k] = i
                        rule[k], verdict[k] = flat.field("rule")[i].as_py(), v
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in [*keep, "host", "path"]],
                 pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                [*keep, "host", "path", "rule", "verdict"])

    fields = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keep)
    return cand.mapInArrow(judged, f"{fields}, host string, path string, rule string, verdict string")
