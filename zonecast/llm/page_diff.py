"""Main text of web pages by differencing each page against its nearest page.

Pages are ordered by host and path over the whole corpus (a range sort, so a
host with a third of all pages spreads over many tasks). A page's partner is
the nearest page before or after it in that order, on the same host and with
other lines, whose path shares the longer start with its own; copies of a page
show nothing about it and are passed over, also across the ends of ranges. All
lines of both pages (as 64-bit hashes) are aligned by their longest common
subsequence, and shared lines are deleted: menus, headers, footers and whatever
else belongs to the site, marked as such or not.

What differencing leaves open is settled by the page's own markup afterwards.
Lines that are not shared go when they lie inside menus, headers, footers,
sidebars, notices, adverts, forms, comments and the like, as adverts differ
from page to page without being content. Shared lines come back when they lie
inside an `article` or `main` element, as articles of one site may share
passages; where a page marks such an element, nothing else is its main text.
Inside a line, marked pieces (an advert in a span) go by themselves. A page all
of whose text its partner has keeps it. `n_shared` and `n_marked` say how many
of a page's lines each step deleted.

Defined cases: null html or url is empty; pages without a host have no
partner, and their text is settled by markup alone; repeated rows are judged
each, alike; truncated markup is read as far as it goes; texts of any length
are read whole; an empty table gives an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.llm.bloom_cascade import split_url
from zonecast.llm.common import staged

DROP, OTHER, MAIN = 0, 1, 2
LCS_BITS = 1 << 28       # cells whose rows are kept at once; beyond, split in halves

# Elements and names of page parts
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label "
                   "mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
                   "wbr".split())
GONE = frozenset("head title script style noscript template iframe object svg canvas nav footer "
                 "aside form button select textarea dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert "
                  "menu menubar".split())
NAMES = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs "
                  "comment comments consent cookie cookies disqus footer header masthead menu modal "
                  "nav navbar navigation newsletter notice notices popup promo related share "
                  "sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
HEADS = frozenset(["header", "masthead", "banner"])   # inside an article: its own head


class _Lines(HTMLParser):
    """Lines of a page: all their text, the text of their kept pieces, and
    their role."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, str, int]] = []
        self.parts: list[tuple[str, int]] = []
        # element, role, whether inside an article
        self.stack: list[tuple[str, int, bool]] = [("", OTHER, False)]

    def role(self) -> int:
        return self.stack[-1][1]

    def flush(self):
        whole = " ".join("".join(t for t, _ in self.parts).split())
        if whole:
            kept = " ".join("".join(t for t, r in self.parts if r != DROP).split())
            role = max((r for t, r in self.parts if t.strip()), default=DROP)
            self.lines.append((whole, kept, role))
        self.parts.clear()

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and self.stack[-1][0] == tag:
            self.stack.pop()
        role = self.role_of(tag, dict(attrs))
        self.stack.append((tag, role, self.stack[-1][2] or (tag == "article" and role == MAIN)))

    def role_of(self, tag: str, attrs: dict) -> int:
        above = self.role()
        if above == DROP or tag in GONE or "hidden" in attrs or attrs.get("role") in ROLES:
            return DROP
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower()
        named = NAMES.intersection(names.replace("-", " ").replace("_", " ").split())
        if self.stack[-1][2]:
            named -= HEADS              # an article's own head
        elif tag == "header":
            return DROP
        if tag in ("article", "main") or attrs.get("role") in ("main", "article"):
            # comments come as articles, too
            return DROP if named & {"comment", "comments"} else MAIN
        return DROP if named and tag != "body" else above

    def handle_startendtag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        if self.stack[-1][0] not in ("script", "style"):
            self.parts.append((data, self.role()))


def page_lines(html: str | None) -> list[tuple[str, str, int]]:
    """(whole text, kept text, role) of each line, in page order. Where a page
    has main lines, all others are DROP."""
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    lines = parser.lines
    if any(role == MAIN for *_, role in lines):
        lines = [(whole, kept, role if role == MAIN else DROP) for whole, kept, role in lines]
    return lines


def _rows(a: Sequence[int], b: Sequence[int]) -> Iterator[int]:
    """Bit-parallel rows of the LCS table: bit j of row i is 0 where the
    length grows from b[:j] to b[:j+1] against a[:i+1]."""
    at: dict[int, int] = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & at.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _prefix_lengths(a: Sequence[int], b: Sequence[int]) -> np.ndarray:
    """LCS lengths of a against b[:0], b[:1], ..."""
    v = (1 << len(b)) - 1
    for v in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8),
                         bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def shared_lines(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Indexes into `a` of a longest common subsequence of a and b."""
    out: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, ie, j, je = todo.pop()
        while i < ie and j < je and a[i] == b[j]:
            out.append(i)
            i, j = i + 1, j + 1
        while i < ie and j < je and a[ie - 1] == b[je - 1]:
            out.append(ie - 1)
            ie, je = ie - 1, je - 1
        if i == ie or j == je:
            continue
        x, y = a[i:ie], b[j:je]
        if len(x) > 1 and len(x) * len(y) > LCS_BITS:
            half = len(x) // 2
            left = _prefix_lengths(x[:half], y)
            right = _prefix_lengths(x[half:][::-1], y[::-1])[::-1]
            cut = int(np.argmax(left + right))
            todo += [(i, i + half, j, j + cut), (i + half, ie, j + cut, je)]
            continue
        rows = list(_rows(x, y))
        r, c = len(x), len(y)
        while r and c:
            if rows[r - 1] >> (c - 1) & 1:
                c -= 1
            else:
                r -= 1
                if not (r and not rows[r - 1] >> (c - 1) & 1):
                    out.append(i + r)
                    c -= 1
    return sorted(out)


def _common_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def shared_with_partner(path: str, lines: list[int], sides: list[tuple | None]) -> list[int]:
    """Indexes of the lines that the partner has, too. `sides`: (path, lines)
    of the nearest other pages before and after, or None."""
    near = [s for s in sides if s is not None]
    if not near:
        return []
    partner = max(near, key=lambda s: _common_start(path, s[0]))
    return shared_lines(lines, partner[1])


def settled(roles: list[int], shared: set[int]) -> tuple[list[int], int, int]:
    """Which lines stay, and how many differencing and then markup deleted."""
    text = [i for i, r in enumerate(roles) if r != DROP]
    if shared.issuperset(text):
        shared = shared.difference(text)        # nothing would be left of the page
    gone = [i for i in shared if roles[i] != MAIN]
    marked = [i for i, r in enumerate(roles) if r == DROP and i not in shared]
    out = set(gone).union(marked)
    return [i for i in range(len(roles)) if i not in out], len(gone), len(marked)


def _read_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash, role and kept text of each line, no text for those that markup
    drops; and a digest of all hashes."""
    same = ["row", "k1", "k2", "host", "path"]
    for b in batches:
        lines, roles, texts, digests = [], [], [], []
        for html in b.column("html"):
            found = page_lines(html.as_py())
            lines.append(np.array([xxhash.xxh64_intdigest(t) for t, *_ in found], np.uint64).view(np.int64))
            digests.append(xxhash.xxh64_intdigest(lines[-1].tobytes()) - 2 ** 63)
            roles.append([r for *_, r in found])
            texts.append([None if r == DROP else t for _, t, r in found])
        yield pa.RecordBatch.from_arrays(
            [*[b.column(c) for c in same], pa.array(digests, pa.int64()), pa.array(lines, pa.list_(pa.int64())),
             pa.array(roles, pa.list_(pa.int8())), pa.array(texts, pa.list_(pa.string()))],
            [*same, "digest", "lines", "roles", "texts"])


def neighbours(pages: DataFrame) -> DataFrame:
    """`pages` (host, path, k1, k2, digest and lines) with `before` and
    `after`: the nearest rows in the order of (host, path, k1, k2) over the
    whole table with another host or digest, as structs (host, path, lines);
    null at its ends.

    Rows of one host and digest that follow each other are a run. Inside a
    range the row before a run is carried along it; what lies before a range's
    first run follows from the ranges' ends, one row per range."""
    order = ["host", "path", "k1", "k2"]
    side = F.struct("host", "path", "lines")
    rows = staged(pages.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("part", F.spark_partition_id()), "page-order")
    run = F.struct("host", "digest")
    inside = W.partitionBy("part").orderBy(*order)

    def along(name: str, w, step) -> Column:
        """The row next to each row's run, on one side, within the range."""
        first = ~run.eqNullSafe(step(run).over(w))
        return F.last(F.when(first, step(side).over(w)), ignorenulls=True).over(
            w.rowsBetween(W.unboundedPreceding, 0)).alias(name)

    back = W.partitionBy("part").orderBy(*[F.desc(c) for c in order])
    rows = rows.select("*", run.alias("run"), along("lag", inside, F.lag), along("lead", back, F.lag))
    place = F.struct(*order)
    ends = rows.groupBy("part").agg(
        F.min_by("run", place).alias("first_run"), F.max_by("run", place).alias("last_run"),
        F.min_by(side, place).alias("first"), F.max_by(side, place).alias("last"),
        F.max_by("lag", place).alias("before_last"), F.min_by("lead", place).alias("after_first"))
    by_part = W.orderBy("part")         # one row per range
    to_here, from_here = (by_part.rowsBetween(W.unboundedPreceding, 0),
                          by_part.rowsBetween(0, W.unboundedFollowing))
    # what lies before the run that ends a range; where that run is all of the
    # range and goes on from the range before, what lies before it there
    previous, following = F.lag("last_run").over(by_part), F.lead("first_run").over(by_part)
    ends = ends.withColumns({
        "previous": previous, "following": following,
        "own_before": F.coalesce("before_last", F.when(previous != F.col("first_run"), F.lag("last").over(by_part))),
        "own_after": F.coalesce("after_first", F.when(following != F.col("last_run"), F.lead("first").over(by_part)))})
    ends = ends.withColumns({"to_end": F.last("own_before", ignorenulls=True).over(to_here),
                             "to_start": F.first("own_after", ignorenulls=True).over(from_here)})
    ends = ends.select(
        "part",
        F.when(F.col("previous") == F.col("first_run"), F.lag("to_end").over(by_part))
         .otherwise(F.lag("last").over(by_part)).alias("range_before"),
        F.when(F.col("following") == F.col("last_run"), F.lead("to_start").over(by_part))
         .otherwise(F.lead("first").over(by_part)).alias("range_after"))
    return rows.join(ends, "part").select(
        *pages.columns, F.coalesce("lag", "range_before").alias("before"),
        F.coalesce("lead", "range_after").alias("after"))


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = b.to_pylist()
        shared = [shared_with_partner(r["path"], r["lines"], [
            (s["path"], s["lines"]) if s and r["host"] and s["host"] == r["host"] else None
            for s in (r["before"], r["after"])]) for r in rows]
        some = [i for i, g in enumerate(shared) if g]
        yield pa.RecordBatch.from_arrays(
            [*[b.column(c).take(pa.array(some, pa.int32())) for c in ("k1", "k2")],
             pa.array([shared[i] for i in some], pa.list_(pa.int32()))], ["k1", "k2", "shared"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out, n_shared, n_marked = [], [], []
        for texts, roles, shared in zip(*(b.column(c).to_pylist() for c in ("texts", "roles", "shared"))):
            stay, by_partner, by_markup = settled(roles, set(shared or ()))
            out.append(" ".join(texts[i] for i in stay if texts[i]))
            n_shared.append(by_partner)
            n_marked.append(by_markup)
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), pa.array(out, pa.string()), pa.array(n_shared, pa.int64()),
             pa.array(n_marked, pa.int64())], ["row", "text", "n_shared", "n_marked"])


def extract(pages: DataFrame, keep: list[str]) -> DataFrame:
    """`keep`, text, n_shared and n_marked (lines that differencing and then
    markup deleted) of every row of `pages` (page_id, url, html).

    Each page is parsed once; its lines are written, and the html is not read
    again. Only hashes of lines are shuffled to find what to delete. The
    deletions are then joined to the lines by a 128-bit key of the whole row:
    they are written first, so Spark knows their size, and broadcasts them
    only if that is below its threshold.
    """
    host, path = split_url(F.col("url"))
    whole = [F.col(c) for c in ("page_id", "url", "html")]
    rows = pages.select(F.struct(*keep).alias("row"), F.xxhash64(F.lit(1), *whole).alias("k1"),
                        F.xxhash64(F.lit(2), *whole).alias("k2"), host.alias("host"),
                        path.alias("path"), "html")
    read = T.StructType([rows.schema[c] for c in ("row", "k1", "k2", "host", "path")])
    read = (read.add("digest", T.LongType()).add("lines", T.ArrayType(T.LongType())).add("roles", T.ArrayType(T.ByteType()))
            .add("texts", T.ArrayType(T.StringType())))
    lines = staged(rows.mapInArrow(_read_lines, read), "page-lines", "zstd")
    shared = staged(neighbours(lines.drop("row", "roles", "texts"))
                    .mapInArrow(_differences, "k1 long, k2 long, shared array<int>")
                    .groupBy("k1", "k2").agg(F.min("shared").alias("shared")), "page-shared")
    out = T.StructType([rows.schema["row"], T.StructField("text", T.StringType()),
                        T.StructField("n_shared", T.LongType()), T.StructField("n_marked", T.LongType())])
    return (lines.join(shared, ["k1", "k2"], "left").select("row", "texts", "roles", "shared")
            .mapInArrow(_texts, out).select("row.*", *out.names[1:]))
