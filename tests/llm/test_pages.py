"""Page differencing, URL cascade and fixity audit."""

import html as htmllib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.llm import bloom_cascade, fixity, page_diff

PAGES = "page_id long, url string, html string"


def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def is_subsequence(x, y):
    it = iter(y)
    return all(any(v == w for w in it) for v in x)


@pytest.mark.parametrize("bits", [page_diff.LCS_BITS, 40])
def test_shared_lines_are_a_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(page_diff, "LCS_BITS", bits)
    rng = random.Random(bits)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(25))]
        b = [rng.randrange(6) for _ in range(rng.randrange(25))]
        got = page_diff.shared_lines(a, b)
        assert got == sorted(set(got)) and len(got) == brute_lcs(a, b)
        assert is_subsequence([a[i] for i in got], b)


def extracted(spark, rows):
    df = spark.createDataFrame(rows, PAGES)
    return [tuple(r)[:2] for r in page_diff.extract(df, ["page_id"]).collect()]


def test_article_is_found_in_the_test_pages(spark, sf_small):
    """Independent reading of the article element by pattern."""
    rows = spark.read.parquet(f"{sf_small}/pages.parquet").select("page_id", "url", "html").collect()
    got = dict(extracted(spark, rows))
    assert len(got) == len(rows)
    for page_id, _, html in rows:
        inner = re.search(r"<article>(.*?)(</article>|$)", html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", inner))
        want = " ".join(" ".join(htmllib.unescape(x).split()) for x in blocks)
        assert got[page_id] == " ".join(want.split())


def test_lines_shared_with_the_nearest_page_go(spark):
    site = "<div>Top line</div>{}<div>Bottom line</div><div>More of the site</div>"
    rows = [(1, "http://h.org/a/1", site.format("<div>First page</div><p>own</p>")),
            (2, "http://h.org/a/2", site.format("<div>Second page</div>")),
            (3, "http://other.org/a/1", site.format("<div>Third page</div>")),
            (4, "http://mirror.org/x", site.format("same")), (5, "http://mirror.org/y", site.format("same")),
            (6, None, site.format("x")), (7, "no address", "alone")]
    got = dict(extracted(spark, rows))
    whole = "Top line {} Bottom line More of the site"
    assert got == {1: "First page own", 2: "Second page", 3: whole.format("Third page"),
                   4: whole.format("same"), 5: whole.format("same"), 6: whole.format("x"), 7: "alone"}


def test_shared_article_lines_stay_and_marked_parts_go(spark):
    page = ("<html><head><title>t</title></head><body><header>site</header><nav><p>menu</p></nav>"
            "<div class='ad'>buy {0}</div><article><header><h1>Head</h1></header><p>Shared &amp; true"
            "\n  text<br>x<b>y</b>z<p>Own {0}<div class='comments'><article class='comment'>no</article>"
            "</div><form>f</form></article><aside>s</aside><div id='cookie-notice'>ok?</div>"
            "<footer>end</footer><script>var a='</p>';</script>")
    rows = [(i, f"http://h.org/{i}", page.format(i)) for i in (1, 2)]
    assert dict(extracted(spark, rows)) == {i: f"Head Shared & true text xyz Own {i}" for i in (1, 2)}


def test_pages_defined_cases(spark):
    long = "<article>" + "<p>word " * 50_000
    rows = [(1, "http://h.org/1", None), (2, "http://h.org/1", ""), (None, None, None),
            (3, "http://h.org/2", long), (4, "http://h.org/9", "<article><p>x &am"),
            (5, "http://h.org/5", "plain"), (5, "http://h.org/5", "plain")]
    got = sorted(extracted(spark, rows), key=repr)
    assert got == sorted([(1, ""), (2, ""), (None, ""), (3, " ".join(["word"] * 50_000)),
                          (4, "x &am"), (5, "plain"), (5, "plain")], key=repr)
    empty = spark.createDataFrame([], PAGES)
    assert page_diff.extract(empty, ["page_id"]).count() == 0


def test_clashing_columns_and_ranges(spark):
    rows = [(i, f"http://h.org/{i:04d}", f"<div>site</div><div>page {i}</div>", 1) for i in range(200)]
    df = spark.createDataFrame(rows, PAGES + ", host long").repartition(7)
    got = page_diff.extract(df, ["page_id"]).collect()
    assert sorted((r["page_id"], r["text"]) for r in got) == [(i, f"page {i}") for i in range(200)]


# ---- URL cascade ---------------------------------------------------------

def test_kept_columns_may_have_the_names_used_inside(spark):
    names = ["host", "path", "k1", "k2", "lines", "roles", "texts", "gone", "row"]
    kinds = ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([(1, "http://a.b/c", "<article>One &amp; two</article>", *names),
                                (2, None, None, *[None] * len(names))], f"{PAGES}, {kinds}")
    got = page_diff.extract(df, ["page_id", *names]).orderBy("page_id").collect()
    assert [tuple(r)[:-2] for r in got] == [(1, *names, "One & two"), (2, *[None] * len(names), "")]


@pytest.mark.parametrize("inner, text", [
    ("<p>Hi <span class='ad'>Buy</span> there</p>", "Hi there"),
    ("<p>Read <a class='share'>Share</a>on</p>", "Read on"), ("<p>a <span hidden>b</span>c</p>", "a c"),
    ("<p>x <em class='notice'>y</em> <b>z</b></p>", "x z"), ("<p>a <label class='popup'>b <i>c</i></label> d</p>", "a d"),
    ("<p><span class='ad'>all of it</span></p><p>kept</p>", "kept"), ("<p>one<b>two</b>three</p>", "onetwothree"),
])
def test_marked_pieces_inside_a_line_go(spark, inner, text):
    assert extracted(spark, [(1, "http://h.org/1", f"<article>{inner}</article>")]) == [(1, text)]


def test_a_site_header_inside_main_goes_and_an_articles_own_stays(spark):
    rows = [(1, "http://h.org/1", "<main><header>Site</header><p>One</p></main>"),
            (2, "http://h.org/2", "<main><article><header><h1>Head</h1></header><p>Two</p></article></main>")]
    assert dict(extracted(spark, rows)) == {1: "One", 2: "Head Two"}


def test_copies_are_differenced_against_the_nearest_other_page(spark):
    site = "<div>Menu of the site</div>{}<div>Foot of the site</div>"
    rows = [(i, f"http://h.org/a/{i}", site.format("<p>copied</p>")) for i in range(40)]
    rows += [(90, "http://h.org/a/95", site.format("<p>sibling</p>")), (91, "http://z.org/1", site.format("alone"))]
    for parts in (1, 6):
        df = spark.createDataFrame(rows, PAGES).repartition(parts)
        got = {r["page_id"]: (r["text"], r["n_shared"]) for r in page_diff.extract(df, ["page_id"]).collect()}
        assert got == {**{i: ("copied", 2) for i in range(40)}, 90: ("sibling", 2),
                       91: ("Menu of the site alone Foot of the site", 0)}


def test_nearest_other_pages_over_ranges(spark, monkeypatch):
    """Runs that end inside ranges, fill them, and span them."""
    rng = random.Random(6)
    rows, n = [], 0
    for host in ("a", "b", "c"):
        for _ in range(12):
            lines = [rng.randrange(3)]
            for _ in range(rng.choice([1, 1, 2, 9, 30])):
                rows.append((host, f"/{n:04d}", n, 0, lines[0] - 5, lines))
                n += 1
    df = spark.createDataFrame(rows, "host string, path string, k1 long, k2 long, digest long, lines array<long>")
    for ranges in (1, 3, 17, 60):
        spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = {r["k1"]: (r["before"] and r["before"]["path"], r["after"] and r["after"]["path"])
                   for r in page_diff.neighbours(df).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        for i, r in enumerate(rows):
            other = lambda q: (q[0], q[4]) != (r[0], r[4])
            before = next((q[1] for q in reversed(rows[:i]) if other(q)), None)
            after = next((q[1] for q in rows[i + 1:] if other(q)), None)
            assert got[r[2]] == (before, after), (ranges, r)


def test_differencing_deletes_lines_of_the_test_pages(spark, sf_small):
    from zonecast.llm.queries import QUERIES

    got = QUERIES["op4_page_differencing"](spark, sf_small).collect()
    assert sum(r["n_shared"] for r in got) > 0


def test_cascade_is_exact_over_its_universe():
    rng = np.random.default_rng(0)
    universe = rng.integers(-2 ** 63, 2 ** 63 - 1, (20_000, 2))
    listed = universe[:700]
    for rate in (0.5, 0.05):
        first = bloom_cascade.Bloom(listed, rate, 0)
        wrong = universe[700:][first.holds(universe[700:])]
        cascade = bloom_cascade.Cascade(listed, first, wrong)
        assert (cascade.holds(universe) == (np.arange(20_000) < 700)).all()


def brute_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    path = re.match(r"[^?#]*", rest[len(raw):])[0]
    fits = [(len(h + p), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, None, "allow")
    return host, path, best[1], best[2]


def test_verdicts_match_brute_force(spark):
    rng = random.Random(2)
    hosts = ["a.org", "b.a.org", "xa.org", "org", "Sub.B.Com", "com", "c.net", "", "é.org", "a..org"]
    paths = ["", "/", "/en", "/en/1", "/en/12?x=/es/", "/es/#f", "/es/deep/er", "?q", "#x", "/é/ü"]
    urls = [f"{s}{h}{p}" for s in ("http://", "https://") for h in hosts for p in paths]
    urls += [None, "", "org/es/", "http:/a.org/", "x://y://a.org/es/"]
    rules = [("allow", "org", "/"), ("block", "a.org", "/es/"), ("block", "a.org", "/en/1"),
             ("block", "b.com", "/"), ("block", "é.org", "/é")]
    rules += [("block", f"h{i}.test", f"/{rng.random()}") for i in range(300)]
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, "http://a.org/es/"), (0, urls[0])]
    df = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    got = sorted((tuple(r) for r in bloom_cascade.judge(df, rules, ["page_id"]).collect()), key=repr)
    assert got == sorted(((i, *brute_verdict(u, rules)) for i, u in rows), key=repr)


def test_no_rules_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [r["verdict"] for r in bloom_cascade.judge(df, [], ["page_id"]).collect()] == ["allow"]
    none = df.limit(0)
    assert bloom_cascade.judge(none, [("block", "org", "/")], ["page_id"]).count() == 0


# ---- fixity --------------------------------------------------------------

RECORDS = "file string, offset long, content binary"


def brute_audit(left, right):
    def places(rows):
        out = {}
        for f, o, c in rows:
            out.setdefault((f, o), []).append(b"\0" if c is None else b"\1" + bytes(c))
        return {k: sorted(v) for k, v in out.items()}
    a, b = places(left), places(right)
    return sorted(((*k, "missing" if k not in b else "extra" if k not in a else "corrupt")
                   for k in a.keys() | b.keys() if a.get(k) != b.get(k)), key=repr)


@pytest.mark.parametrize("pushed", [0, 64, 10 ** 6])
def test_audit_matches_brute_force(spark, monkeypatch, pushed):
    monkeypatch.setattr(fixity, "PUSHED", pushed)
    rng = random.Random(4)
    left = [(f"f{rng.randrange(40)}", rng.randrange(10 ** rng.randrange(1, 9)), rng.randbytes(30))
            for _ in range(800)]
    left += [("f1", 5, None), ("f1", 6, b""), ("f2", 7, b"twice"), ("f2", 7, b"twice"),
             (None, 3, b"x"), ("f3", None, b"y"), ("big", 8, b"z" * 500_000)]
    right = [r for i, r in enumerate(left) if i % 50 != 7]
    right = [(f, o, c + b"!") if i % 60 == 9 and c else (f, o, c) for i, (f, o, c) in enumerate(right)]
    right += [("new", 0, b"n"), ("f1", 10 ** 8, b"n"), ("f2", 7, b"twice"), ("f1", 6, None)]
    a, b = (spark.createDataFrame(x, RECORDS).withColumn("hash", F.lit("h")).withColumn("group", F.lit(0))
            .repartition(4) for x in (left, right))
    got = fixity.audit(a, b).collect()
    assert sorted(((r["file"], r["offset"], r["status"]) for r in got), key=repr) == brute_audit(left, right)


def scanned(df):
    """Rows that the scans of a finished query gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves, n = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        n += leaves.apply(i).metrics().apply("numOutputRows").value()
    return n


def test_a_descent_reads_what_lies_under_the_difference(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(20_000).select(
            F.concat(F.lit("f"), F.lpad((F.col("id") % 200).cast("string"), 4, "0")).alias("file"),
            (F.floor(F.col("id") / 200) * 50_000).cast("long").alias("offset"),
            F.col("id").cast("string").cast("binary").alias("content"))
        other = rows.withColumn("content", F.when((F.col("file") == "f0042") & (F.col("offset") == 150_000),
                                                  F.lit("x").cast("binary")).otherwise(F.col("content")))
        levels, name_levels = fixity.depth([rows, other])
        a, b = fixity.tree(rows, levels, name_levels), fixity.tree(other, levels, name_levels)
        for i in range(len(a) - 1):
            wrong = a[i + 1].join(b[i + 1], [*fixity.PLACE, "hash"], "left_anti") if i + 1 < levels else a[
                i + 1].alias("x").join(b[i + 1].alias("y"), "hash", "left_anti")
            below = fixity.children(a[i], wrong, i, levels)
            total, read = a[i].count(), scanned(below)
            assert 0 < below.count() <= read
            if total > 5_000:       # a few of forty files
                assert read < total / 4, (i, total, read)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    (r,) = fixity.audit(rows, other).collect()
    assert (r["file"], r["offset"], r["status"]) == ("f0042", 150_000, "corrupt")


def test_pages_without_an_id_have_a_file_of_their_own(spark):
    pages = spark.createDataFrame([(None, "http://a/1", "x"), (None, None, None), (1, "http://a/2", "y" * 100_000)], PAGES)
    got = sorted((r["file"], r["offset"]) for r in fixity.warc_records(pages).collect())
    assert len(got) == 3 and len({f for f, _ in got}) == 2


def test_equal_and_empty_replicas(spark):
    a = spark.createDataFrame([("f", 0, b"x")], RECORDS)
    empty = spark.createDataFrame([], RECORDS)
    assert fixity.audit(a, a).count() == 0
    assert fixity.audit(empty, empty).count() == 0
    assert [r["status"] for r in fixity.audit(a, empty).collect()] == ["missing"]
    assert [r["status"] for r in fixity.audit(empty, a).collect()] == ["extra"]


def test_records_do_not_overlap(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    rows = sorted((r["file"], r["offset"], len(r["content"]))
                  for r in fixity.warc_records(pages, 20).collect())
    assert len(rows) == pages.count()
    for (f, o, n), (f2, o2, _) in zip(rows, rows[1:]):
        assert f != f2 and o2 == 0 or o + n == o2
