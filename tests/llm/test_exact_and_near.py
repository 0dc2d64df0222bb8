"""Exact dedup (tree merge) and SimHash near-dedup (pivot tables)."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from zonecast.llm import simhash, tree_dedup

DOCS = "doc_id long, text string"


def docs_frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def brute_groups(rows):
    out = []
    for doc_id, text in rows:
        t = text or ""
        ids = [i for i, x in rows if (x or "") == t]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_groups_match_brute_force(spark):
    rng = random.Random(5)
    texts = ["", None, "a", "b ", "b", "B", "é", "x" * 200_000] + [f"t{i}" for i in range(20)]
    rows = [(i, rng.choice(texts)) for i in range(300)] + [(300 + i, "hot") for i in range(1300)]
    rows += [(None, "lost"), (None, "lost"), (None, "a"), (7, "again"), (7, "again")]
    df = docs_frame(spark, rows).repartition(11)
    got = tree_dedup.duplicate_groups(df, fan_in=3)
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"]).hex())
           for r in got.collect()]
    assert sorted(got, key=repr) == brute_groups(rows)


def test_smallest_id_can_stay(spark):
    df = docs_frame(spark, [(3, "a"), (1, "a"), (2, "b")])
    got = {r["doc_id"]: r["keep_id"] for r in tree_dedup.duplicate_groups(df, largest=False).collect()}
    assert got == {3: 1, 1: 1, 2: 2}


def test_drop_duplicates_keeps_columns_and_one_of_repeated_rows(spark):
    rows = [(1, "a", 5, "p"), (2, "a", 6, "q"), (2, "a", 6, "q"), (None, "n", 1, "r"), (3, None, 2, "s"),
            (4, "", 3, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long, digest string")
    got = tree_dedup.drop_duplicates(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(2, "a", 6, "q"), (None, "n", 1, "r"), (4, "", 3, "t")], key=repr)


def test_empty_tables(spark):
    empty = docs_frame(spark, [])
    assert tree_dedup.duplicate_groups(empty).count() == 0
    assert tree_dedup.drop_duplicates(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0


# ---- SimHash -------------------------------------------------------------

def brute_fingerprint(text, width=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\v\f\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [
    None, "", " \t\n", "One", "a b c", "a b c d", "A B  c\nD e", "é É x y z w", "w " * 5000,
    " ".join(f"w{i % 37}" for i in range(3000))])
def test_fingerprint_is_the_bitwise_majority(text, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 700)
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_agrees_with_spark_hash(spark):
    from pyspark.sql import functions as F
    h = spark.sql("select xxhash64('one two three four') h").first()["h"] % 2 ** 64
    assert simhash.fingerprint("One two three FOUR") == h
    assert F is not None


def brute_components(fps, max_bits=4):
    up = list(range(len(fps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, j in combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
            up[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


def flips(rng, fp, n):
    for b in rng.sample(range(64), n):
        fp ^= 1 << b
    return fp


def near_set(rng, centres=6, each=40, far=4):
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        out.add(c)
        for _ in range(each):
            c2 = flips(rng, c, rng.randint(1, far))
            out.add(c2)
            out.add(flips(rng, c2, rng.randint(1, 6)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_dense_blocks_connect_what_links_connect(seed):
    fps = near_set(random.Random(seed))
    table = np.bitwise_count(np.array(fps, np.uint64)[:, None] ^ simhash.pivots()[None, :]).astype(np.int8)
    got = simhash.link_dense(np.array(fps, np.uint64), table, 4)
    assert len(got) < len(fps)
    sets = simhash._Sets(len(fps))
    for i, j in got:
        assert bin(fps[i] ^ fps[j]).count("1") <= 4
        sets.join(i, j)
    assert [sets.root(i) for i in range(len(fps))] == brute_components(fps)


@pytest.mark.parametrize("many", [3, 48])
def test_links_over_whole_tables_lose_nothing(spark, monkeypatch, many):
    monkeypatch.setattr(simhash, "MANY", many)
    rng = random.Random(3)
    fps = sorted(set(near_set(rng, 5, 25)) | {rng.getrandbits(64) for _ in range(400)} | {0, 1})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(5)
    comp = {r["node"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    want = brute_components(fps)
    groups = {}
    for f, w in zip(signed, want):
        groups.setdefault(w, set()).add(f)
    for members in groups.values():
        roots = {comp.get(f, f) for f in members}
        assert roots == {min(members)}


def test_block_keys_agree_somewhere():
    rng = random.Random(1)
    for n in (10, 10 ** 9, 10 ** 11):
        keys = simhash.block_keys(n)
        for _ in range(200):
            a = rng.getrandbits(64)
            b = flips(rng, a, 4)
            assert any(all((a >> s) % (1 << w) == (b >> s) % (1 << w) for s, w in k) for k in keys)


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(9)
    base = [[f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 60, 200]))] for _ in range(25)]
    rows = []
    for k, words in enumerate(base):
        for c in range(4):
            w = list(words)
            if c and len(w) > 3:
                w[rng.randrange(len(w))] = "changed"
            rows.append((100 * c + k, " ".join(w)))
    rows += [(1000, None), (1001, ""), (None, "  "), (5, "x y z"), (5, "x y z"), (1002, "X  y\nz")]
    got = simhash.near_duplicates(docs_frame(spark, rows).repartition(4)).collect()
    fps = sorted({brute_fingerprint(t) for _, t in rows})
    root = dict(zip(fps, brute_components(fps)))
    first = {}
    for i, t in rows:
        if i is not None:
            r = root[brute_fingerprint(t)]
            first[r] = min(first.get(r, i), i)
    want = sorted(((i, brute_fingerprint(t), first.get(root[brute_fingerprint(t)])) for i, t in rows),
                  key=repr)
    assert sorted(((r["doc_id"], r["fp"] % 2 ** 64, r["component_id"]) for r in got), key=repr) == want


def test_one_row_of_each_component_stays(spark):
    rows = [(4, "a b c", "p"), (2, "A b  c", "q"), (9, "other words", "r"), (9, "other words", "r"),
            (None, None, "s"), (6, "", "t"), (6, "  ", "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.drop_near_duplicates(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"], r["fp"]) for r in got.collect() if r["doc_id"] != 6) == [
        (2, "q"), (9, "r")]
    assert sum(r["doc_id"] == 6 for r in got.collect()) == 1


def test_the_pivot_table_holds_the_distances(spark):
    rng = random.Random(2)
    fps = [rng.randrange(-2 ** 63, 2 ** 63) for _ in range(50)] + [0, -1]
    rows = spark.createDataFrame([(f,) for f in fps], "fp long").select(
        "fp", *simhash.distances(F.col("fp"))).collect()
    for r in rows:
        got = [r[c] >> (8 * i) & 255 for c in simhash.TABLE for i in range(8)]
        assert got == [((r["fp"] & 2 ** 64 - 1) ^ int(p)).bit_count() for p in simhash.pivots()]


def test_hot_keys_are_joined_apart_without_a_change(spark, monkeypatch):
    """A group of exact copies and one of near copies, each a third of all."""
    from zonecast.llm import common

    rng = random.Random(4)
    words = ["w%d" % i for i in range(400)]
    base = rng.choices(words, k=300)
    rows = [(i, " ".join(base)) for i in range(60)]
    for i in range(60):
        near = list(base)
        near[rng.randrange(300)] = "other%d" % i
        rows.append((100 + i, " ".join(near)))
    rows += [(200 + i, " ".join(rng.choices(words, k=60))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)

    def result():
        return sorted(map(tuple, simhash.near_duplicates(df).collect()))

    plain = result()
    monkeypatch.setattr(common, "HOT_LEAST", 2)
    monkeypatch.setattr(common, "HOT_KEYS", 50)
    assert result() == plain and len({r[3] for r in plain}) >= 60
