"""Mixing, the corpus pipeline, and the registered queries against SQL."""

import hashlib
import random

import pytest

import corpus_pipeline
from zonecast.llm import mixing, stages, suffix_arrays
from zonecast.llm.oracle import ORACLE_SQL
from zonecast.llm.queries import QUERIES

TABLES = ["documents", "pages", "benchmark", "labels", "conversations", "embeddings"]


def canon(v):
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, sf_small, name):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    cur = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    want = sorted(tuple(map(canon, r)) for r in cur.fetchall())
    df = QUERIES[name](spark, sf_small)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(tuple(map(canon, r)) for r in df.select(*cols).collect()) == want


def test_each_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


# ---- mixing --------------------------------------------------------------

def brute_mix(rows, weights=(5, 2, 1)):
    sizes = [len((t or "").split()) for _, t, _ in rows]
    names = sorted({s for *_, s in rows if s is not None}) + ([None] if any(
        s is None for *_, s in rows) else [])
    size = {s: sum(n for n, r in zip(sizes, rows) if r[2] == s) for s in names}
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, stopped = {}, sum(sizes), set()
    while True:
        room = sum(weight[s] for s in names if s not in stopped)
        share = {s: left * weight[s] / room for s in names if s not in stopped}
        over = {s for s in share if share[s] >= 3 * size[s]}
        if not over:
            return sizes, size, {**target, **share}
        for s in over:
            target[s] = 3 * size[s]
            left -= target[s]
        stopped |= over
        if len(stopped) == len(names):
            return sizes, size, target


def mixed_rows(seed=0):
    rng = random.Random(seed)
    sources = ["a"] * 400 + ["b"] * 20 + ["c"] * 5 + ["Z"] * 60 + [None] * 30 + ["é"] * 90
    rows = [(i, " ".join(["w"] * rng.randrange(60)), s) for i, s in enumerate(sources)]
    return rows + [(1000, None, "a"), (1001, "", "empty"), (None, "x y", "b"), (3, "x y z", "a"),
                   (3, "x y z", "a")]


def test_mix_meets_the_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    monkeypatch.setattr(mixing, "BLOCK_BUCKETS", 3)
    rows = mixed_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(df).collect()
    sizes, size, target = brute_mix(rows)
    assert sorted((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in got
                  if r["doc_id"] is not None) == sorted(
        (i, n, size[s], round(float(target[s]), 6)) for n, (i, _, s) in zip(sizes, rows) if i is not None)
    assert all(r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 3 for r in got)
    taken = {}
    for r in got:
        key = (r["source_size"], round(r["target"], 3))
        taken[key] = taken.get(key, 0) + r["taken"]
    for s in size:
        assert abs(taken[(size[s], round(float(target[s]), 3))] - target[s]) <= 60
    assert sum(taken.values()) <= sum(sizes)
    again = mixing.mix(df.repartition(3)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_mix_defined_cases(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", "s")], "doc_id long, text string, source string")
    assert {(r["taken"], r["target"]) for r in mixing.mix(df).collect()} == {(0, 0.0)}
    assert mixing.mix(df.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "a b", "s", 9, "t"), (2, "c", "s", 8, "u"), (2, "c", "s", 8, "u")],
                                "doc_id long, text string, source string, size long, taken string")
    got = mixing.take_mix(one)
    assert got.columns == [*one.columns, "taken_", "copies"]
    assert sorted((r["doc_id"], r["size"], r["taken_"], r["copies"]) for r in got.collect()) == [
        (1, 9, 2, 1), (2, 8, 2, 2)]


# ---- pipeline ------------------------------------------------------------

def written(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_stages_against_brute_force(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    cols = docs.columns
    assert [f for _, f in corpus_pipeline.STAGES] == [
        stages.quality, stages.exact_dedup, stages.simhash_dedup, stages.decontaminate, stages.mix_sources]

    got = written(spark, stages.quality(spark, docs, sf_small), tmp_path / "0")
    judged = {r["doc_id"]: r["predicted"] for r in QUERIES["op8_pu_quality"](spark, sf_small).collect()}
    assert got.columns == cols
    assert {r["doc_id"] for r in got.collect()} == {i for i, p in judged.items() if p == 1}

    before = got.collect()
    got = written(spark, stages.exact_dedup(spark, got, sf_small), tmp_path / "1")
    last = {}
    for r in before:
        last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
    assert got.columns == cols and {r["doc_id"] for r in got.collect()} == set(last.values())

    from tests.llm.test_exact_and_near import brute_components, brute_fingerprint
    before = sorted(got.collect(), key=lambda r: r["doc_id"])
    got = written(spark, stages.simhash_dedup(spark, got, sf_small), tmp_path / "2")
    roots = brute_components([brute_fingerprint(r["text"]) for r in before])
    assert got.columns == cols
    assert {r["doc_id"] for r in got.collect()} == {before[i]["doc_id"] for i in set(roots)}

    before = got.collect()
    got = written(spark, stages.decontaminate(spark, got, sf_small), tmp_path / "3")
    from tests.llm.test_text import brute_hits
    items = [tuple(r) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    assert got.columns == cols
    assert {r["doc_id"] for r in got.collect()} == {
        r["doc_id"] for r in before if not brute_hits(suffix_arrays.words_of(r["text"]), items)[0]}

    before = got
    got = stages.mix_sources(spark, got, sf_small)
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(before).collect() if r["copies"]}
    assert got.columns == [*cols, "taken", "copies"]
    assert {r["doc_id"]: r["copies"] for r in got.collect()} == want
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert all(digest(r["text"]) == digest(texts[r["doc_id"]]) for r in got.collect())


def test_stages_take_odd_and_empty_tables(spark, sf_small):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, _zc_row string"
    rows = [(1, "some fine words in a row", "en", "s", 1, 0.1, "p"), (1, None, None, None, None, None, None),
            (None, "", "en", "s", 2, 0.2, "q"), (None, "", "en", "s", 2, 0.2, "q"),
            (2, "long " * 30_000, "en", None, 3, 0.3, "r")]
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, sf_small)
            assert out.columns == df.columns
            out.count()
        assert stages.mix_sources(spark, df, sf_small).columns == [*df.columns, "taken", "copies"]
        stages.mix_sources(spark, df, sf_small).count()


def test_run(spark, sf_small):
    out = corpus_pipeline.run(spark, sf_small)
    assert out.count() > 0 and set(out.columns) >= {"doc_id", "text", "taken", "copies"}
