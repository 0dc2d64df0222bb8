"""Embedding whitening against numpy's SVD of exactly centred rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.llm import whitening
from zonecast.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors):
    """Covariance and its eigenpairs, from whole numbers."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    dev = n * x - s
    _, sigma, vec = np.linalg.svd(dev.astype(np.float64) / n, full_matrices=False)
    return dev, n, sigma ** 2 / n, vec


def check(got, ids, vectors, k=8, tol=1e-9):
    dev, n, e, vec = brute(vectors)
    k = min(k, int((e > e[0] * 1e-22).sum()))       # the others are rounding errors
    cells = {(r["vec_id"], r["component"]): r for r in got}
    assert len(got) == len(cells) == len(ids) * k
    z = np.array([[cells[i, j + 1]["whitened"] for j in range(k)] for i in ids])
    want = (dev.astype(np.float64) / n) @ vec[:k].T / np.sqrt(e[:k])
    sign = np.sign((z * want).sum(axis=0))
    assert np.abs(z - want * sign).max() < tol
    for i, d in zip(ids, (dev * dev).sum(axis=1)):
        assert cells[i, 1]["deviation"] == (d if d < 2 ** 63 else None) and cells[i, 1]["n"] == n
    assert np.allclose([cells[ids[0], j + 1]["explained"] for j in range(k)], e[:k] / e.sum(), rtol=1e-9)
    c = z - z.mean(axis=0)
    assert np.abs(c.T @ c / n - np.eye(k)).max() < 1e-9
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_query_matches_brute_force(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()
    got = QUERIES["op11_shifted_cholesky_whitening"](spark, sf_small).collect()
    check(got, [r["vec_id"] for r in rows], [r["embedding"] for r in rows], tol=1e-8)


def test_bad_vectors_go_and_repeats_stay(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(60)]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [1.0, float("nan"), 0.0, 0.0, 0.0]),
           (103, [float("inf")] * 5), (104, [float("-inf"), 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(good + bad, SCHEMA).repartition(4)
    check(whitening.whiten(df, ["vec_id"], "embedding").collect(), [i for i, _ in good], [v for _, v in good])
    twice = spark.createDataFrame([*good, (None, good[0][1]), good[3]], SCHEMA)
    got = whitening.whiten(twice, ["vec_id"], "embedding").collect()
    assert len(got) == 62 * 5 and {r["n"] for r in got} == {62}
    assert len([r for r in got if r["vec_id"] is None]) == 5


@pytest.mark.parametrize("kind", ["repeated", "constant", "few", "scaled", "nearly"])
def test_dependent_and_badly_scaled_dimensions(spark, kind):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(200, 6)) * 8
    if kind == "repeated":
        v[:, 4], v[:, 5] = v[:, 1], v[:, 2]
    if kind == "constant":
        v[:, 0] = 3
    if kind == "few":
        v = v[:4]
    if kind == "scaled":
        v *= [1e5, 1, 1e3, 1, 1, 1e4]       # the covariance's condition is about 1e10
    if kind == "nearly":
        v[:, 5] = v[:, 4] + rng.normal(size=200) * 0.002
    v = v.astype(np.float32)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], SCHEMA)
    got = whitening.whiten(df, ["vec_id"], "embedding").collect()
    check(got, list(range(len(v))), v, tol=1e-6)
    assert max(r["component"] for r in got) == {"repeated": 4, "constant": 5, "few": 3}.get(kind, 6)


def test_passes_orthogonalise(spark):
    rng = np.random.default_rng(3)
    v = (rng.normal(size=(500, 12)) @ np.diag(10.0 ** -np.arange(0, 3, 0.25)) * 1000).astype(np.float32)
    rows = whitening.usable(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], SCHEMA), "embedding")
    model = whitening.fit(rows)
    assert 2 <= model.passes <= whitening.MOST_PASSES and model.identity_error < 1e-12
    r = np.triu(rng.normal(size=(70, 70))) + np.eye(70) * 9
    m = rng.normal(size=(11, 70))
    assert np.allclose(whitening.solve_right(m, r) @ r, m)


def test_defined_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty, ["vec_id"], "embedding").count() == 0
    for rows in ([(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA), ["vec_id"], "embedding").count() == 0
    clash = spark.createDataFrame([(1, [1.0, 2.0], "a"), (2, [2.0, 1.0], "b"), (3, [0.0, 5.0], "c")],
                                  "vec_id long, embedding array<double>, whitened string")
    got = whitening.whiten(clash, ["vec_id"], "embedding")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 6
    with pytest.raises(Exception, match="dimensions"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA), ["vec_id"], "embedding").count()
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30]), (2, [1.0])], SCHEMA), ["vec_id"], "embedding").count()


def test_sums_stay_exact_where_longs_would_not():
    sums = whitening.Sums(10 ** 12, (10 ** 12 * 100_001, 5))
    x = np.array([[2 ** 40, 7], [100_000, 0]], np.int64)
    dev = sums.deviations(x)
    assert [[int(c) for c in r] for r in dev] == [[10 ** 12 * 2 ** 40 - 10 ** 12 * 100_001, 7 * 10 ** 12 - 5],
                                                  [-10 ** 12, -5]]


def test_order_and_partitions_do_not_matter(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    a = whitening.fit(whitening.usable(df, "embedding"))
    b = whitening.fit(whitening.usable(df.repartition(7).orderBy(F.desc("vec_id")), "embedding"))
    assert a.sums == b.sums and np.allclose(a.values, b.values, rtol=1e-12)
