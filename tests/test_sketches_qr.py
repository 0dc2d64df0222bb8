"""G11 sketches that merge, and ridge by QR."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.operators import models, qr, sketches


def test_merged_months_are_close_to_the_whole_table(spark):
    df = spark.range(60_000).select(
        F.concat(F.lit("m"), (F.col("id") % 7).cast("string")).alias("month"),
        F.when(F.col("id") % 10 > 0, (F.col("id") * 7919 % 20_000).cast("double")).alias("x"),
        (F.col("id") % 5000).cast("string").alias("s"), F.lit(1).alias("one"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("t"))
    parts = sketches.month_sketches(df, "month", ["x", "s", "one", "t"])
    assert parts.count() == 28
    got = {r.column_name: r for r in sketches.merged_profile(parts).collect()}
    assert got["x"].n == 60_000 and got["x"].n_null == 6_000 and got["s"].low is None and got["s"].q50 is None
    exact = df.agg(F.count_distinct("x"), F.min("x"), F.max("x")).first()
    assert abs(got["x"].n_distinct - exact[0]) <= sketches.DISTINCT_ERROR * exact[0]
    assert (got["x"].low, got["x"].high) == (exact[1], exact[2])
    assert abs(got["s"].n_distinct - 5000) <= sketches.DISTINCT_ERROR * 5000
    for q in (0.25, 0.5, 0.75):
        share = df.where(F.col("x") <= got["x"][f"q{round(q * 100)}"]).count() / 54_000
        assert abs(share - q) <= sketches.RANK_ERROR
    assert got["one"].n_distinct == 1 and got["one"].q50 == 1.0 and (got["t"].low, got["t"].high) == (0.0, 59_999.0)
    # a new month is added to the stored ones
    first, last = parts.where("month <> 'm6'"), parts.where("month = 'm6'")
    again = {r.column_name: r.n for r in sketches.merged_profile(first.unionByName(last)).collect()}
    assert again == {c: 60_000 for c in got}


def _data(spark, n=600, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2)) * [3, 500] + [12, 1e6]
    y = 4 + x @ [0.5, -0.02] + rng.normal(size=n)
    rows = [(float(a), float(b), float(v), i % 5) for i, ((a, b), v) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "a double, b double, pu_hourly double, fold int")


@pytest.mark.parametrize("alpha", [0.0, 2.5])
def test_qr_equals_gram_sums(spark, alpha):
    _, _, df = _data(spark)
    a = qr.fit_ridge_qr(df.repartition(6), ["a", "b"], alpha=alpha)
    b = models.fit_ridge(df, ["a", "b"], alpha=alpha)
    assert np.allclose(a.coef, b.coef, rtol=1e-8) and math.isclose(a.intercept, b.intercept, rel_tol=1e-8)


def test_search_equals_gram_search(spark):
    _, _, df = _data(spark)
    grid, fit = qr.ridge_search_qr(df, ["a", "b"])
    want, ref = models.ridge_search(df, ["a", "b"])
    assert [a for a, _ in grid] == [a for a, _ in want] and np.allclose([m for _, m in grid], [m for _, m in want], rtol=1e-8)
    assert fit.alpha == ref.alpha and np.allclose(fit.coef, ref.coef, rtol=1e-7)


def test_repeated_and_constant_features_have_least_coefficients(spark):
    x, y, df = _data(spark)
    df = df.withColumns({"a2": F.col("a"), "k": F.lit(5.0)})
    fit = qr.fit_ridge_qr(df, ["a", "a2", "k", "b"], alpha=0.0)
    z = np.column_stack([x[:, 0], x[:, 0], np.full(len(x), 5.0), x[:, 1]])
    w = np.linalg.lstsq(z - z.mean(0), y - y.mean(), rcond=1e-10)[0]
    assert np.allclose(fit.coef, w, atol=1e-8) and math.isclose(fit.coef[0], fit.coef[1], rel_tol=1e-6)
    assert abs(fit.coef[2]) < 1e-9


def test_nearly_equal_features_keep_their_digits(spark):
    rng = np.random.default_rng(1)
    t = rng.normal(size=400)
    e = rng.normal(size=400)
    rows = [(float(u), float(u + 1e-7 * v), float(u + 2e-7 * v), 0) for u, v in zip(t, e)]      # y = 2 b - a
    df = spark.createDataFrame(rows, "a double, b double, pu_hourly double, fold int")
    fit = qr.fit_ridge_qr(df, ["a", "b"], alpha=0.0)
    assert np.allclose(fit.coef, [-1, 2], atol=1e-6)        # the Gram matrix has no digit of this left


def test_a_tree_of_many_tasks_and_missing_rows(spark, monkeypatch):
    monkeypatch.setattr(qr, "FAN_IN", 3)
    _, _, df = _data(spark)
    more = spark.createDataFrame([(None, 1.0, 1.0, 0), (1.0, float("nan"), 1.0, 0), (1.0, 1.0, None, 1)], df.schema)
    f = qr.factors(df.unionByName(more).repartition(40), ["a", "b"], fold_col="fold")
    assert f.dropped == 3 and sum(f.rows.values()) == 600 and sorted(f.by_fold) == [0, 1, 2, 3, 4]
    g = qr.factors(df.coalesce(1), ["a", "b"])
    assert np.allclose(f.without(), g.without(), rtol=1e-9, atol=1e-9)
    with pytest.raises(ValueError, match="no complete"):
        qr.factors(more, ["a", "b"])
    with pytest.raises(ValueError, match="leakage"):
        qr.factors(df, ["pu_hourly"])


def test_fewer_rows_than_features(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 0), (2.0, 1.0, 5.0, 0)], "a double, b double, pu_hourly double, fold int")
    fit = qr.fit_ridge_qr(df, ["a", "b"], alpha=0.0)
    assert np.allclose(fit.coef, [1.0, -1.0]) and math.isclose(fit.intercept, 4.0)
