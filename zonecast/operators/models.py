"""Demand models: splits, ridge, metrics (M1-M7); `trees` has M8 and M9.

* Splits are deterministic hash buckets of the row key (md5 -> first 8 hex
  digits -> integer -> mod 100), so every engine and every partitioning
  assigns the same rows; `randomSplit` depends on partition layout.
* Ridge (intercept unpenalised, features unscaled) is fitted from Gram sums:
  one aggregate over the data, grouped by fold, returns k rows of p^2 sums;
  the p x p systems are solved on the driver. Training sums for fold j are
  total - fold j, and validation error comes from fold j's sums, so the whole
  alpha x fold grid costs ONE pass over the data and no refits. Features are
  shifted by their training means (a first, one-row aggregate) to avoid
  cancellation in the sums.
* Prediction and metrics are column expressions / one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL = "pu_hourly"
# The surveyed ridge grid (alpha = 1, 3, ..., 15), 5 folds.
RIDGE_ALPHAS = (1, 3, 5, 7, 9, 11, 13, 15)
N_FOLDS = 5
ROW_KEY = ("locationid", "year", "month", "dayofmonth", "hour")


def check_features(features: Sequence[str], label: str) -> None:
    """Refuse a feature list that contains the label (label leakage)."""
    if label in features:
        raise ValueError(f"label {label!r} is among the features: leakage")
    if not features:
        raise ValueError("no features")


# --- M1 / M2: splits ----------------------------------------------------------

def row_bucket(key_cols: Sequence[str] = ROW_KEY, modulo: int = 100) -> Column:
    """Deterministic bucket in [0, modulo) from the row key text."""
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in key_cols])
    h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return (h % modulo).cast("int")


def with_splits(df: DataFrame, train_period: Column, train_fraction: float = 0.7,
                test_fraction: float = 1.0, key_cols: Sequence[str] = ROW_KEY) -> DataFrame:
    """M1 + M2: inside the training period `split` is 'train' (hash bucket
    < train_fraction * 100) or 'validation'; outside it 'test'. With a
    `test_fraction` below 1 only buckets below it are 'test' and the others
    'unused' (the surveyed workload scores the first part of a second split
    of its test year, 0.7). `fold` in [0, 5) for the grid search. One
    projection, no shuffle."""
    b = row_bucket(key_cols)
    cut = int(round(train_fraction * 100))
    test_cut = int(round(test_fraction * 100))
    bucket = F.col("bucket")
    return df.withColumns({"bucket": b}).withColumns({
        "split": F.when(~train_period, F.when(bucket < test_cut, "test").otherwise("unused"))
                  .when(bucket < cut, "train").otherwise("validation"),
        "fold": (bucket % N_FOLDS).cast("int"),
    })


# --- M3 / M4 / M7: ridge by Gram sums ------------------------------------------

@dataclass(frozen=True)
class RidgeFit:
    features: tuple[str, ...]
    alpha: float
    coef: tuple[float, ...]
    intercept: float
    dropped: int = 0        # training rows left out: a feature or the label is missing

    def predict(self) -> Column:
        """M5: the prediction as a column expression (JVM-side)."""
        expr = F.lit(float(self.intercept))
        for f, w in zip(self.features, self.coef):
            expr = expr + F.lit(float(w)) * F.col(f).cast("double")
        return expr


@dataclass
class _Sums:
    n: float
    sx: np.ndarray      # (p,)
    sy: float
    sxx: np.ndarray     # (p, p)
    sxy: np.ndarray     # (p,)
    syy: float

    def __sub__(self, o: "_Sums") -> "_Sums":
        return _Sums(self.n - o.n, self.sx - o.sx, self.sy - o.sy, self.sxx - o.sxx,
                     self.sxy - o.sxy, self.syy - o.syy)

    def __add__(self, o: "_Sums") -> "_Sums":
        return _Sums(self.n + o.n, self.sx + o.sx, self.sy + o.sy, self.sxx + o.sxx,
                     self.sxy + o.sxy, self.syy + o.syy)


def complete_rows(features: Sequence[str], label: str) -> Column:
    """Rows with every feature and the label: neither NULL nor NaN."""
    ok = F.lit(True)
    for c in (*features, label):
        x = F.col(c).cast("double")
        ok = ok & x.isNotNull() & ~F.isnan(x)
    return ok


def _means(df: DataFrame, features: Sequence[str], label: str) -> tuple[np.ndarray, float, int]:
    """Means over the complete rows, and the number of other rows."""
    ok = complete_rows(features, label)
    row = df.agg(*[F.avg(F.when(ok, F.col(f).cast("double"))).alias(f"m{i}")
                   for i, f in enumerate(features)],
                 F.avg(F.when(ok, F.col(label).cast("double"))).alias("my"),
                 F.count_if(~ok).alias("dropped")).first()
    if row["my"] is None:
        raise ValueError("no complete training rows")
    return (np.array([row[f"m{i}"] for i in range(len(features))], dtype=float), row["my"],
            int(row["dropped"]))


def _gram(df: DataFrame, features: Sequence[str], label: str, mx: np.ndarray, my: float,
          by: str | None = None) -> dict:
    """One aggregate over the complete rows: n, sums, cross-products of the
    shifted values."""
    p = len(features)
    df = df.where(complete_rows(features, label))
    x = [F.col(f).cast("double") - F.lit(float(m)) for f, m in zip(features, mx)]
    y = F.col(label).cast("double") - F.lit(float(my))
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    aggs += [F.sum(x[i]).alias(f"s{i}") for i in range(p)]
    aggs += [F.sum(x[i] * y).alias(f"s{i}y") for i in range(p)]
    aggs += [F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)]
    rows = (df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)).collect()
    out = {}
    for r in rows:
        sxx = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                sxx[i, j] = sxx[j, i] = r[f"s{i}_{j}"]
        out[r[by] if by else 0] = _Sums(
            float(r["n"]), np.array([r[f"s{i}"] for i in range(p)], dtype=float),
            float(r["sy"]), sxx, np.array([r[f"s{i}y"] for i in range(p)], dtype=float),
            float(r["syy"]))
    return out


def _solve(s: _Sums, alpha: float) -> tuple[np.ndarray, float]:
    """Ridge on sums (shifted coordinates): (Cxx + alpha I) w = Cxy."""
    cxx = s.sxx - np.outer(s.sx, s.sx) / s.n
    cxy = s.sxy - s.sx * s.sy / s.n
    w = np.linalg.solve(cxx + alpha * np.eye(len(s.sx)), cxy)
    b = (s.sy - w @ s.sx) / s.n
    return w, b


def _sse(s: _Sums, w: np.ndarray, b: float) -> float:
    """Sum of squared errors of (w, b) over the rows summarised by `s`."""
    return float(s.syy - 2 * b * s.sy - 2 * w @ s.sxy + s.n * b * b
                 + 2 * b * (w @ s.sx) + w @ s.sxx @ w)


def ridge_search(train: DataFrame, features: Sequence[str], label: str = LABEL,
                 alphas: Sequence[float] = RIDGE_ALPHAS, fold_col: str = "fold"
                 ) -> tuple[list[tuple[float, float]], RidgeFit]:
    """M4 + M3: the grid (mean validation MSE per alpha over the folds, equal
    fold weight, as a k-fold grid search scores) and the refit at the best
    alpha on all of `train`. Two aggregates over the data: the means, and the
    Gram sums per fold, whose total is the refit's."""
    check_features(features, label)
    mx, my, dropped = _means(train, features, label)
    folds = _gram(train, features, label, mx, my, by=fold_col)
    total = None
    for s in folds.values():
        total = s if total is None else total + s
    grid = _grid(folds, total, alphas)
    return grid, _refit(features, best_alpha(grid), total, mx, my, dropped)


def ridge_grid(train: DataFrame, features: Sequence[str], label: str = LABEL,
               alphas: Sequence[float] = RIDGE_ALPHAS, fold_col: str = "fold"
               ) -> list[tuple[float, float]]:
    """M4 alone."""
    return ridge_search(train, features, label, alphas, fold_col)[0]


def _grid(folds: dict, total: _Sums, alphas: Sequence[float]) -> list[tuple[float, float]]:
    out = []
    for a in alphas:
        mses = []
        for s in folds.values():
            w, b = _solve(total - s, float(a))
            mses.append(_sse(s, w, b) / s.n)
        out.append((a, float(np.mean(mses))))
    return out


def best_alpha(grid: Sequence[tuple[float, float]]) -> float:
    """Smallest mean MSE; of values equal to within rounding errors (a
    relative 1e-12) the smallest alpha."""
    low = min(m for _, m in grid)
    return min(a for a, m in grid if m <= low * (1 + 1e-12))


def _refit(features: Sequence[str], alpha: float, total: _Sums, mx: np.ndarray, my: float,
           dropped: int) -> RidgeFit:
    w, b = _solve(total, float(alpha))
    intercept = my + b - float(w @ mx)
    return RidgeFit(tuple(features), float(alpha), tuple(float(v) for v in w), float(intercept),
                    dropped)


def fit_ridge(train: DataFrame, features: Sequence[str], label: str = LABEL,
              alpha: float = 1.0) -> RidgeFit:
    """M3: ridge on all of `train` (two tiny aggregates)."""
    check_features(features, label)
    mx, my, dropped = _means(train, features, label)
    return _refit(features, alpha, _gram(train, features, label, mx, my)[0], mx, my, dropped)


def coefficients_frame(spark, fit: RidgeFit) -> DataFrame:
    """M7: (term, value) rows -- alpha, intercept, one per feature."""
    rows = [("alpha", float(fit.alpha)), ("intercept", fit.intercept)]
    rows += list(zip(fit.features, fit.coef))
    return spark.createDataFrame(rows, "term string, value double")


def grid_frame(spark, grid: Sequence[tuple[float, float]]) -> DataFrame:
    best = best_alpha(grid)
    return spark.createDataFrame([(float(a), m, a == best) for a, m in grid],
                                 "alpha double, mean_mse double, is_best boolean")


# --- M6: metrics --------------------------------------------------------------

def regression_metrics(df: DataFrame, label: str, prediction: Column | str,
                       by: str = "split") -> DataFrame:
    """M6: per group n, MSE and R^2 (1 - SSE/SST, SST around the group's own
    mean) in one aggregate. SST is n times the population variance, which
    Spark computes around a running mean, so large labels lose nothing."""
    pred = F.col(prediction) if isinstance(prediction, str) else prediction
    y = F.col(label).cast("double")
    err = y - pred
    agg = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"),
                             F.sum(err * err).alias("sse"),
                             F.var_pop(y).alias("var"))
    sst = F.col("var") * F.col("n")
    return agg.select(by, "n", (F.col("sse") / F.col("n")).alias("mse"),
                      F.when(sst > 0, 1 - F.col("sse") / sst).alias("r2"))
