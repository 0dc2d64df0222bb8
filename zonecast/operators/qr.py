"""Ridge without squares of the features (M3, M4): QR in a tree.

Normal equations square the condition number, and are singular where a feature
is constant or repeats another. Here each task reduces its rows [1, x, y] to
the triangular factor of a QR decomposition, a (p + 2) x (p + 2) table, and
factors are stacked and reduced again, `FAN_IN` at a time, until one is left a
fold. Its first row takes out the intercept, the rest is the centred problem:
the least squares of the factor are those of all rows.

Features that carry no information of their own have a defined answer: with
alpha 0 the coefficients of least size (a constant feature gets 0, equal
features share), which is also where those of alpha > 0 tend.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.operators.models import LABEL, RIDGE_ALPHAS, RidgeFit, best_alpha, check_features, complete_rows
from zonecast.plans.strategy import materialize

FAN_IN = 32
RANK_TOLERANCE = 1e-12      # of a singular value, beside the largest


@dataclass(frozen=True)
class Factors:
    features: tuple[str, ...]
    by_fold: dict[int, np.ndarray]      # fold -> triangular factor
    rows: dict[int, int]                # fold -> complete rows
    dropped: int                        # rows with a missing value

    def without(self, fold: int | None = None) -> np.ndarray:
        """The factor of all folds but one."""
        kept = [r for k, r in sorted(self.by_fold.items()) if k != fold]
        return reduced(np.vstack(kept))


def reduced(rows: np.ndarray) -> np.ndarray:
    """The square triangular factor of `rows`, diagonal not negative."""
    r = np.linalg.qr(rows, mode="r")
    out = np.zeros((rows.shape[1],) * 2)
    out[:len(r)] = r * np.where(np.diag(r) < 0, -1.0, 1.0)[:len(r), None]
    return out


def factors(df: DataFrame, features: Sequence[str], label: str = LABEL, fold_col: str | None = None) -> Factors:
    """One factor per fold. Reads the data once; what leaves a task is one
    factor per fold it has rows of, and each round of the tree takes `FAN_IN`
    tasks' factors into one."""
    check_features(features, label)
    size = len(features) + 2
    ok = complete_rows(features, label)
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
    x = F.array(F.lit(1.0), *[F.col(c).cast("double") for c in (*features, label)])
    rows = df.select(F.when(ok, fold).otherwise(F.lit(None)).alias("fold"), F.when(ok, x).alias("x"))

    schema = "fold int, n long, r array<double>"

    def out(found: dict, missing: int) -> pa.RecordBatch:
        keys = list(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([*keys, None], pa.int32()),
             pa.array([*[found[k][0] for k in keys], missing], pa.int64()),
             pa.array([*[found[k][1].ravel().tolist() for k in keys], None], pa.list_(pa.float64()))],
            ["fold", "n", "r"])

    def add(found: dict, k: int, n: int, block: np.ndarray) -> None:
        n0, r0 = found.get(k, (0, np.zeros((0, size))))
        found[k] = (n0 + n, reduced(np.vstack([r0, block])))

    def first(batches):
        found: dict = {}
        missing = 0
        for batch in batches:
            folds = np.asarray(batch.column("fold").fill_null(-1))
            missing += int((folds < 0).sum())
            values = np.asarray(batch.column("x").flatten()).reshape(-1, size)
            folds = folds[folds >= 0]
            for k in np.unique(folds):
                add(found, int(k), int((folds == k).sum()), values[folds == k])
        yield out(found, missing)

    def join(batches):
        found: dict = {}
        missing = 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["fold"] is None:
                    missing += row["n"]
                else:
                    add(found, row["fold"], row["n"], np.array(row["r"]).reshape(size, size))
        yield out(found, missing)

    level = materialize(rows.mapInArrow(first, schema), "factors")
    tasks = level.count()
    while tasks > FAN_IN:
        tasks = math.ceil(tasks / FAN_IN)
        level = level.repartition(tasks, F.xxhash64("fold", "n", "r")).mapInArrow(join, schema)
    by_fold: dict = {}
    missing = 0
    for row in level.collect():         # FAN_IN tasks' factors at most
        if row["fold"] is None:
            missing += row["n"]
        else:
            add(by_fold, row["fold"], row["n"], np.array(row["r"]).reshape(size, size))
    if not by_fold:
        raise ValueError("no complete training rows")
    return Factors(tuple(features), {k: r for k, (_, r) in by_fold.items()},
                   {k: n for k, (n, _) in by_fold.items()}, missing)


def solve(r: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept from a factor of [1, x, y]."""
    p = len(r) - 2
    x, y = r[1:, 1:p + 1], r[1:, p + 1]
    if alpha:
        x = np.vstack([x, math.sqrt(alpha) * np.eye(p)])
        y = np.concatenate([y, np.zeros(p)])
    w = np.linalg.lstsq(x, y, rcond=RANK_TOLERANCE)[0]
    return w, float((r[0, p + 1] - r[0, 1:p + 1] @ w) / r[0, 0])


def squared_error(r: np.ndarray, w: np.ndarray, b: float) -> float:
    """Of (w, b) over the rows that a factor stands for."""
    return float(np.sum((r @ np.concatenate([[b], w, [-1.0]])) ** 2))


def fit_ridge_qr(df: DataFrame, features: Sequence[str], label: str = LABEL, alpha: float = 1.0) -> RidgeFit:
    """M3 by QR."""
    f = factors(df, features, label)
    w, b = solve(f.without(), alpha)
    return RidgeFit(f.features, float(alpha), tuple(map(float, w)), b, f.dropped)


def ridge_search_qr(df: DataFrame, features: Sequence[str], label: str = LABEL,
                    alphas: Sequence[float] = RIDGE_ALPHAS, fold_col: str = "fold"
                    ) -> tuple[list[tuple[float, float]], RidgeFit]:
    """M4 and M3 by QR: the grid (mean validation MSE over the folds) and the
    refit at its best alpha, from one pass over the data."""
    f = factors(df, features, label, fold_col)
    rest = {k: f.without(k) for k in f.by_fold}
    grid = [(a, float(np.mean([squared_error(f.by_fold[k], *solve(rest[k], a)) / f.rows[k] for k in f.by_fold])))
            for a in alphas]
    a = best_alpha(grid)
    w, b = solve(f.without(), a)
    return grid, RidgeFit(f.features, float(a), tuple(map(float, w)), b, f.dropped)
