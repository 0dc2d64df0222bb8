"""Embedding whitening by shifted CholeskyQR.

Entries are taken as whole numbers x = floor(1024 c) + 100000, so counts, sums
and squared deviations are exact. The centred rows Y are never stored: every
pass reads the vectors, centres them by the exact sums and sends them through
the triangular solves found so far.

1. One pass: number of rows n and the sums S of each dimension.
2. Gram passes. Each gives G = Q'Q of the rows solved so far, Q = Y / R1 / R2 ...;
   the driver factors G (d x d) by Cholesky and the factor joins the solves.
   The first factor, and any that would break down, is taken of G + sI with a
   shift s just above the rounding errors of G, so that also nearly dependent
   or constant dimensions get through; the passes end once Q'Q is the identity
   to `ORTHOGONAL`. The composed factor R = ... R2 R1 has R'R = Y'Y without the
   condition number ever being squared.
3. SVD of R: its right singular vectors are the covariance's eigenvectors, its
   squared singular values over n the eigenvalues. (As R comes from rows, the
   small eigenvalues are as exact as the large ones.)
4. One pass measures the covariance of the whitened rows, one writes them.

What a task sends is d(d+1)/2 sums, summed by Spark before the driver sees
them: the driver holds d x d numbers, whatever the number of rows.

Defined cases: a row whose vector is null, or holds null, NaN or an infinity,
is dropped; all other rows, repeated ones too, are fitted and returned. A
direction whose standard deviation is rounding error beside the largest one
has no whitened value: its component, and those after it, are not returned.
No rows, no dimensions or all vectors equal give an empty result. Vectors of
different lengths and entries beyond 2^52 / 1024 in size are errors. A
deviation (it grows with the square of n) beyond a long is null; nothing else
depends on it. Null and repeated ids are carried as they are; other columns
of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
ORTHOGONAL = 1e-13       # Gram passes end below this distance from the identity
MOST_PASSES = 12
SOLVE_BLOCK = 32         # columns of one block of a triangular solve
MAX_DIMENSIONS = 4096    # d x d doubles on the driver: 128 MB
EPS = np.finfo(np.float64).eps


def entries(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """The vectors of a batch (a list column without nulls) as rows of x."""
    vectors = batch.column(column)
    n = len(vectors)
    lengths = np.diff(np.asarray(vectors.offsets)) if n else np.zeros(0, int)
    if n and lengths.min() != lengths.max():
        raise ValueError(f"vectors of {lengths.min()} and {lengths.max()} dimensions")
    flat = np.asarray(vectors.flatten()).astype(np.float64)
    if flat.size and np.abs(flat).max() >= 2.0 ** 52 / SCALE:
        raise ValueError("a vector's entry is too large for a whole number")
    x = np.floor(SCALE * flat).astype(np.int64) + OFFSET
    return x.reshape(n, lengths[0] if n else 0)


def solve_right(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows / R for an upper triangular R, by forward substitution over
    blocks of columns."""
    out = np.empty_like(rows)
    d = r.shape[0]
    for a in range(0, d, SOLVE_BLOCK):
        b = min(a + SOLVE_BLOCK, d)
        rest = rows[:, a:b] - out[:, :a] @ r[:a, a:b]
        for j in range(a, b):
            out[:, j] = (rest[:, j - a] - out[:, a:j] @ r[a:j, j]) / r[j, j]
    return out


@dataclass(frozen=True)
class Sums:
    n: int
    total: tuple[int, ...]      # of x, by dimension

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: in longs, or in Python's integers where these
        could overflow."""
        total = np.array(self.total, dtype=object)
        big = max([abs(t) for t in self.total], default=0) + self.n * int(np.abs(x).max(initial=0))
        if big < 2 ** 62:
            return self.n * x - total.astype(np.int64)
        return self.n * x.astype(object) - total

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: components in rows, by falling eigenvalue."""
    sums: Sums
    vectors: np.ndarray         # k x d, unit eigenvectors
    values: np.ndarray          # k eigenvalues
    trace: float
    passes: int
    identity_error: float | None = None

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.sums.centred(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T


def usable(df: DataFrame, vector: str, keys: Sequence[str] = ()) -> DataFrame:
    """The keys and `vector` of the rows that are fitted, as array<double>."""
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.where(v.isNotNull() & ~bad).select(*[F.col(f"`{k}`") for k in keys], v.alias("_zc_v"))


def _batches(rows: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             schema: str) -> DataFrame:
    return rows.mapInArrow(fn, schema)


def fit_sums(rows: DataFrame) -> Sums:
    """n and S. Sums leave a task as decimals, since Spark adds those exactly."""
    def task(batches):
        n, total = 0, None
        for batch in batches:
            x = entries(batch, batch.num_columns - 1)
            if not len(x):
                continue
            if total is not None and len(total) != x.shape[1]:
                raise ValueError(f"vectors of {len(total)} and {x.shape[1]} dimensions")
            if total is None:
                total = [0] * x.shape[1]
            n += len(x)
            part = x.sum(axis=0) if np.abs(x).max(initial=0) < 2 ** 62 // len(x) else x.astype(object).sum(axis=0)
            total = [a + int(b) for a, b in zip(total, part)]
        if n:
            from decimal import Decimal
            d = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, d), pa.int32()), pa.array([n] * (d + 1), pa.int64()),
                 pa.array([Decimal(d), *map(Decimal, total)], pa.decimal128(38, 0))], ["i", "n", "s"])

    got = (_batches(rows, task, "i int, n long, s decimal(38,0)").groupBy("i")
           .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("s").alias("least"),
                F.max("s").alias("most")).orderBy("i").collect())
    if not got:
        return Sums(0, ())
    if got[0]["least"] != got[0]["most"]:
        raise ValueError(f"vectors of {got[0]['least']} and {got[0]['most']} dimensions")
    if len(got) - 1 > MAX_DIMENSIONS:
        raise ValueError(f"more than {MAX_DIMENSIONS} dimensions")
    return Sums(got[0]["n"], tuple(int(r["s"]) for r in got[1:]))


def gram(rows: DataFrame, d: int, transform: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of q'q, q = transform(x): one partial d x d sum a
    task, added by entry of its upper triangle."""
    at = np.triu_indices(d)

    def task(batches):
        total = np.zeros((d, d))
        for batch in batches:
            x = entries(batch, batch.num_columns - 1)
            if len(x):
                q = transform(x)
                total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(at[0]), dtype=np.int64)),
                                          pa.array(total[at])], ["i", "s"])

    got = _batches(rows, task, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    out = np.zeros((d, d))
    for r in got:
        i, j = at[0][r["i"]], at[1][r["i"]]
        out[i, j] = out[j, i] = r["s"]
    return out


def factor(g: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper triangular R with R'R = G, or G + sI. s is 11 (n d + d (d + 1)) u
    times the norm of G, the shift under which Cholesky cannot break down,
    with n counted as a thousand at most: tasks add few rows at a time and
    then their sums, so the rounding errors do not grow with n."""
    d = len(g)
    if not shifted:
        try:
            return np.linalg.cholesky(g).T
        except np.linalg.LinAlgError:
            pass
    s = 11 * (min(n, 1000) * d + d * (d + 1)) * EPS / 2 * np.linalg.norm(g, 2)
    for _ in range(8):
        try:
            return np.linalg.cholesky(g + s * np.eye(d)).T
        except np.linalg.LinAlgError:
            s *= 10
    raise ArithmeticError("no shift makes the Gram matrix positive definite")


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of `rows` (see `usable`), None where there is none."""
    sums = fit_sums(rows)
    d = len(sums.total)
    if not sums.n or not d:
        return None
    factors: list[np.ndarray] = []

    def solved(x: np.ndarray) -> np.ndarray:
        q = sums.centred(x)
        for r in factors:
            q = solve_right(q, r)
        return q

    composed = np.eye(d)
    while True:
        g = gram(rows, d, solved)
        if not factors and not np.abs(g).max():
            return None                             # all vectors are equal
        off = np.abs(g - np.eye(d)).max()
        if factors and off <= ORTHOGONAL * d or len(factors) == MOST_PASSES:
            break
        # far from orthogonal: the factor is of a shifted matrix
        r = factor(g, sums.n, shifted=not factors or off > 0.5)
        factors.append(r)
        composed = r @ composed
    _, sigma, right = np.linalg.svd(composed)
    sound = sigma > sigma[0] * EPS * max(d, 100)
    k = min(components, int(sound.sum()))
    model = Whitening(sums, right[:k], sigma[:k] ** 2 / sums.n, float((composed ** 2).sum() / sums.n),
                      len(factors) + 1)
    return Whitening(sums, model.vectors, model.values, model.trace, model.passes,
                     identity_error(rows, model))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the
    identity. Each task centres its rows by their own mean; (count, mean,
    co-moments) are merged pairwise."""
    k = len(model.values)

    def task(batches):
        n, mean, moment = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            x = entries(batch, batch.num_columns - 1)
            if len(x):
                n, mean, moment = merged((n, mean, moment), co_moments(model.whiten(x)))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([mean.tolist()], pa.list_(pa.float64())),
                 pa.array([moment.ravel().tolist()], pa.list_(pa.float64()))], ["n", "mean", "moment"])

    def join(batches):
        total = (0, np.zeros(k), np.zeros((k, k)))
        for batch in batches:
            for row in batch.to_pylist():
                total = merged(total, (row["n"], np.array(row["mean"]),
                                       np.array(row["moment"]).reshape(k, k)))
        if total[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array([total[0]], pa.int64()), pa.array([total[1].tolist()], pa.list_(pa.float64())),
                 pa.array([total[2].ravel().tolist()], pa.list_(pa.float64()))], ["n", "mean", "moment"])

    schema = "n long, mean array<double>, moment array<double>"
    # k x k numbers a task; a tree of two levels, so one task never merges all
    parts = _batches(rows, task, schema)
    some = parts.repartition(16, F.xxhash64("mean")).mapInArrow(join, schema)
    total = (0, np.zeros(k), np.zeros((k, k)))
    for r in some.collect():
        total = merged(total, (r["n"], np.array(r["mean"]), np.array(r["moment"]).reshape(k, k)))
    return float(np.abs(total[2] / max(total[0], 1) - np.eye(k)).max())


def co_moments(z: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    mean = z.mean(axis=0)
    return len(z), mean, (z - mean).T @ (z - mean)


def merged(a, b):
    n = a[0] + b[0]
    if not n:
        return a
    step = b[1] - a[1]
    return (n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n))


def whitened(df: DataFrame, keys: Sequence[str], vector: str, model: Whitening | None) -> DataFrame:
    """One row per usable row of `df` and component: the keys, component
    (from 1), n, deviation, whitened, explained, identity_error."""
    rows = usable(df, vector, keys)
    out = T.StructType([*rows.schema.fields[:-1], T.StructField("component", T.IntegerType()),
                        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
                        T.StructField("whitened", T.DoubleType()),
                        T.StructField("explained", T.DoubleType()),
                        T.StructField("identity_error", T.DoubleType())])
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], out)
    k = len(model.values)
    share = model.values / model.trace

    def task(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = entries(batch, batch.num_columns - 1)
            dev = model.sums.deviations(x)
            if dev.dtype != object and int(np.abs(dev).max(initial=0)) ** 2 * dev.shape[1] >= 2 ** 63:
                dev = dev.astype(object)
            square = (dev * dev).sum(axis=1)
            too_large = (square >= 2 ** 63).astype(bool) if dev.dtype == object else np.zeros(n, bool)
            square = np.where(too_large, 0, square).astype(np.int64)
            at = np.repeat(np.arange(n), k)
            columns = [c.take(pa.array(at)) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                 pa.array(np.full(n * k, model.sums.n, np.int64)),
                 pa.array(square[at], mask=too_large[at]), pa.array(model.whiten(x).ravel()),
                 pa.array(np.tile(share, n)), pa.array(np.full(n * k, model.identity_error))],
                names=out.names)

    return rows.mapInArrow(task, out)


def whiten(df: DataFrame, keys: Sequence[str], vector: str,
           components: int = COMPONENTS) -> DataFrame:
    """Fit on all usable rows of `df`, whiten them all."""
    return whitened(df, keys, vector, fit(usable(df, vector), components))
