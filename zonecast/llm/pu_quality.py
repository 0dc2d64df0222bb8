"""Quality by positive-unlabelled learning.

A logistic model is fitted to trusted positives and unlabelled text only, by
the non-negative unbiased risk

    prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)])

with the logistic loss l; where the estimated negative part falls below zero
the step goes the other way, so the model cannot gain by overfitting it.

Inputs of a score are the text alone: how its characters follow each other (by
class of character), and how often words and lines repeat. Features are
computed per document inside Spark tasks; the model is fitted on a bounded
sample (`TRUSTED` and `UNLABELLED` documents at most, those with the smallest
id hash), and every document is scored over its whole text.

No negative label is read. The class prior is estimated from the positives and
the unlabelled texts as the smallest ratio of unlabelled to positive documents
above a score: where only positives score that high, that ratio is the prior.

Defined cases: null text is empty; empty texts are scored like any other;
null ids have no label and are not held out; a document with several labels is
trusted when one of them is positive; without positives, or without documents,
every score is the prior of one half; other columns of the inputs are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRUSTED = 20_000
UNLABELLED = 20_000
CHUNK = 1 << 20          # bytes of a text looked at at once
ROWS, COLUMNS = 2048, 16 # of a sample taken at once where copies are made

# Classes of bytes
_CLASSES = [b" ", b"\n", bytes(range(0x61, 0x7B)), bytes(range(0x41, 0x5B)), b"0123456789", b".",
            b",", b"!?;:", b"\"'()[]{}<>`", b"#$%&*+/=@\\^_|~", bytes(range(0x80, 0x100)), b"-"]
_N = len(_CLASSES) + 1   # the last class: all other bytes
_CLASS = np.full(256, _N - 1, np.int64)
for _i, _c in enumerate(_CLASSES):
    _CLASS[list(_c)] = _i
EXTRA = 7
WIDTH = _N * _N + EXTRA


def features(text: str | None) -> np.ndarray:
    raw = (text or "").encode("utf-8", "surrogatepass")
    pairs = np.zeros(_N * _N)
    for at in range(0, max(0, len(raw) - 1), CHUNK):
        c = _CLASS[np.frombuffer(raw, np.uint8, min(CHUNK + 1, len(raw) - at), at)]
        pairs += np.bincount(c[:-1] * _N + c[1:], minlength=_N * _N)
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, m = max(1, len(words)), max(1, len(lines))
    seen = set(words)
    upper = sum(map(bytes.isupper, seen)) / max(1, len(seen))
    extra = [np.log1p(len(words)) / 10, len(raw) / n / 20, 1 - len(seen) / n,
             sum(map(eq, words, words[1:])) / n, 1 - len(set(lines)) / m, upper,
             np.log1p(n / m) / 5]
    return np.concatenate([np.sqrt(pairs / max(1, len(raw) - 1)), extra])


def _feature_rows(batches: Iterator[pa.RecordBatch], ids: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = np.array([features(t.as_py()) for t in b.column("text")], np.float32).reshape(-1, WIDTH)
        offsets = pa.array(np.arange(len(x) + 1) * WIDTH, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [b.column(ids), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))],
            [ids, "features"])


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample(rows: DataFrame, most: int) -> DataFrame:
    """The ids of at most `most` rows: those with the smallest id hash."""
    return (rows.where("doc_id is not null").select("doc_id").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))


def sampled_features(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Features (4 bytes each) of the documents in `ids`, a bounded sample; its
    size bounds the broadcast and what reaches the driver."""
    rows = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .mapInArrow(lambda b: _feature_rows(b, "doc_id"), "doc_id long, features array<float>")
            .groupBy("doc_id").agg(F.min("features").alias("features"))
            .select("features").toArrow())
    flat = rows.column("features").combine_chunks()
    values = flat.values if isinstance(flat, pa.ListArray) else flat.flatten()
    return values.to_numpy().reshape(-1, WIDTH)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Logistic:
    """weights over standardised features, with the bias in front."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights
        self.prior: float | None = None     # what a positive-unlabelled fit took

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for at in range(0, len(x), ROWS):
            part = x[at:at + ROWS]
            out[at:at + ROWS] = _sigmoid(np.clip((part - self.mean) / self.scale, -8, 8)
                                         @ self.weights[1:] + self.weights[0])
        return out


def _standardised(parts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of `parts` standardised, their means and their scales. The
    result is the only array of that size: the driver has little memory."""
    z = np.empty((sum(map(len, parts)), parts[0].shape[1]))
    at = 0
    for p in parts:
        z[at:at + len(p)] = p
        at += len(p)
    mean = z.mean(axis=0)
    scale = np.concatenate([z[:, c:c + COLUMNS].std(axis=0)
                            for c in range(0, z.shape[1], COLUMNS)]) + 1e-3
    z -= mean
    z /= scale
    return np.clip(z, -8, 8, out=z), mean, scale


def fit_logistic(parts: Sequence[np.ndarray], gradient, steps: int = 400, rate: float = 0.03,
                 l2: float = 1e-4) -> Logistic:
    """Adam over whole-sample gradients; the sample is the rows of `parts`.
    `gradient(z)`: the derivative of the risk by each row's raw score."""
    z, mean, scale = _standardised(parts)
    w, m, v = (np.zeros(z.shape[1] + 1) for _ in range(3))
    for t in range(1, steps + 1):
        g_row = gradient(z @ w[1:] + w[0])
        g = np.concatenate([[g_row.sum()], z.T @ g_row + l2 * w[1:]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Logistic(mean, scale, w)


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Logistic:
    """Minimise the non-negative risk."""
    n_p, n_u = len(positive), len(unlabelled)

    def gradient(z: np.ndarray) -> np.ndarray:
        z_p, z_u = z[:n_p], z[n_p:]
        loss_neg = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        g_p, g_u = prior * -_sigmoid(-z_p) / n_p, np.zeros(n_u)
        neg_p, neg_u = -prior * _sigmoid(z_p) / n_p, _sigmoid(z_u) / n_u
        if loss_neg < 0:        # below zero the estimate is overfitted: step back
            return np.concatenate([-neg_p, -neg_u])
        return np.concatenate([g_p + neg_p, g_u + neg_u])

    return fit_logistic([positive, unlabelled], gradient)


def prior_from_positives(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The smallest ratio of the unlabelled to the positive share above a score
    of a positive-against-unlabelled model."""
    n_p, n_u = len(positive), len(unlabelled)
    y = np.concatenate([np.ones(n_p), np.zeros(n_u)])
    weight = np.concatenate([np.full(n_p, 0.5 / n_p), np.full(n_u, 0.5 / n_u)])
    model = fit_logistic([positive, unlabelled],
                         lambda z: weight * (_sigmoid(z) - y))
    s_p, s_u = model.score(positive), model.score(unlabelled)
    cuts = np.quantile(s_p, np.linspace(0, 0.95, 39))
    margin = 1 / np.sqrt(n_p) + 1 / np.sqrt(n_u)
    ratios = [((s_u >= c).mean() + margin) / max((s_p >= c).mean(), 1e-9) for c in cuts]
    return float(np.clip(min(ratios) - margin, 0.05, 0.95))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", trusted: int = TRUSTED,
          unlabelled: int = UNLABELLED, prior: float | None = None) -> Logistic | None:
    """Fit on `docs` and the positives of `labels` (doc_id, `label`), both
    already without the rows that must not be learnt from."""
    positive = sampled_features(docs, sample(labels.where(F.col(label) == 1), trusted))
    rest = sampled_features(docs, sample(docs, unlabelled))
    if not len(positive) or not len(rest):
        return None
    if prior is None:
        prior = prior_from_positives(positive, rest)
    prior = min(max(prior, 0.01), 0.99)
    model = fit_pu(positive, rest, prior)
    model.prior = prior
    return model


def _scored(batches: Iterator[pa.RecordBatch], model: Logistic | None, keep: list[str]):
    for b in batches:
        x = np.array([features(t.as_py()) for t in b.column("text")]).reshape(-1, WIDTH)
        s = model.score(x) if model is not None else np.full(len(x), 0.5)
        yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], pa.array(s)],
                                         [*keep, "score"])


def scores(docs: DataFrame, model: Logistic | None, keep: list[str]) -> DataFrame:
    """`keep` and score of every row of `docs` (columns `keep` and text)."""
    fields = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return docs.select(*keep, "text").mapInArrow(lambda b: _scored(b, model, keep),
                                                 f"{fields}, score double")
