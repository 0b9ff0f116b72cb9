"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

Each class has a mean and a covariance, shrunk towards the pooled covariance and towards its own diagonal. The inverse
is never formed: the Cholesky factor of each class is kept, and a score is the difference of two Mahalanobis
log-densities, brought to (0, 1) by a logistic curve that is fitted on the same sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import docstats
from ._common import remainder
from .labelled import SAMPLE_ROWS, training_rows

OUT = "doc_id long, held_out boolean, score double, predicted int"


@dataclass(frozen=True)
class QdaParams:
    pooled: float = 0.1
    diagonal: float = 0.1
    floor: float = 1e-2
    threshold: float = 0.7
    modulus: int = 4
    held_out: int = 2
    sample_rows: int = SAMPLE_ROWS


@dataclass(frozen=True)
class Qda:
    """``factors[k]`` is the inverse of the Cholesky factor of class k, ``dets[k]`` its log-determinant."""

    center: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    dets: np.ndarray
    slope: float
    offset: float

    def log_density(self, z: np.ndarray, k: int) -> np.ndarray:
        d = (z - self.means[k]) @ self.factors[k].T
        return -0.5 * (np.einsum("ij,ij->i", d, d) + self.dets[k])

    def difference(self, c: np.ndarray) -> np.ndarray:
        z = (transform(c) - self.center) / self.scale
        return self.log_density(z, 1) - self.log_density(z, 0)

    def score(self, c: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(c) + self.offset, -500, 500)))


@dataclass(frozen=True)
class Constant:
    value: float

    def score(self, c: np.ndarray) -> np.ndarray:
        return np.full(len(c), self.value)


def transform(c: np.ndarray) -> np.ndarray:
    """Ratios whose long tails are drawn in by a square root, which keeps zero apart from little."""
    r = docstats.ratios(c)
    return np.concatenate([r[:, :2], np.sqrt(r[:, 2:])], axis=1)


def fit(c: np.ndarray, y: np.ndarray, p: QdaParams = QdaParams()) -> Qda | Constant:
    """Without both classes there is nothing to discriminate: the score is then the share of label 1 (0.5 if no row)."""
    if len(y) < 4 or y.min() == y.max():
        return Constant(float(y.mean()) if len(y) else 0.5)
    x = transform(c)
    center, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = (x - center) / scale
    parts = [z[y == k] for k in (0, 1)]
    means = np.stack([q.mean(axis=0) for q in parts])
    own = [(q - m).T @ (q - m) / max(len(q) - 1, 1) for q, m in zip(parts, means)]
    pooled = sum(s * len(q) for s, q in zip(own, parts)) / len(z)
    factors, dets = [], []
    for s in own:
        s = (1 - p.pooled) * s + p.pooled * pooled
        s = (1 - p.diagonal) * s + p.diagonal * np.diag(np.diag(s)) + p.floor * np.eye(len(s))
        lower = np.linalg.cholesky(s)
        factors.append(np.linalg.solve(lower, np.eye(len(s))))
        dets.append(2 * np.log(np.diag(lower)).sum())
    model = Qda(center, scale, means, np.stack(factors), np.array(dets), 1.0, 0.0)
    slope, offset = calibrate(model.difference(c), y)
    return Qda(center, scale, means, model.factors, model.dets, slope, offset)


def calibrate(d: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """A rising logistic curve of the density difference, by Newton steps with a slight penalty."""
    unit = max(float(np.std(d)), 1e-9)
    x = np.stack([np.clip(d / unit, -4, 4), np.ones(len(d))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (q - y) + 1e-2 * w * [1, 0]
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(2), g)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]) / unit, 1e-6), float(w[1])


def train(docs: DataFrame, labels: DataFrame, p: QdaParams = QdaParams()) -> Qda | Constant:
    """Learns only from rows that aren't held out."""
    return fit(*training_rows(docs, labels, lambda i: remainder(i, p.modulus) != p.held_out, p.sample_rows), p)


def _score(model, texts) -> np.ndarray:
    return model.score(np.array([docstats.counts(x) for x in texts], dtype=np.float64).reshape(-1, len(docstats.COUNTS)))


def classify(docs: DataFrame, model: Qda | Constant, p: QdaParams = QdaParams()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts are scored as texts without words. A null doc_id isn't held out; repeated rows get a row
    each; other columns of ``docs`` are ignored; an empty table gives an empty result."""

    def run(batches):
        for batch in batches:
            score = _score(model, batch.column("_text").to_pylist())
            arrays = [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= p.threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(remainder(F.col("doc_id"), p.modulus) == p.held_out, F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("binary").alias("_text")).mapInArrow(run, OUT)


def keep_documents(docs: DataFrame, model: Qda | Constant, p: QdaParams = QdaParams()) -> DataFrame:
    """The documents with predicted = 1, with all columns of ``docs``."""
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_score(model, batch.column(place).cast(pa.binary()).to_pylist()) >= p.threshold))

    return docs.mapInArrow(run, docs.schema)
