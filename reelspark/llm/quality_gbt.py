"""Quality rules: gradient-boosted trees over document statistics.

The trees are grown on histograms with logistic loss. Chosen statistics carry a monotonic constraint: more of them can
never raise (or lower) the score, whatever else holds. The forest is flattened into numpy node arrays, and a batch of
documents walks all trees at once."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import docstats
from ._common import slices
from .labelled import SAMPLE_ROWS, training_rows

#: -1: the score never rises with the statistic; 1: it never falls.
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeat_words": -1, "pipes": -1, "marks": -1, "same_next": -1, "upper": -1, "open_lines": -1, "distinct": 1}
OUT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"


@dataclass(frozen=True)
class GbtParams:
    trees: int = 60
    depth: int = 4
    rate: float = 0.2
    bins: int = 64
    l2: float = 1.0
    min_hessian: float = 4.0
    threshold: float = 0.5
    sample_rows: int = SAMPLE_ROWS
    min_words: int = 50
    max_repeat_percent: int = 50
    monotone: dict = field(default_factory=lambda: dict(MONOTONE))


@dataclass(frozen=True)
class Forest:
    """All nodes of all trees in one set of arrays. A leaf points at itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if not len(self.roots):
            return out
        for at in range(0, len(x), 4096):
            part = x[at : at + 4096]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots))).copy()
            row = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                node = np.where(part[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out[at : at + 4096] += self.value[node].sum(axis=1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -500, 500)))


def fit_forest(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = docstats.RATIOS, p: GbtParams = GbtParams()) -> Forest:
    """Grow the forest. Without rows, or with one class only, it is a constant: 1 if no row says otherwise."""
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []

    def add(value: float) -> int:
        i = len(nodes["value"])
        for k, v in (("feature", 0), ("threshold", np.inf), ("left", i), ("right", i), ("value", value)):
            nodes[k].append(v)
        return i

    if not len(y) or y.min() == y.max():
        base = 10.0 if not len(y) or y[0] > 0 else -10.0
    else:
        base = float(np.log(y.mean() / (1 - y.mean())))
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, p.bins + 1)[1:-1])) for j in range(x.shape[1])]
        edges = [e if len(e) > 4 else np.unique(np.quantile(v, np.linspace(0, 1, p.bins))) if len(v := np.unique(x[:, j])) > 1 else e for j, e in enumerate(edges)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        signs = [p.monotone.get(n, 0) for n in names]
        margin = np.full(len(y), base)
        for _ in range(p.trees):
            prob = 1 / (1 + np.exp(-margin))
            g, h = prob - y, np.maximum(prob * (1 - prob), 1e-12)
            root = add(0.0)
            roots.append(root)
            level = [(root, np.arange(len(y)), -np.inf, np.inf)]
            for d in range(p.depth + 1):
                following = []
                for node, rows, low, high in level:
                    gs, hs = g[rows].sum(), h[rows].sum()
                    weight = float(np.clip(-gs / (hs + p.l2), low, high))
                    nodes["value"][node] = p.rate * weight
                    best = None
                    if d < p.depth and hs >= 2 * p.min_hessian:
                        for j, e in enumerate(edges):
                            if not len(e):
                                continue
                            gl = np.cumsum(np.bincount(binned[rows, j], g[rows], len(e) + 1))[:-1]
                            hl = np.cumsum(np.bincount(binned[rows, j], h[rows], len(e) + 1))[:-1]
                            gr, hr = gs - gl, hs - hl
                            wl, wr = np.clip(-gl / (hl + p.l2), low, high), np.clip(-gr / (hr + p.l2), low, high)
                            gain = -(gl * wl + 0.5 * (hl + p.l2) * wl**2 + gr * wr + 0.5 * (hr + p.l2) * wr**2)
                            gain[(hl < p.min_hessian) | (hr < p.min_hessian) | (signs[j] * (wr - wl) < 0)] = -np.inf
                            k = int(np.argmax(gain))
                            if np.isfinite(gain[k]) and (best is None or gain[k] > best[0]):
                                best = (gain[k], j, k, float(wl[k]), float(wr[k]))
                    stay = -(gs * weight + 0.5 * (hs + p.l2) * weight**2)
                    if best is None or best[0] <= stay + 1e-9:
                        margin[rows] += nodes["value"][node]
                        continue
                    _, j, k, wl, wr = best
                    a, b = add(0.0), add(0.0)
                    nodes["feature"][node], nodes["threshold"][node], nodes["left"][node], nodes["right"][node] = j, float(edges[j][k]), a, b
                    middle = (wl + wr) / 2
                    la = (low, min(high, middle)) if signs[j] > 0 else (max(low, middle), high) if signs[j] < 0 else (low, high)
                    lb = (max(low, middle), high) if signs[j] > 0 else (low, min(high, middle)) if signs[j] < 0 else (low, high)
                    goes = binned[rows, j] <= k
                    following += [(a, rows[goes], *la), (b, rows[~goes], *lb)]
                level = following
    kinds = {"feature": np.int32, "threshold": np.float64, "left": np.int32, "right": np.int32, "value": np.float64}
    return Forest(np.array(roots, dtype=np.int32), **{k: np.array(v, dtype=kinds[k]) for k, v in nodes.items()}, depth=p.depth, base=base)


def judge(c: np.ndarray, forest: Forest, p: GbtParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base_failed, kept and score of rows of counts."""
    score = forest.score(docstats.ratios(c))
    failed = (c[:, 0] < p.min_words) | (100 * c[:, 4] > p.max_repeat_percent * c[:, 0])
    return failed, ~failed & (score >= p.threshold), score


def _counts(batch) -> np.ndarray:
    return np.array([docstats.counts(x) for x in batch.column("_text").to_pylist()], dtype=np.int64).reshape(-1, len(docstats.COUNTS))


def train(docs: DataFrame, labels: DataFrame, p: GbtParams = GbtParams()) -> Forest:
    x, y = training_rows(docs, labels, bound=p.sample_rows)
    return fit_forest(docstats.ratios(x), y, p=p)


def quality_rules(docs: DataFrame, forest: Forest, p: GbtParams = GbtParams()) -> DataFrame:
    """One row per document: its base statistics, base_failed, the score of the trees, and kept.

    A null or empty text has no words, fails the base rule and isn't kept. A null doc_id stays null; repeated rows
    are judged each; other columns of ``docs`` are ignored; an empty table gives an empty result."""

    def run(batches):
        for batch in batches:
            c = _counts(batch)
            failed, kept, score = judge(c, forest, p)
            arrays = [batch.column("doc_id"), *(pa.array(c[:, i]) for i in range(5)), pa.array(failed), pa.array(kept), pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *docstats.COUNTS[:5], "base_failed", "kept", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("_text")).mapInArrow(run, OUT)


def keep_documents(docs: DataFrame, forest: Forest, p: GbtParams = GbtParams()) -> DataFrame:
    """The documents that the rules keep, with all columns of ``docs``, in one pass and without a join."""
    place = docs.columns.index("text")

    def run(batches):
        for batch in slices(batches, place):
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            c = np.array([docstats.counts(x) for x in texts], dtype=np.int64).reshape(-1, len(docstats.COUNTS))
            yield batch.filter(pa.array(judge(c, forest, p)[1]))

    return docs.mapInArrow(run, docs.schema)
