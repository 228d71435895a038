"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown on binned statistics of a bounded sample of labelled documents, kept as flat
arrays of full binary trees, and traversed for all rows and trees of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionloom.llm.common import blocks, bytes_of, doc_view, fold_of, labelled_sample
from regionloom.llm.text_stats import STAT_NAMES, document_stats

#: Labelled rows that the trees are grown on, at most (about: rows are taken by a hash).
SAMPLE_ROWS = 20_000
#: Text bytes of which statistics are taken at once; numpy takes some 20 times these.
STAT_BYTES = 1 << 20
TREES, DEPTH, BINS, RATE, LEAST_ROWS, RIDGE = 80, 4, 64, 0.15, 20, 1.0


@dataclass
class Trees:
    """Full binary trees, node n with children 2n+1 and 2n+2: a row goes right where its feature is above the cut."""

    base: float
    feature: np.ndarray  # tree, inner node
    cut: np.ndarray
    leaf: np.ndarray  # tree, leaf

    def raw_score(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros((len(x), len(self.feature)), np.int64)
        tree, row = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.cut[tree, node])
        return self.base + self.leaf[tree, node - (2**DEPTH - 1)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw_score(x), -30, 30)))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for the logistic loss. Without rows every score is 0.5; with one label only, near that label."""
    inner = 2**DEPTH - 1
    if not len(y):
        return Trees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])  # bin b: above b edges
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    total = np.full(len(y), base)
    features, cuts, leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        feature, cut, node = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32), np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.full(width, 1e-6)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                cell, size = local * BINS + binned[f], width * BINS
                g, h, n = (np.bincount(cell, w, size).reshape(width, BINS).cumsum(axis=1) for w in (grad, hess, None))
                gl, hl, nl, gt, ht, nt = g[:, :-1], h[:, :-1], n[:, :-1], g[:, -1:], h[:, -1:], n[:, -1:]
                gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(nl < LEAST_ROWS) | (nt - nl < LEAST_ROWS)] = 0
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                for k in np.flatnonzero((top > best) & (at < len(e))):
                    best[k], feature[first + k], cut[first + k] = top[k], f, e[at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        local = node - inner
        leaf = RATE * np.bincount(local, grad, inner + 1) / (np.bincount(local, hess, inner + 1) + RIDGE)
        total += leaf[local]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(cuts), np.array(leaves))


def _stats(batch: pa.RecordBatch, column: int = 1) -> np.ndarray:
    texts = batch.column(column)
    return document_stats(texts.cast(pa.binary()).to_pylist(), *bytes_of(texts))


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Trees grown on about ``most`` labelled rows. ``labels``: doc_id and quality (0 or 1); null labels and ids are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=STAT_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array([row.tobytes() for row in _stats(batch)], pa.binary())], ["label", "stats"])

    sample = labelled_sample(doc_view(docs, id_col, text_col), labels.select("doc_id", F.col("quality").alias("label")), most)
    rows = sample.select("doc_id", "text", F.col("label").cast("int").alias("label")).mapInArrow(run, "label int, stats binary").toArrow()
    x = np.frombuffer(b"".join(rows["stats"].to_pylist()), np.float32).reshape(-1, len(STAT_NAMES))
    y = np.array(rows["label"].to_pylist(), np.float64)
    order = np.lexsort(np.vstack([x.T, y]))  # the same trees whatever order the rows come in
    return grow(x[order], y[order])


def score_documents(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5) of every row; null and empty texts are scored alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=STAT_BYTES):
            score = trees.score(_stats(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    scored = doc_view(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", (fold_of("doc_id") == 1).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, every column, whose texts score 0.5 or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text_col, STAT_BYTES):
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at)
            texts = texts.fill_null("") if texts.null_count else texts
            keep = trees.score(document_stats(texts.cast(pa.binary()).to_pylist(), *bytes_of(texts))) >= 0.5
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
