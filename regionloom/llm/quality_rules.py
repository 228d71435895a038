"""Quality rules: fixed counts, then a calibrated logistic regression over hashed word and character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionloom.llm.common import blocks, bytes_of, doc_view, labelled_sample
from regionloom.llm.text_stats import hashed_bytes, hashed_words, unit

#: Labelled rows that the regression is fitted on, at most (about: rows are taken by a hash), and hash cells of each kind.
SAMPLE_ROWS, DIMS, GRAM = 6_000, 2048, 3
STEPS, RIDGE = 300, 1e-4
#: A document is kept from this calibrated probability of quality 1.
THRESHOLD = 0.5
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
_SYMBOLS = b"#*$%&|<>"


def rule_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    n = len(words)
    chars = sum(map(len, words))
    if not text.isascii():
        chars -= sum(len(w) - len(w.decode("utf-8", "replace")) for w in words if not w.isascii())
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen: dict = {}
        marked = bytearray(n)
        for k, w in enumerate(windows):
            first = seen.setdefault(w, k)
            if first != k:
                marked[first : first + 3] = marked[k : k + 3] = b"\x01\x01\x01"
        repeated = sum(marked)
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def features(texts: list[bytes], raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed words and word pairs, then hashed character (byte) n-grams, each damped and of length one."""
    return np.hstack([unit(np.sqrt(hashed_words(texts, DIMS))), unit(np.sqrt(hashed_bytes(raw, offsets, GRAM, DIMS)))]).astype(np.float32)


@dataclass
class Regression:
    weights: np.ndarray
    bias: float
    slope: float  # of the calibration
    shift: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid((x @ self.weights + self.bias) * self.slope + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int, rate: float) -> tuple[np.ndarray, float]:
    """Full-batch Adam."""
    w = np.zeros(x.shape[1] + 1, np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        error = (_sigmoid(x @ w[:-1] + w[-1]) - y).astype(np.float32)
        g = np.append(x.T @ error / len(y) + RIDGE * w[:-1], error.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def fit_regression(x: np.ndarray, y: np.ndarray) -> Regression:
    """Weights from four rows of five, calibration (a logistic in the margin) from the fifth. Without rows every probability is 0.5."""
    if not len(y):
        return Regression(np.zeros(2 * DIMS, np.float32), 0.0, 1.0, 0.0)
    aside = np.arange(len(y)) % 5 == 4
    if not aside.any():
        aside = np.ones(len(y), bool)
    w, b = _logistic(x[~aside] if not aside.all() else x, y[~aside] if not aside.all() else y, STEPS, 0.1)
    margin = (x[aside] @ w + b)[:, None]
    scale = float(np.abs(margin).mean()) or 1.0
    slope, shift = _logistic(margin / scale, y[aside], 300, 0.05)
    return Regression(w, b, max(float(slope[0]) / scale, 1e-3), shift)


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Regression:
    """The regression of about ``most`` labelled rows. ``labels``: doc_id and quality (0 or 1); null labels and ids are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, rows=512):
            x = features(batch.column(1).cast(pa.binary()).to_pylist(), *bytes_of(batch.column(1))).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([row.tobytes() for row in x], pa.binary())], ["doc_id", "label", "x"])

    sample = labelled_sample(doc_view(docs, id_col, text_col), labels.select("doc_id", F.col("quality").alias("label")), most)
    rows = sample.select("doc_id", "text", F.col("label").cast("int").alias("label")).mapInArrow(run, "doc_id long, label int, x binary").toArrow()
    order = np.argsort(np.array(rows["doc_id"].to_pylist(), np.int64), kind="stable")
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float16).reshape(-1, 2 * DIMS)[order].astype(np.float32)
    return fit_regression(x, np.array(rows["label"].to_pylist(), np.float32)[order])


def apply_rules(docs: DataFrame, model: Regression, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, probability of every row.

    base_failed: fewer than LEAST_WORDS words, or over MOST_REPEATED_PERCENT of the words in 3-word windows found
    twice. kept: not base_failed and a probability of ``threshold`` or more. Null texts have no words.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, rows=512):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            counts = np.array([rule_counts(t) for t in texts], np.int64).reshape(-1, 5)
            failed = (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED_PERCENT * counts[:, 0])
            p = model.probability(features(texts, *bytes_of(batch.column(1)))).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(counts[:, k]) for k in range(5)), pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p)], ["doc_id", *names, "base_failed", "kept", "probability"])

    return doc_view(docs, id_col, text_col).mapInArrow(run, f"doc_id long, {', '.join(n + ' long' for n in names)}, base_failed boolean, kept boolean, probability double")
