"""Language identification by nearest centroid: hashed TF-IDF n-grams, several centroids a language, cosine."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionloom.llm.common import blocks, bytes_of, doc_view, fold_of
from regionloom.llm.text_stats import hashed_bytes, unit

#: Rows of each language that centroids are fitted on, at most (about: rows are taken by a hash), and bytes of each.
SAMPLE_ROWS, DIMS, CENTROIDS, ROUNDS = 1000, 4096, 4, 12
#: Rows of all languages together, at most (about): 140 MB of counts.
MOST_ROWS = 8000
GRAMS = (1, 3)
#: A row is marked rejected if its cosine is below this share of the learnt cosines of the language's own rows.
REJECT_QUANTILE = 0.005
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Centroids:
    weights: np.ndarray  # inverse document frequencies
    vectors: np.ndarray  # of length one
    owner: np.ndarray  # index into langs
    langs: list[str]
    least: np.ndarray  # by language, the least cosine that isn't rejected

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language index and cosine."""
        if not self.langs:
            return np.full(len(counts), -1), np.zeros(len(counts))
        cosine = vectors(counts, self.weights) @ self.vectors.T
        best = cosine.argmax(axis=1)
        return self.owner[best], np.clip(cosine[np.arange(len(counts)), best], 0, 1)


def gram_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.hstack([hashed_bytes(raw, offsets, n, DIMS if n > 1 else 256) for n in GRAMS])


def vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """TF-IDF of length one; the term part is a logarithm."""
    return unit(np.log1p(counts) * weights).astype(np.float32)


def cluster(x: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """Spherical k-means: up to k unit centroids."""
    k = min(k, len(x))
    centres = x[np.sort(np.random.default_rng(seed).choice(len(x), k, replace=False))].copy()
    for _ in range(ROUNDS):
        mine = (x @ centres.T).argmax(axis=1)
        for c in range(k):
            if (mine == c).any():
                centres[c] = x[mine == c].mean(axis=0)
        centres = unit(centres)
    return centres


def fit_centroids(counts: np.ndarray, langs: list[str]) -> Centroids:
    names = sorted(set(langs))
    if not names:
        return Centroids(np.zeros(counts.shape[1]), np.zeros((0, counts.shape[1])), np.zeros(0, int), [], np.zeros(0))
    weights = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    x, label = vectors(counts, weights), np.array(langs)
    centres = [cluster(x[label == name], CENTROIDS) for name in names]
    least = [float(np.quantile((x[label == name] @ c.T).max(axis=1), REJECT_QUANTILE)) for name, c in zip(names, centres, strict=True)]
    return Centroids(weights, np.vstack(centres), np.repeat(np.arange(len(names)), [len(c) for c in centres]), names, np.array(least))


def fit(docs: DataFrame, most: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Centroids:
    """Centroids of about ``most`` rows of each language (and MOST_ROWS of all), from text and non-null lang of the learning folds.

    Rows are taken by a hash of their id: a repeated row counts as often as it comes. An empty table gives a model
    that knows no language.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull()).where(fold_of("doc_id") != 1)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    if not sizes:
        return fit_centroids(np.zeros((0, 256 + DIMS), np.float32), [])
    most = max(1, min(most, MOST_ROWS // len(sizes)))  # rows that meet on the driver, whatever the number of languages
    share = F.create_map(*(F.lit(v) for lang, n in sorted(sizes.items()) for v in (lang, int(1_000_000 * min(1, most / n)))))
    taken = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1_000_000)) < share[F.col("lang")]).where(F.col("text").rlike(r"\p{L}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, rows=512):
            x = gram_counts(*bytes_of(batch.column(1))).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([row.tobytes() for row in x], pa.binary())], ["doc_id", "lang", "x"])

    got = taken.mapInArrow(run, "doc_id long, lang string, x binary").toArrow()
    ids = got["doc_id"].fill_null(-1).to_pylist()
    order = np.argsort(np.array(ids, np.int64), kind="stable")
    counts = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(-1, 256 + DIMS)[order]
    langs = got["lang"].to_pylist()
    return fit_centroids(counts, [langs[k] for k in order])


def identify(docs: DataFrame, model: Centroids, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine, 0 to 1), rejected of every row.

    Null texts and texts without a letter are ``und`` with score 0, as is everything when nothing was learnt. A text
    further from its nearest centroid than nearly all that it learnt from is marked rejected; lang_pred stays the nearest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, rows=512):
            lang, score = model.predict(gram_counts(*bytes_of(batch.column(1))))
            lettered = np.array([_LETTER.search(t) is not None for t in batch.column(1).to_pylist()], bool) & (lang >= 0)
            names = [model.langs[k] if ok else "und" for k, ok in zip(lang, lettered, strict=True)]
            score = np.where(lettered, score, 0.0).astype(np.float64)
            far = score < np.append(model.least, 0)[lang] if len(model.least) else np.zeros(len(score), bool)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(far | ~lettered)], ["doc_id", "lang_pred", "score", "rejected"])

    found = doc_view(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
    return found.select("doc_id", (fold_of("doc_id") == 1).alias("held_out"), "lang_pred", "score", "rejected")
