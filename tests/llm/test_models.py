"""Scores of the fitted models against plain loops over single rows."""

import math
import zlib

import numpy as np

from regionloom.llm import language_id, quality_classifier, quality_rules, text_stats

TEXTS = [b"The quick brown fox jumps over THE lazy dog.", b"", b"a", "él niño comió pan y más pan".encode(), b"1234 5678\n\n#### !!!!", b"the fox the fox the fox " * 40]


def _flat(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def _slow_grams(text, n, dims):
    out, low, bits = np.zeros(dims), text.lower(), dims.bit_length() - 1
    for at in range(len(low) - n + 1):
        key = low[at] * 0x9E3779B1 % 2**32
        for k in range(1, n):
            key = (key ^ low[at + k]) * (0x85EBCA6B + 2 * k) % 2**32
        out[key >> 32 - bits] += 1
    return out


def _slow_words(text, dims):
    out, bits = np.zeros(dims), dims.bit_length() - 1
    codes = [zlib.crc32(w) for w in text.lower().split()]
    for k, code in enumerate(codes):
        out[code >> 32 - bits] += 1
        if k:
            out[((codes[k - 1] * 0x9E3779B1 % 2**32) ^ code) * 0x85EBCA6B % 2**32 >> 32 - bits] += 1
    return out


def _length_one(x):
    size = math.sqrt(sum(v * v for v in x))
    return x / size if size else x


def test_trees_are_walked_row_by_row():
    r = np.random.default_rng(1)
    x = np.round(r.standard_normal((400, 6)), 1).astype(np.float32)  # ties at the cuts
    trees = quality_classifier.grow(x, (x[:, 0] + x[:, 3] > 0).astype(float))

    def slow(row):
        total = trees.base
        for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
            total += leaf[node - len(feature)]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(trees.score(x), [slow(row) for row in x])
    assert ((trees.score(x) >= 0.5) == (x[:, 0] + x[:, 3] > 0)).mean() > 0.95
    assert quality_classifier.grow(x[:0], np.zeros(0)).score(x).tolist() == [0.5] * len(x)


def test_language_is_the_nearest_centroid():
    raw, offsets = _flat(TEXTS)
    counts = language_id.gram_counts(raw, offsets)
    slow = np.array([np.concatenate([_slow_grams(t, n, 256 if n == 1 else language_id.DIMS) for n in language_id.GRAMS]) for t in TEXTS])
    assert np.array_equal(counts, slow)
    model = language_id.fit_centroids(counts[[0, 3, 4, 5]], ["en", "es", "xx", "en"])
    lang, score = model.predict(counts)
    for k, row in enumerate(slow):
        vector = _length_one(np.log1p(row) * model.weights)
        cosines = [float(sum(vector * c)) for c in model.vectors]
        best = max(cosines)
        assert abs(max(best, 0) - score[k]) < 1e-5
        assert max(c for c, o in zip(cosines, model.owner, strict=True) if o == lang[k]) > best - 1e-5
    assert [model.langs[k] for k in lang[[0, 3, 4, 5]]] == ["en", "es", "xx", "en"]


def test_probability_of_quality():
    raw, offsets = _flat(TEXTS)
    x = quality_rules.features(TEXTS, raw, offsets)
    r = np.random.default_rng(2)
    model = quality_rules.Regression(r.standard_normal(2 * quality_rules.DIMS).astype(np.float32), 0.3, 1.7, -0.2)
    for text, p in zip(TEXTS, model.probability(x), strict=True):
        row = np.concatenate([_length_one(np.sqrt(_slow_words(text, quality_rules.DIMS))), _length_one(np.sqrt(_slow_grams(text, quality_rules.GRAM, quality_rules.DIMS)))])
        assert abs(p - 1 / (1 + math.exp(-((float(row @ model.weights) + 0.3) * 1.7 - 0.2)))) < 1e-4


def test_probability_is_calibrated():
    """Of rows with a probability near p about a share p is good, on rows not fitted on."""
    r = np.random.default_rng(3)
    x = r.standard_normal((4000, 8)).astype(np.float32)
    y = (r.random(4000) < 1 / (1 + np.exp(-(x[:, 0] - x[:, 1])))).astype(np.float32)
    p = quality_rules.fit_regression(x[:3000], y[:3000]).probability(x[3000:])
    for low, high in ((0.0, 0.35), (0.35, 0.65), (0.65, 1.0)):
        mine = (p >= low) & (p < high)
        assert abs(p[mine].mean() - y[3000:][mine].mean()) < 0.08


def test_shares_of_bytes():
    raw, offsets = _flat(TEXTS)
    got = text_stats.class_shares(raw, offsets)
    for text, row in zip(TEXTS, got, strict=True):
        assert abs(row[text_stats.CLASS_NAMES.index("lower")] - sum(97 <= b <= 122 for b in text) / max(1, len(text))) < 1e-12
        assert abs(row.sum() - bool(text)) < 1e-9
