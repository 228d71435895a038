"""Numbers from whole texts, computed block by block: byte classes, hashed n-grams, words."""

from __future__ import annotations

import zlib

import numpy as np

#: Bytes that part words: space and 0x09 to 0x0D, as bytes.split() does.
_CLASSES = {"lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": (32, 9, 11, 12, 13), "newline": (10,), "stop": b".?", "comma": b",;:", "bang": b"!", "symbol": b"#*$%&|<>", "quote": b"\"'`()[]{}", "joint": b"-_/=+@\\~^"}
CLASS_NAMES = (*_CLASSES, "wide", "control")
_CLASS_OF = np.full(256, len(CLASS_NAMES) - 1, np.uint8)
_CLASS_OF[128:] = len(CLASS_NAMES) - 2
for _k, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _k
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
#: Bytes of one long text that are counted at once.
PART_BYTES = 1 << 20
STAT_NAMES = (*CLASS_NAMES, "log_bytes", "word_bytes", "distinct_words", "repeated_lines", "line_bytes", "longest_word")


def _rows(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def class_shares(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Share of each byte class in each text; zeros for empty ones."""
    n = len(CLASS_NAMES)
    if len(offsets) == 2 and len(raw) > PART_BYTES:  # one long text, in parts
        counts = sum(np.bincount(_CLASS_OF[raw[at : at + PART_BYTES]], minlength=n) for at in range(0, len(raw), PART_BYTES))
        return (counts / len(raw))[None, :]
    counts = np.bincount(_rows(offsets) * n + _CLASS_OF[raw], minlength=(len(offsets) - 1) * n).reshape(-1, n)
    return counts / np.maximum(1, np.diff(offsets))[:, None]


def document_stats(texts: list[bytes], raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """STAT_NAMES of each text."""
    rest = []
    for text in texts:
        words, lines = text.split(), text.split(b"\n")
        n = max(1, len(words))
        rest.append((np.log1p(len(text)), sum(map(len, words)) / n, len(set(words)) / n, 1 - len(set(lines)) / len(lines), np.log1p(len(text) / len(lines)), np.log1p(max(map(len, words), default=0))))
    return np.hstack([class_shares(raw, offsets), np.array(rest).reshape(-1, 6)]).astype(np.float32)


def hashed_bytes(raw: np.ndarray, offsets: np.ndarray, n: int, dims: int) -> np.ndarray:
    """Counts of the hashed n-grams of bytes, A-Z as a-z, within each text. ``dims`` is a power of two."""
    count = len(offsets) - 1
    if len(raw) < n:
        return np.zeros((count, dims), np.float32)
    if count == 1 and len(raw) > PART_BYTES + n - 1:  # one long text, in parts that overlap by all but a byte of an n-gram
        parts = (raw[at : at + PART_BYTES + n - 1] for at in range(0, len(raw) - n + 1, PART_BYTES))
        return sum(hashed_bytes(part, np.array([0, len(part)]), n, dims).astype(np.float64) for part in parts).astype(np.float32)
    low = _LOWER[raw]
    m = len(low) - n + 1
    key = low[:m] * np.uint32(0x9E3779B1)
    for k in range(1, n):
        key = (key ^ low[k : k + m]) * np.uint32(0x85EBCA6B + 2 * k)
    key >>= np.uint32(32 - (dims.bit_length() - 1))
    ends = offsets[1:][_rows(offsets)[:m]] if count > 1 else None
    cell = _rows(offsets)[:m] * dims + key
    if ends is not None:
        cell = cell[np.arange(m) + n <= ends]
    return np.bincount(cell, minlength=count * dims).reshape(count, dims).astype(np.float32)


def hashed_words(texts: list[bytes], dims: int) -> np.ndarray:
    """Counts of the hashed words and pairs of neighbouring words, A-Z as a-z. ``dims`` is a power of two."""
    out = np.zeros((len(texts), dims), np.float32)
    shift = np.uint32(32 - (dims.bit_length() - 1))
    for k, text in enumerate(texts):
        words = text.lower().split()
        codes = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        pairs = codes[:-1] * np.uint32(0x9E3779B1) ^ codes[1:]
        out[k] = np.bincount(np.concatenate([codes >> shift, (pairs * np.uint32(0x85EBCA6B)) >> shift]), minlength=dims)
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay."""
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
