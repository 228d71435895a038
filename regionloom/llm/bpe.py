"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The words (matches of the vocabulary's split pattern) that a block of documents adds to
what the worker has seen are encoded together: one inverted index goes from the rank of
a mergeable token pair to its positions in all of those words, merges are replayed in
rank order, all positions of a rank at once, and each touches only the two neighbours of
the merged pair. Texts then become joins of known words. Nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from regionloom.llm.common import blocks, doc_view

#: Text bytes whose new words are replayed together.
LEARNT_BYTES = 8 << 20
#: Longest piece of text that is remembered, in characters, how many are, and characters of a text that are cut at once.
PIECE_CHARS, PIECES, SEGMENT = 40, 400_000, 1 << 20
#: A space between two characters that aren't white space: the split pattern always cuts before it.
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_EDGES = re.compile(r" \s|\s ")
_ASCII_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"


def cut_at_spaces(text: str) -> list[str]:
    """The text cut at single spaces between other characters; pieces but the first had one before them."""
    pieces = text.split(" ")
    if "" in pieces or (any(w in text and (" " + w in text or w + " " in text) for w in _ASCII_SPACES) if text.isascii() else _EDGES.search(text)):
        return _SAFE.split(text)
    return pieces


def safe_space(text: str, at: int) -> int:
    """The first place from ``at`` with a single space between other characters, or the end."""
    safe = _SAFE.search(text, at)
    return safe.start() if safe else len(text)


#: Marks a free slot.
_FREE = np.iinfo(np.int64).min


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class MergeReplay:
    """Encodes words by the ranks of a vocabulary; tie and order rules are those of greedy BPE."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.base = max(self.tokens) + 3
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                if (a := ranks.get(token[:cut])) is not None and (b := ranks.get(token[cut:])) is not None:
                    pairs[a * self.base + b + 2] = rank
        # open addressing, a third full: the slot of a pair's key, and the ranks beside the keys
        self.bits = max(4, (3 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, _FREE, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        keys, ranks_of = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(keys)
        while len(keys):
            free, chosen = np.unique(slot, return_index=True)
            chosen = chosen[self.keys[free] == _FREE]
            self.keys[slot[chosen]], self.values[slot[chosen]] = keys[chosen], ranks_of[chosen]
            rest = np.ones(len(keys), bool)
            rest[chosen] = False
            keys, ranks_of, slot = keys[rest], ranks_of[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1 for one that doesn't merge or that has no token (-1 or -2) on a side."""
        keys = left * np.int64(self.base) + (right + 2)
        slot = self._slot(keys)
        there = self.keys[slot]
        hit = there == keys
        out = np.where(hit, self.values[slot], np.int32(-1))
        rest = np.flatnonzero((there != _FREE) > hit)
        while len(rest):  # slots taken by others: on to the next
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[rest]]
            hit = there == keys[rest]
            out[rest[hit]] = self.values[slot[rest[hit]]]
            rest = rest[~hit & (there != _FREE)]
        return out

    def encode(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """The ids of each distinct word, as little-endian unsigned 32-bit integers. A word that is itself a token gets that token."""
        out: dict[bytes, bytes] = {}
        todo = []
        for word in set(words):
            if (whole := self.ranks.get(word)) is not None:
                out[word] = whole.to_bytes(4, "little")
            elif word:
                todo.append(word)
            else:
                out[word] = b""
        if todo:
            self._replay(todo, out)
        return out

    def _replay(self, words: list[bytes], out: dict[bytes, bytes]) -> None:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        ends = np.cumsum(lengths + 1) - 1
        ids = self.single[raw]
        ids[ends] = -1  # stands between words, where no pair goes across
        ids = np.append(ids, np.int32(-1))
        right = np.minimum(np.arange(1, len(ids) + 1), len(ids) - 1)
        left = np.arange(-1, len(ids) - 1)
        first = self._ranks(ids[:-1], ids[1:])
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0) :]
        present, begin = np.unique(first[order], return_index=True)
        at = [*begin.tolist(), len(order)]
        index: dict[int, list] = {r: [order[a:b]] for r, a, b in zip(present.tolist(), at[:-1], at[1:], strict=True)}
        queue = list(index)  # sorted, so a heap
        while queue:
            rank = heapq.heappop(queue)
            found = index.pop(rank)
            places = found[0] if len(found) == 1 else np.concatenate(found)
            places.sort()
            then = right[places]
            # others were changed by a merge or came twice
            fits = self._ranks(ids[places], ids[then]) == rank
            fits[1:] &= places[1:] != places[:-1]
            if not fits.all():
                places, then = places[fits], then[fits]
            chained = np.flatnonzero(then[:-1] == places[1:])
            if len(chained):  # places that share a token: every second one of a run merges, from the left
                keep = np.ones(len(places), bool)
                for k in chained.tolist():
                    keep[k + 1] = not keep[k]
                places, then = places[keep], then[keep]
            if not len(places):
                continue
            after = right[then]
            ids[places], ids[then] = rank, -2
            right[places], left[after] = after, places
            before = left[places]
            starts = np.concatenate([before[before >= 0], places])
            new = self._ranks(ids[starts], ids[right[starts]])
            met = new >= 0
            if met.any():
                starts, new = starts[met], new[met]
                order = np.argsort(new, kind="stable")
                starts, new = starts[order], new[order]
                cuts = np.flatnonzero(new[1:] != new[:-1]) + 1
                at = [0, *cuts.tolist(), len(new)]
                groups = ((r, starts[a:b]) for r, a, b in zip(new[at[:-1]].tolist(), at[:-1], at[1:], strict=True))
                for r, p in groups:
                    if r in index:
                        index[r].append(p)
                    else:
                        index[r] = [p]
                        heapq.heappush(queue, r)
        kept = ids >= 0
        bounds = np.concatenate([[0], np.cumsum(kept)[ends]]) * 4
        coded = ids[kept].astype("<u4").tobytes()
        out.update(zip(words, (coded[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)), strict=True))


class TextCodec:
    """Texts to ids, remembering the pieces between spaces that came often.

    ``encode_spaced`` gives the ids (little-endian unsigned 32-bit integers) of distinct pieces, each with a space put
    before it, ``encode_plain`` those of texts. Texts that hold one of ``whole`` aren't cut.
    """

    def __init__(self, encode_spaced, encode_plain, whole: tuple[str, ...] = ()):
        self.encode_spaced, self.encode_plain, self.whole = encode_spaced, encode_plain, whole
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, missing: set[str]) -> list[str]:
        """Makes the pieces known; gives those that are too long to be remembered."""
        known, older = self.known, self.older
        known.update((piece, older[piece]) for piece in missing.intersection(older))
        new = self.encode_spaced(list(missing.difference(known)))
        known.update(new)
        return [piece for piece in new if len(piece) > PIECE_CHARS]

    def _known_ids(self, groups: list[list[str]]) -> list[bytes]:
        if len(self.known) > PIECES:
            self.known, self.older = {}, self.known
        known = self.known
        found = [list(map(known.get, pieces)) for pieces in groups]
        gaps = []
        for pieces, coded in zip(groups, found, strict=True):
            at = -1
            for _ in range(coded.count(None)):
                at = coded.index(None, at + 1)
                gaps.append((coded, at, pieces[at]))
        long = self._learn({piece for _, _, piece in gaps}) if gaps else []
        for coded, at, piece in gaps:
            coded[at] = known[piece]
        out = list(map(b"".join, found))
        for piece in long:
            del known[piece]
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        """Of each text, its ids as little-endian unsigned 32-bit integers."""
        cut = [[t] if any(w in t for w in self.whole) else cut_at_spaces(t) if len(t) <= SEGMENT else None for t in texts]
        rest = iter(self._known_ids([pieces[1:] for pieces in cut if pieces is not None]))
        first = self.encode_plain([pieces[0] for pieces in cut if pieces is not None])
        return [self._long(t) if pieces is None else first[pieces[0]] + next(rest) for t, pieces in zip(texts, cut, strict=True)]

    def _long(self, text: str) -> bytes:
        """A long text's ids, cut at a safe space about every SEGMENT characters."""
        out, at, lead = [], 0, False
        while at < len(text):
            end = safe_space(text, at + SEGMENT)
            pieces = cut_at_spaces(text[at:end])
            if not lead:
                out.append(self.encode_plain(pieces[:1])[pieces[0]])
                pieces = pieces[1:]
            out += self._known_ids([pieces])
            at, lead = end + 1, True
        return b"".join(out)


_CODECS: dict[tuple, tuple] = {}


def rank_codec(path: str, pattern: str) -> tuple[TextCodec, MergeReplay]:
    """The worker's codec for a rank file; made once for each Python worker."""
    if (path, pattern) not in _CODECS:
        replay = MergeReplay(read_ranks(path))

        split = regex.compile(pattern).findall

        def encode(cut: dict[str, list[str]]) -> dict[str, bytes]:
            raw = {w: w.encode() for words in cut.values() for w in words}
            coded = replay.encode(raw.values())
            ids = {w: coded[b] for w, b in raw.items()}
            return {piece: b"".join(map(ids.__getitem__, words)) for piece, words in cut.items()}

        _CODECS[path, pattern] = TextCodec(lambda pieces: encode({p: split(" " + p) for p in pieces}), lambda texts: encode({t: split(t) for t in texts})), replay
    return _CODECS[path, pattern]


def decode(ids: bytes, tokens: dict[int, bytes]) -> bytes:
    """The bytes of ids given as little-endian unsigned 32-bit integers."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's ids and the bytes they decode to: doc_id, ids binary (little-endian uint32), decoded binary.

    Null and empty texts have no ids and decode to nothing. Repeated rows, null ids and repeated ids give a row each.
    ``ranks_path`` must be readable on every executor.
    """
    return _per_document(docs, ranks_path, pattern, id_col, text_col, "doc_id long, ids binary, decoded binary", lambda ids, decoded: ([ids, decoded], [pa.binary(), pa.binary()]))


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_documents`` reduced where it runs: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def digest(ids, decoded):
        return ([[len(x) // 4 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids], [hashlib.sha256(x).hexdigest() for x in decoded]], [pa.int64(), pa.string(), pa.string()])

    return _per_document(docs, ranks_path, pattern, id_col, text_col, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", digest)


def _per_document(docs, ranks_path, pattern, id_col, text_col, schema, columns) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, replay = rank_codec(ranks_path, pattern)
        for batch in blocks(batches, limit=LEARNT_BYTES):
            ids = codec.ids(batch.column(1).to_pylist())
            values, types = columns(ids, [decode(x, replay.tokens) for x in ids])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, t) for v, t in zip(values, types, strict=True))], names)

    return doc_view(docs, id_col, text_col).mapInArrow(run, schema)
