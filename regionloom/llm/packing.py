"""Best-fit packing of tokenised documents after Martello-Toth dominance reduction.

Piece lengths are whole numbers up to the capacity, so an instance is its histogram: at most
``capacity`` counts, whatever the corpus. The driver reduces and packs the histogram into
patterns (multisets of lengths) with multiplicities; the pieces of each length, numbered by
salted counts, then look their pattern and copy up. No group of pieces meets in one task.
"""

from __future__ import annotations

import bisect
import itertools
import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionloom.llm.bpe import SEGMENT, TextCodec, safe_space
from regionloom.llm.common import blocks, checkpointed, doc_view, shuffle_partitions

_CODECS: dict[str, TokenizerCodec] = {}
#: Pieces of text that are joined for one call of the tokenizer, and of the coder by ranks.
JOINED, JOINED_PLAIN = 50, 2000
#: Longest piece that the coder by ranks takes, in characters.
PLAIN_CHARS = 10_000
#: The split pattern of byte-level tokenizer files (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose classes are the same in every version of Unicode.
_PLAIN = re.compile("[\t\n\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]*")


def _alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def rank_coder(tokenizer) -> tiktoken.Encoding | None:
    """A coder by ranks that gives a byte-level BPE tokenizer's ids, where that is certain.

    It merges the pair whose joined token has the least id; the tokenizer merges the first listed pair. Both are the same
    if ids follow the list and every token, coded alone by the list, comes out whole: the shortest token that
    was ever joined from a pair not listed would not.
    """
    spec = json.loads(tokenizer.to_str())
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    usual = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not usual or spec["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
        return None
    ids = [model["vocab"]["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]]
    letters = _alphabet()
    if any(a >= b for a, b in itertools.pairwise(ids)) or any(len(tokenizer.model.tokenize(t)) != 1 or not letters.keys() >= set(t) for t in model["vocab"]):
        return None
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={bytes(map(letters.__getitem__, t)): k for t, k in model["vocab"].items()}, special_tokens={})


class TokenizerCodec:
    """Texts to ids: plain ones whole by ranks where there is a coder by ranks, those with other characters or an added token by pieces."""

    def __init__(self, ranks: tiktoken.Encoding | None, pieces: TextCodec):
        self.ranks, self.pieces = ranks, pieces

    def _by_ranks(self, text: str) -> bytes | None:
        if not self.ranks or any(w in text for w in self.pieces.whole) or not _PLAIN.fullmatch(text):
            return None
        out, at = [], 0
        while at < len(text):
            end = safe_space(text, at + SEGMENT)
            try:
                out.append(self.ranks.encode_to_numpy(text[at:end]).astype("<u4", copy=False).tobytes())
            except ValueError:  # the split pattern gives up on very long white space, as the library's doesn't
                return None
            at = end
        return b"".join(out)

    def ids(self, texts: list[str]) -> list[bytes]:
        """Of each text, its ids as little-endian unsigned 32-bit integers."""
        found = [self._by_ranks(t) for t in texts]
        rest = iter(self.pieces.ids([t for t, ids in zip(texts, found, strict=True) if ids is None]))
        return [next(rest) if ids is None else ids for ids in found]


def tokenizer_codec(path: str) -> TokenizerCodec:
    """The worker's codec around a byte-level tokenizer file of the tokenizers library that splits before single spaces.

    Ids are the library's, added tokens in the text included; plain texts and pieces are coded by ``rank_coder``. A token of a
    byte-level vocabulary is written with a character a byte, so that lengths tell where the pieces of a joined text part.
    """
    if path not in _CODECS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added, ranks = tokenizer.get_added_tokens_decoder(), rank_coder(tokenizer)
        size = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        for token, k in tokenizer.get_vocab(with_added_tokens=False).items():
            size[k] = len(token)

        def coded(pieces: list[str], joined: int, ids_of) -> Iterator[tuple[str, bytes]]:
            groups = [pieces[at : at + joined] for at in range(0, len(pieces), joined)]
            for some, got in zip(groups, ids_of([" " + " ".join(g) for g in groups]), strict=True):
                ids = np.array(got, "<u4")
                lengths = [len(p) + 1 for p in some] if all(map(str.isascii, some)) else [len(p.encode()) + 1 for p in some]
                ends = (4 * (np.searchsorted(np.cumsum(size[ids]), np.cumsum(lengths)) + 1)).tolist()
                yield from zip(some, map(ids.tobytes().__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True)

        def by_library(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        def spaced(pieces: list[str]) -> dict[str, bytes]:
            plain = [p for p in pieces if len(p) <= PLAIN_CHARS and (p.isascii() and p.isprintable() or _PLAIN.fullmatch(p))] if ranks else []
            rest = list(set(pieces).difference(plain)) if len(plain) < len(pieces) else []
            return dict(coded(plain, JOINED_PLAIN, lambda texts: map(ranks.encode_ordinary, texts))) | dict(coded(rest, JOINED, by_library))

        def whole(texts: list[str]) -> dict[str, bytes]:
            some = list(set(texts))
            return {t: np.array(ids, "<u4").tobytes() for t, ids in zip(some, by_library(some), strict=True)}

        _CODECS[path] = TokenizerCodec(ranks, TextCodec(spaced, whole, tuple(token.content for token in added.values())))
    return _CODECS[path]


def cut_pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole if they fit, else the remainder first."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    return [(0, head)] * bool(head) + [(at, capacity) for at in range(head, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document's ids with the end id after them: doc_id, piece, start, length, ids_crc32."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, tail = tokenizer_codec(tokenizer_path), end_id.to_bytes(4, "little")
        for batch in blocks(batches):
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), codec.ids(batch.column(1).to_pylist()), strict=True):
                ids += tail
                rows += [(doc, k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])) for k, (start, n) in enumerate(cut_pieces(len(ids) // 4, capacity))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names)

    return doc_view(docs, id_col, text_col).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _kth_smallest_sums(sizes: list[int], counts: Counter, besides: int) -> list[int]:
    """Sums of the one, two and three smallest items, of those that stay when one of ``besides`` is taken."""
    left, sums, total = 3, [], 0
    for s in sizes:
        n = min(left, counts[s] - (s == besides))
        for _ in range(n):
            total += s
            sums.append(total)
        left -= n
        if not left:
            break
    return sums + [10**18] * (3 - len(sums))


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], Counter]:
    """Bins that some best packing has, as (lengths, times), and the counts of the rest.

    From the largest item j down: j alone when nothing fits beside it; j with one item that fills the
    bin; j with the largest item that fits when no two fit; j with two when no three fit and the larger
    is the largest that fits and the smaller is at least every smaller partner. Each set dominates every
    other feasible set that holds j.
    """
    left = Counter({s: n for s, n in counts.items() if n > 0})
    sizes = sorted(left)
    fixed: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...]) -> None:
        times = min(left[s] // n for s, n in Counter(lengths).items())
        fixed.append((lengths, times))
        for s in lengths:
            left[s] -= times
        for s in set(lengths):
            if not left[s]:
                del left[s]
                sizes.pop(bisect.bisect_left(sizes, s))

    def largest(limit: int, besides: tuple[int, ...]) -> int | None:
        """The largest size up to the limit of which an item is left besides these."""
        k = bisect.bisect_right(sizes, limit) - 1
        while k >= 0 and left[sizes[k]] <= besides.count(sizes[k]):
            k -= 1
        return sizes[k] if k >= 0 else None

    for j in sorted(counts, reverse=True):
        while left.get(j):
            room = capacity - j
            one, two, three = _kth_smallest_sums(sizes, left, j)
            k = largest(room, (j,))
            if one > room:
                take((j,))
            elif k == room or two > room:
                take((j, k))
            elif three > room:
                # partners x >= y with x + y <= room: y is at most room // 2
                y = largest(room // 2, (j,))
                second = largest(room - k, (j, k))
                if second is None or y is None or second < y:
                    break
                take((j, k, second))
            else:
                break
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: (lengths, times) of the bins."""
    open_bins: dict[int, Counter] = {}  # by the room left
    rooms: list[int] = []

    def put(room: int, lengths: tuple[int, ...], times: int) -> None:
        if times:
            if room not in open_bins:
                open_bins[room] = Counter()
                bisect.insort(rooms, room)
            open_bins[room][lengths] += times

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                each = min(n, capacity // size)
                bins = n // each
                put(capacity - each * size, (size,) * each, bins)
                n -= bins * each
                continue
            room = rooms[at]
            lengths, times = open_bins[room].popitem()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(at)
            each = min(n, room // size)
            bins = min(times, n // each)
            put(room, lengths, times - bins)
            put(room - each * size, lengths + (size,) * each, bins)
            n -= bins * each
    return [(lengths, times) for room in open_bins.values() for lengths, times in room.items()]


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    fixed, rest = reduce_dominated(counts, capacity)
    return fixed + best_fit(rest, capacity)


def slot_table(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Of each length in each pattern: (length, first number, end number, first sequence, times a bin, offset)."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for lengths, times in patterns:
        offset = 0
        for size, each in sorted(Counter(lengths).items(), reverse=True):
            rows.append((size, used[size], used[size] + each * times, sequence, each, offset))
            used[size] += each * times
            offset += each * size
        sequence += times
    return rows


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more) with sequence_id and offset. Lengths are 1 to ``capacity``.

    Equal lengths are interchangeable; they're numbered in order of hashed bucket, doc_id and piece, rows that
    are the same in all of these in any order. An empty table gives an empty one.
    """
    spark = pieces.sparkSession
    buckets = max(8, shuffle_partitions(pieces))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(buckets)).cast("int"))
    counted = checkpointed(dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n")))
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most ``capacity`` rows
    slots = spark.createDataFrame(slot_table(pack_histogram(histogram, capacity)), "length long, _first long, _end long, _sequence long, _each long, _offset long")
    before = counted.selectExpr("length", "_bucket", "sum(_n) OVER (PARTITION BY length ORDER BY _bucket) - _n AS _before")
    numbered = (
        dealt.selectExpr("*", "row_number() OVER (PARTITION BY length, _bucket ORDER BY doc_id, piece, start) - 1 AS _k")
        .join(before, ["length", "_bucket"])
        .withColumn("_k", F.col("_k") + F.col("_before"))
    )
    # at most a few thousand slots, as many as the capacity allows: each is a length in a pattern
    found = numbered.join(F.broadcast(slots), (numbered["length"] == slots["length"]) & (F.col("_k") >= F.col("_first")) & (F.col("_k") < F.col("_end"))).drop(slots["length"])
    at = F.col("_k") - F.col("_first")
    return found.select(*pieces.columns, (F.col("_sequence") + F.floor(at / F.col("_each"))).cast("long").alias("sequence_id"), (F.col("_offset") + (at % F.col("_each")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document tokenised, ended with ``end_id``, cut only when longer than ``capacity``, and packed.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null texts count as empty (the end id
    alone); repeated rows are packed each; null doc_ids are kept. Long documents give a first piece of the
    remainder and full pieces after it. ``tokenizer_path`` must be readable on every executor.
    """
    return pack_pieces(checkpointed(token_pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col)), capacity)
