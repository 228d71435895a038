"""Removal of repeated byte strings by bucket-pointer refinement over sampled suffixes.

Two equal strings of LENGTH bytes contain the same least-hashed q-gram at the same place, so it is
enough to sort the suffixes at such anchors (about one position in 35). The q-gram at an anchor is
its initial bucket. Identifiers of longer strings come from those at later offsets by doubling (a
string of 2k bytes is named by its two halves of k): buckets are sorted on the identifier of the
anchor's whole context (all strings of LENGTH bytes that it stands for), which settles all but the
ends of repeats. What is left is refined exactly: the bytes around the anchors are dealt by bucket,
and the suffixes of each pool are sorted on their bucket and the bucket at a later offset, the offset
doubling, until strings of LENGTH bytes are told apart; suffixes alone in their bucket go no further.
The strings of a bucket with very many anchors are dealt singly instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regionloom.llm.common import blocks, bytes_of, checkpointed, packed_rows

LENGTH, GRAM = 100, 32
#: Starts of q-grams within a string of LENGTH bytes.
STARTS = LENGTH - GRAM + 1
#: Bytes whose anchors are compared with each other before the shuffle, and bytes hashed at once (numpy takes some 100 times these).
SEGMENT, HASHED = 2 << 20, 256 << 10
#: Bytes of contexts refined at once (numpy takes some 100 times these), anchors of a bucket that are, and the parts of a hot string's places.
POOL, BUCKET_ROWS, SALTS = 256 << 10, 8192, 16
LAST_ID = 2**63 - 1

_BYTE_IDS = np.random.default_rng(7).integers(0, 2**64, 256, np.uint64)
_POSITION = np.uint64(2**28 - 1)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _name(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The identifier of a string from those of its parts."""
    x = left * _A
    x ^= x >> np.uint64(29)
    x += right
    x *= _B
    x ^= x >> np.uint64(32)
    return x


def _doubled(ids: np.ndarray, k: int) -> np.ndarray:
    return _name(ids[:-k], ids[k:]) if len(ids) > k else ids[:0]


def anchors(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of the documents that end at ``ends`` in ``raw``: gram, context, document, start, place, more.

    An anchor stands for the strings that start at start, ..., start + more; it lies ``place`` after start. Bytes are
    hashed HASHED at a time, which may cut an anchor's strings into those of two.
    """
    found = []
    for at in range(0, max(1, len(raw)), HASHED):
        piece = raw[at : at + HASHED + LENGTH - 1]
        gram, context, doc, start, place, more = _anchors_in(piece, np.minimum(ends - at, len(piece)))
        found.append((gram, context, doc, start + at, place, more))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _anchors_in(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    if len(raw) < LENGTH:
        return none
    ids, named = _BYTE_IDS[raw], {}
    for k in (1, 2, 4, 8, 16, 32):
        ids = _doubled(ids, k)
        named[2 * k] = ids
    gram, long = named[GRAM], named[64]
    least = (gram & ~_POSITION) | np.arange(len(gram), dtype=np.uint64)
    k = 1
    while 2 * k <= STARTS:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    least = np.minimum(least[: len(least) - (STARTS - k)], least[STARTS - k :])
    owner = (least & _POSITION).astype(np.int64)
    starts = np.arange(len(owner))
    doc = np.searchsorted(ends, starts, "right")
    inside = starts + LENGTH <= ends[doc]
    starts, owner, doc = starts[inside], owner[inside], doc[inside]
    if not len(starts):
        return none
    new = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(starts) != 1) | (np.diff(doc) != 0)]))
    first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    place, more, end = owner[new] - first, last - first, last + LENGTH
    context = _name(_name(long[first], long[np.minimum(first + 52, end - 64)]), _name(long[end - 64], (place * 128 + more).astype(np.uint64) * _C))
    return gram[owner[new]], context, doc[new], first, place, more


def _with_part(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (row, doc, txt) with part, and doc_id, part, text of every document: those that share an id are told apart by part, the same rows are one."""
    keyed = rows.withColumn("doc", F.coalesce("doc", F.lit(LAST_ID)))
    repeated = keyed.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc")
    if repeated.limit(1).count() == 0:
        parted = keyed.withColumn("part", F.lit(0))
        return parted, parted.selectExpr("doc AS doc_id", "part", "txt AS text")
    hashed = keyed.withColumn("hash", F.xxhash64("txt"))
    parts = hashed.join(repeated, "doc", "left_semi").select("doc", "hash").distinct().selectExpr("doc", "hash", "row_number() OVER (PARTITION BY doc ORDER BY hash) - 1 AS nth")
    parted = checkpointed(hashed.join(parts, ["doc", "hash"], "left").selectExpr("row", "doc", "txt", "coalesce(nth, 0) AS part"))
    return parted, parted.selectExpr("doc AS doc_id", "part", "txt AS text").dropDuplicates(["doc_id", "part"])


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part, doc_id, at, gram, context; at holds start, place, more and whether the context came earlier within the block, which then has a made-up gram."""
    names = ["part", "doc_id", "at", "gram", "context"]
    for batch in blocks(batches, limit=SEGMENT):
        raw, offsets = bytes_of(batch.column(2))
        doc_ids, parts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for at in range(0, max(1, len(raw)), SEGMENT):
            # one document alone can be longer: its segments overlap by all but a byte of a string
            piece = raw[at : at + SEGMENT + LENGTH - 1] if len(offsets) == 2 else raw
            gram, context, doc, start, place, more = anchors(piece, np.minimum(offsets[1:] - at, len(piece)) if len(offsets) == 2 else offsets[1:])
            begin = start - (offsets[:-1] - (at if len(offsets) == 2 else 0))[doc]
            doc_id, part = doc_ids[doc], parts[doc]
            order = np.lexsort((begin, part, doc_id, context, gram))
            again = np.zeros(len(order), bool)
            again[order[1:]] = (gram[order[1:]] == gram[order[:-1]]) & (context[order[1:]] == context[order[:-1]])
            gram = np.where(again, _name(context, (begin + doc).astype(np.uint64)), gram)
            at_bits = (begin << 15) | (place << 8) | (again.astype(np.int64) << 7) | more
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(doc_id), pa.array(at_bits), pa.array(gram.view(np.int64)), pa.array(context.view(np.int64))], names)
            if len(offsets) != 2:
                break


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, part, text, asked (gram, start, place, more, hot) to a row with the bytes for each that is asked and isn't hot."""
    names = ["gram", "doc_id", "part", "start", "bytes"]
    for batch in blocks(batches, limit=SEGMENT):
        rows = []
        for doc, part, text, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist(), strict=True):
            rows += [(a["gram"], doc, part, a["start"], text[a["start"] : a["start"] + a["more"] + LENGTH]) for a in asked if not a["hot"]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names)


def _single_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``_contexts`` for what is hot: the digest (a, b) and place of each string."""
    names = ["a", "b", "doc_id", "part", "start"]
    for batch in blocks(batches, limit=SEGMENT):
        for doc, part, text, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist(), strict=True):
            starts = sorted({k for a in asked if a["hot"] for k in range(a["start"], a["start"] + a["more"] + 1)})
            if starts:
                ids = np.frombuffer(b"".join(hashlib.blake2b(text[k : k + LENGTH], digest_size=16).digest() for k in starts), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[::2]), pa.array(ids[1::2]), pa.array([doc] * len(starts), pa.int64()), pa.array([part] * len(starts), pa.int32()), pa.array(starts, pa.int64())], names)


def string_buckets(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all strings of LENGTH bytes in the texts that end at ``ends`` in ``raw``, and the bucket of each: equal strings share it.

    Buckets are those of 8 bytes first. Each round sorts the suffixes that aren't alone on their own bucket and that at the offset
    at which it ends, and gives the new buckets numbers of their own; a suffix that is alone keeps its bucket, which later
    rounds of others point to.
    """
    width = 8
    after = np.repeat(ends, np.diff(np.concatenate([[0], ends])))  # end of each byte's text
    at = np.flatnonzero(np.arange(len(raw)) + width <= after)
    grams = np.zeros(len(raw), np.uint64)
    for k in range(width):
        grams[at] = (grams[at] << np.uint64(8)) | raw[at + k]
    bucket = np.full(len(raw), -1, np.int64)
    bucket[at] = np.unique(grams[at], return_inverse=True)[1]
    while width < LENGTH:
        offset = min(width, LENGTH - width)
        at = at[at + width + offset <= after[at]]
        own = bucket[at]
        open_ = at[np.bincount(own, minlength=1)[own] > 1]
        top = bucket.max(initial=0) + 1  # at most rounds times positions, so that a pair fits into a number
        bucket[open_] = top + np.unique(bucket[open_] * top + bucket[open_ + offset], return_inverse=True)[1]
        width += offset
    return at, bucket[at]


def refine_pool(docs: np.ndarray, parts: np.ndarray, starts: np.ndarray, data: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of the strings in ``data``, the bytes around anchors at ``starts`` of documents, those that start earlier elsewhere: doc_id, part, start, end covered."""
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    ends = np.cumsum(sizes)
    at, bucket = string_buckets(np.frombuffer(b"".join(data), np.uint8), ends)
    row = np.searchsorted(ends, at, "right")
    doc, part, start = docs[row], parts[row], starts[row] + at - (ends - sizes)[row]
    order = np.lexsort((start, part, doc, bucket))
    again = np.zeros(len(at), bool)
    again[order[1:]] = bucket[order[1:]] == bucket[order[:-1]]
    # neighbouring strings of one member become one span
    hit = np.flatnonzero(again)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(row[hit]) != 0)])) if len(hit) else hit
    first, last = hit[new], hit[np.append(new[1:], len(hit)) - 1] if len(hit) else hit
    return doc[first], part[first], start[first], start[last] + LENGTH


def _refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole buckets, sorted by gram, refined together in pools of about POOL bytes."""
    held: list[pa.RecordBatch] = []
    size = 0

    def out(rows: pa.Table) -> pa.RecordBatch:
        found = refine_pool(*(rows.column(k).to_numpy() for k in (1, 2, 3)), rows.column(4).to_pylist())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "part", "start", "end"])

    for batch in batches:
        gram = batch.column(0).to_numpy()
        changes = [0, *(np.flatnonzero(np.diff(gram)) + 1).tolist(), len(gram)]
        first = 0
        for a, b in zip(changes[:-1], changes[1:], strict=True):
            if size >= POOL and (first < a or held) and (a or held[-1].column(0)[-1].as_py() != gram[0]):
                yield out(pa.Table.from_batches([*held, batch.slice(first, a - first)]))
                held, size, first = [], 0, a
            size += (b - a) * (LENGTH + 35)
        held.append(batch.slice(first))
    if held:
        yield out(pa.Table.from_batches(held))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    """The spans, each with start and end, as maximal runs in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def _kept(text: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """What is left of the text, the bytes removed and the runs."""
    runs = _merged(spans or [])
    left, at = [], 0
    for start, end in runs:
        left.append(text[at:start])
        at = end
    left.append(text[at:])
    kept = b"".join(left)
    return kept, len(text) - len(kept), len(runs)


def covered_spans(keyed: DataFrame) -> DataFrame:
    """doc_id, part and spans (start, end) covered by strings of LENGTH bytes that start earlier; from doc_id, part, text."""
    rows = keyed.mapInArrow(_anchor_rows, "part int, doc_id long, at long, gram long, context long")
    sorted_rows = rows.repartition("gram").selectExpr(
        "*",
        "row_number() OVER (PARTITION BY gram, context ORDER BY doc_id, part, at) AS nth",
        "min(context) OVER (PARTITION BY gram) <> max(context) OVER (PARTITION BY gram) AS mixed",
        f"count(*) OVER (PARTITION BY gram) > {BUCKET_ROWS} AS hot",
    )
    flagged = checkpointed(sorted_rows.where("at & 128 <> 0 OR nth > 1 OR mixed").selectExpr("part", "doc_id", "IF(nth > 1, at | 128, at) AS at", "gram", "hot"))
    parted = flagged.selectExpr("part", "doc_id", "gram", "shiftright(at, 15) AS start", "CAST(at & 127 AS SMALLINT) AS more", "at & 128 <> 0 AS covered", "hot")
    asked = parted.where("NOT covered").groupBy("doc_id", "part").agg(F.collect_list(F.struct("gram", "start", "more", "hot")).alias("asked"))
    contexts = keyed.join(asked, ["doc_id", "part"]).select("doc_id", "part", "text", "asked")
    spans = parted.where("covered").selectExpr("doc_id", "part", "start", f"start + more + {LENGTH} AS end")
    spans = spans.unionByName(contexts.mapInArrow(_contexts, "gram long, doc_id long, part int, start long, bytes binary").repartition("gram").sortWithinPartitions("gram").mapInArrow(_refined, "doc_id long, part int, start long, end long"))
    if parted.where("hot AND NOT covered").limit(1).count():
        spans = spans.unionByName(_hot_spans(contexts))
    return spans.groupBy("doc_id", "part").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _hot_spans(contexts: DataFrame) -> DataFrame:
    """doc_id, part, start, end of the hot strings that come earlier: their digests are counted before the shuffle, and the places of the repeated ones dealt by salt."""
    strings = contexts.where("exists(asked, a -> a.hot)").mapInArrow(_single_strings, "a long, b long, doc_id long, part int, start long")
    first = strings.groupBy("a", "b").agg(F.min(F.struct("doc_id", "part", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    salted = first.selectExpr("a", "b", "first", f"explode(sequence(0, {SALTS - 1})) AS salt")
    met = strings.withColumn("salt", F.expr(f"pmod(xxhash64(doc_id, start), {SALTS})")).join(salted, ["a", "b", "salt"])
    return met.where("struct(doc_id, part, start) <> first").selectExpr("doc_id", "part", "start", f"start + {LENGTH} AS end")


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of ``docs``; see ``remove_repeats``."""
    # the same three columns as in the search for spans, so that texts are shuffled once
    parted, unique = _with_part(packed_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))))
    rows = parted.selectExpr("doc AS doc_id", "part", "txt AS text").join(covered_spans(unique), ["doc_id", "part"], "left").selectExpr(f"nullif(doc_id, {LAST_ID}) AS doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            kept = [_kept(text, spans) for text, spans in zip(texts, batch.column(2).to_pylist(), strict=True)]
            counts = (pa.array(c, pa.int64()) for c in (list(map(len, texts)), [k[1] for k in kept], [k[2] for k in kept]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array([hashlib.sha256(k[0]).hexdigest() for k in kept])], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, every column, with the text that is left of each; characters of which only a part is left go.

    A byte goes if it is within LENGTH bytes that also start earlier: in a document of smaller doc_id, or
    earlier in the same. Null texts come back empty; shorter texts keep all. The same row again counts once,
    and each such row gets the result; other rows of one doc_id are taken in the order of their texts' hashes. Null
    ids come last. An empty table gives an empty one.
    """
    parted, unique = _with_part(packed_rows(docs, id_col, text_col))
    spans = covered_spans(unique).withColumnsRenamed({"doc_id": "of_doc", "part": "of_part"})
    # the text goes once, beside the other columns
    others = [F.col("row").getField(c).alias(f"c{k}") for k, c in enumerate(docs.columns) if c != text_col]
    rows = parted.select("doc", "part", "txt", F.struct(F.lit(0).alias("none"), *others).alias("row")).join(spans, F.expr("doc = of_doc AND part = of_part"), "left").select("row", "txt", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "txt"):
            texts, spans = batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()
            kept = pa.array([_kept(t, s)[0].decode("utf-8", "ignore") for t, s in zip(texts, spans, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), kept], ["row", "txt"])

    kept = rows.mapInArrow(run, StructType([rows.schema["row"], rows.schema["txt"]]))
    return kept.select(*(F.col("txt" if c == text_col else f"row.c{k}").alias(c) for k, c in enumerate(docs.columns)))
