"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that differ in at most two bits agree on two of four 16-bit quarters, so each is
dealt to six buckets. A bucket keeps its fingerprints as vertical bit planes; one fingerprint is
compared with all others at once by adding the difference planes into carry-save counters of two
bits, and the comparison stops when every counter has passed the radius. A bucket passes on a
spanning forest of its links, not its pairs; components come from alternating star joins.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionloom.llm.common import blocks, checkpointed, doc_view, packed_rows, unpacked

BITS, RADIUS = 64, 2
#: Bits of each of the four parts; two parts that agree make a bucket.
PART_BITS = 16
PAIRS_OF_PARTS = tuple(itertools.combinations(range(4), 2))
#: Fingerprints compared within one set of bit planes; larger buckets are first parted by further bits.
BUCKET_ROWS = 4096

#: Bytes of a text whose words are held at once.
PART_BYTES = 256 << 10
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def word_parts(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of a text in lower case (A-Z alone), about ``size`` bytes at a time; no word is cut."""
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + size)
        end = space.start() if space else len(text)
        yield text[at:end].translate(_LOWER).replace(b"\x0b", b" ").split()  # split() parts at 0x20 and 0x09-0x0D
        at = end


def shingle_hashes(words: list[bytes], width: int = 3, seed: int = 42) -> list[int]:
    """XXH64 of each run of ``width`` words, repeats included."""
    line = b" ".join(words)
    ends = list(itertools.accumulate(map(len, words)))
    digest = xxhash.xxh64_intdigest
    starts = [0, *(end + k + 1 for k, end in enumerate(ends[: len(words) - width]))]
    return [digest(line[a : b + k], seed) for k, (a, b) in enumerate(zip(starts, ends[width - 1 :]), width - 1)]


def fingerprint(text: bytes, width: int = 3) -> int:
    """A bit is 1 if over half of the shingle hashes have it; fewer than ``width`` words are one shingle. Long texts are taken in parts."""
    out, total, words = np.zeros(64, np.int64), 0, []
    for part in word_parts(text, PART_BYTES):
        words += part
        if len(words) >= width:
            hashes = np.array(shingle_hashes(words, width), "<u8")
            for at in range(0, len(hashes), 8192):
                out += np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(hashes)
            words = words[1 - width :]
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(words), 42) if words else 0
    return int(np.packbits(out * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint's bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            fps = np.array([fingerprint(t) for t in batch.column(1).cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps.view(np.int64))], ["doc_id", "text_hash", "fp"])

    return doc_view(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_hash long, fp long")


def bit_planes(fps: list[int]) -> list[int]:
    """Plane b holds bit b of every fingerprint: bit i of the plane is that of fps[i]."""
    bits = np.unpackbits(np.array(fps, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return [int.from_bytes(np.packbits(bits[:, b], bitorder="little").tobytes(), "little") for b in range(BITS)]


def within_radius(fp: int, planes: list[int], alive: int) -> int:
    """Which of the fingerprints in ``alive`` differ from ``fp`` in at most two bits."""
    ones = twos = 0
    for b, plane in enumerate(planes):
        differ = (plane ^ alive if fp >> b & 1 else plane) & alive
        if differ:
            carry = ones & differ
            ones ^= differ
            over = carry & (twos | 0)
            twos ^= carry
            # three: both counter bits set, or a carry out of the second
            alive &= ~(over | (ones & twos))
            if not alive:
                return 0
            ones &= alive
            twos &= alive
    return alive


def bucket_links(fps: list[int]) -> list[tuple[int, int]]:
    """A spanning forest of the links (two bits or fewer apart) between distinct fingerprints."""
    links: list[tuple[int, int]] = []
    unseen = (1 << len(fps)) - 1
    planes = bit_planes(fps)
    while unseen:
        root = (unseen & -unseen).bit_length() - 1
        unseen &= unseen - 1
        front = [root]
        while front:
            at = front.pop()
            near = within_radius(fps[at], planes, unseen)
            unseen &= ~near
            while near:
                k = (near & -near).bit_length() - 1
                near &= near - 1
                links.append((fps[at], fps[k]))
                front.append(k)
    return links


def links_of(fps: list[int], bits: tuple[int, ...] = tuple(range(BITS))) -> list[tuple[int, int]]:
    """``bucket_links``, parted by bits that differ within large buckets: of three parts of these bits one agrees."""
    if len(fps) <= BUCKET_ROWS:
        return bucket_links(fps)
    free = [b for b in bits if 0 < sum(fp >> b & 1 for fp in fps) < len(fps)]
    if len(free) < 12:  # at most 2 ** 11 fingerprints
        return bucket_links(fps)
    out = []
    for k in range(3):
        part, groups = free[k::3], {}
        mask = sum(1 << b for b in part)
        for fp in fps:
            groups.setdefault(fp & mask, []).append(fp)
        rest = tuple(b for b in free if b not in part)
        for group in groups.values():
            if len(group) > 1:
                out += links_of(group, rest) if len(group) < len(fps) else bucket_links(group)
    return out


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct fingerprints fp, spanning every bucket's linked sets."""
    keys = [f"struct({k} AS part, (shiftrightunsigned(fp, {PART_BITS * i}) & 65535) * 65536 + (shiftrightunsigned(fp, {PART_BITS * j}) & 65535) AS bits)" for k, (i, j) in enumerate(PAIRS_OF_PARTS)]
    dealt = distinct.selectExpr("fp", f"explode(array({', '.join(keys)})) AS k").selectExpr("k.part * 4294967296 + k.bits AS bucket", "fp")

    # a bucket too large for one task is dealt on by parts of the bits that its fingerprints needn't share: two bits at most
    # differ, so that one of three parts agrees
    heavy = checkpointed(dealt.groupBy("bucket").count().where(f"count > {BUCKET_ROWS}").select("bucket"))
    if heavy.limit(1).count():
        other = "CASE bucket DIV 4294967296 " + " ".join(f"WHEN {k} THEN {' + '.join(f'(shiftrightunsigned(fp, {PART_BITS * part}) & 65535) * {65536**n}' for n, part in enumerate(set(range(4)) - set(pair)))}" for k, pair in enumerate(PAIRS_OF_PARTS)) + " END"
        parts = ", ".join(f"xxhash64(bucket, {k}, shiftright({other}, {11 * k}) & 2047)" for k in range(3))
        dealt = dealt.join(heavy, "bucket", "left_anti").unionByName(dealt.join(heavy, "bucket", "left_semi").selectExpr(f"explode(array({parts})) AS bucket", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fps = None, []

        def out(found):
            a = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])

        for batch in batches:
            found = []
            for bucket, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_numpy().view(np.uint64).tolist(), strict=True):
                if bucket != key:
                    if len(fps) > 1:
                        found += links_of(fps)
                    key, fps = bucket, []
                fps.append(fp)
            yield out(found)
        if len(fps) > 1:
            yield out(links_of(fps))

    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "a long, b long")


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """node and component (its smallest node) of every node in ``links`` (a, b), by alternating large and small stars."""
    edges = checkpointed(links.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct())
    for _ in range(most_rounds):
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").selectExpr("b AS a", "m AS b").where("a <> b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a").selectExpr("explode(array(struct(a AS a, m AS b), struct(b AS a, m AS b))) AS e").selectExpr("e.a AS a", "e.b AS b").where("a <> b").distinct()
        after = checkpointed(small)
        # done when every node has one neighbour, and none of these has a smaller one
        unsettled = after.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() or after.alias("x").join(after.alias("y"), F.expr("x.b = y.a"), "left_semi").limit(1).count()
        edges = after
        if not unsettled:
            break
    else:
        raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
    return edges.selectExpr("a AS node", "b AS component").unionByName(edges.selectExpr("b AS node", "b AS component").distinct())


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, fp and component_id of every row."""
    rows = checkpointed(fingerprints(docs, id_col, text_col))
    reps = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    found = components(fingerprint_links(reps.select("fp")))
    classes = reps.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    # a fingerprint of a third of the rows meets one row here, in a join that splits large partitions
    return rows.join(classes.join(smallest, "component").select("fp", "component_id"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (smallest doc_id linked to it) of every row.

    Null and empty texts have fingerprint zero and are linked like others. Rows that repeat a doc_id link their
    fingerprints' components only where fingerprints do; null ids never name a component unless all are null.
    An empty table gives an empty one.
    """
    return grouped(docs, id_col, text_col).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs``, every column, of each component: that of the smallest doc_id, of several with it the least text hash."""
    return one_of_each(docs, grouped(docs, id_col, text_col), id_col, text_col)


def one_of_each(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of ``docs`` that stays of each component in ``groups`` (doc_id, text_hash, fp, component_id)."""
    named = groups.where("doc_id <=> component_id")
    # groups of null ids alone share the name null: the fingerprint of a component's rows tells them apart
    chosen = named.groupBy("component_id", F.expr("IF(component_id IS NULL, fp, NULL)").alias("null_group")).agg(F.min("text_hash").alias("of_hash")).selectExpr("coalesce(component_id, 0) AS k", "component_id IS NULL AS none", "of_hash AS hash").distinct()
    # one shuffle serves the join and the count: both go by k, none and hash
    keyed = packed_rows(docs, id_col, text_col).selectExpr("row", "coalesce(doc, 0) AS k", "doc IS NULL AS none", "xxhash64(txt) AS hash")
    kept = keyed.join(chosen, ["k", "none", "hash"], "left_semi")
    return unpacked(kept.selectExpr("row", "row_number() OVER (PARTITION BY k, none, hash ORDER BY hash) AS nth").where("nth = 1"), docs.columns)
