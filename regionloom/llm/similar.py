"""Documents whose sets of word shingles are alike, found by SimHash and bit-sliced comparison.

A set of n shingles that is at least as alike (Jaccard) as asked shares one of its first
n - ceil(similarity * n) + 1 shingles, in any order fixed for all, with the other's: those are the
buckets, taken in order of rising counts so that passages which many documents share come last.
Counts are kept by slots of the hash, a fixed number, over all documents. Within a bucket 128-bit
fingerprints stand as vertical bit planes, and carry-save counters abandon what is beyond the
radius. A bucket passes on a spanning forest of its near pairs, not the pairs. Each component of
these forests then meets with its whole sets, once each, in one task, where all its pairs are
checked exactly and a spanning forest of the links is passed on. Components too large for one
task are dealt to several (``linked``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionloom.llm import simhash
from regionloom.llm.common import blocks, checkpointed, doc_view

WIDTH, SIMILARITY = 5, 0.8
BITS = 128
#: Slots of the hash whose shingles are counted together, and slots of the filter of texts: both of fixed size.
COUNT_BITS, FILTER_BITS = 17, 18
#: ``bucket_pairs`` gives all near pairs of up to so many sets, and of more as many spanning forests, at rising radii. Candidates need one forest.
PAIR_ROWS = 32
FORESTS = 8
#: Sets compared in one task; the rows of larger buckets are dealt to cells, two parts in each.
BUCKET_ROWS = 4096
#: Sets, and shingles of theirs, in a part of a component; two parts are checked in one task. Sets of a large component that all its parts are first compared with.
PART_ROWS, PART_SHINGLES = 1024, 1 << 19
PIVOTS = 16


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The hashes of a text's shingles, once each, in order; fewer than ``width`` words are one shingle, none give none."""
    found, words = [], []
    for part in simhash.word_parts(text, simhash.PART_BYTES):
        words += part
        if len(words) >= width:
            found.append(np.unique(np.array(simhash.shingle_hashes(words, width), np.uint64)))
            words = words[1 - width :] if width > 1 else []
    if not found:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else [], np.uint64)
    return np.unique(np.concatenate(found))


def wide_fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """Two words of 64 bits: a bit is 1 if over half of the hashes, or of the same hashes mixed anew, have it."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        one = hashes[at : at + 8192]
        two = (one ^ (one >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        two ^= two >> np.uint64(32)
        total += np.unpackbits(np.stack([one, two], axis=1).astype("<u8").view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    low, high = np.packbits(total * 2 > len(hashes), bitorder="little").view("<u8").tolist()
    return low, high


def radius_of(similarity: float) -> int:
    """Bits that fingerprints of two sets so alike differ in, and four standard deviations more."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return min(BITS - 1, int(BITS * share + 4 * math.sqrt(BITS * share * (1 - share))))


def within(fp: int, planes: list[int], alive: int, radius: int) -> int:
    """Which of the fingerprints in ``alive`` differ from ``fp`` in at most ``radius`` bits.

    The counters start so that the bit beyond the radius carries out of the last one.
    """
    width = radius.bit_length()
    start = (1 << width) - 1 - radius
    counters = [alive if start >> j & 1 else 0 for j in range(width)]
    for b, plane in enumerate(planes):
        carry = alive & ~plane if fp >> b & 1 else plane & alive
        for j in range(width):
            if not carry:
                break
            counters[j], carry = counters[j] ^ carry, counters[j] & carry
        if carry:
            alive &= ~carry
            if not alive:
                return 0
    return alive


def forest(fps: list[int], planes: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest, by places, of the fingerprints within the radius of each other."""
    links, unseen = [], (1 << len(fps)) - 1
    while unseen:
        root = (unseen & -unseen).bit_length() - 1
        unseen &= unseen - 1
        front = [root]
        while front and unseen:
            at = front.pop()
            near = within(fps[at], planes, unseen, radius)
            unseen &= ~near
            while near:
                k = (near & -near).bit_length() - 1
                near &= near - 1
                links.append((at, k))
                front.append(k)
    return links


def bucket_pairs(fps: list[int], radius: int, forests: int = FORESTS) -> list[tuple[int, int]]:
    """Pairs of places to check: all within the radius in a small bucket, of a larger one forests at rising radii."""
    if len(fps) <= 8:
        return [(i, j) for j in range(len(fps)) for i in range(j) if (fps[i] ^ fps[j]).bit_count() <= radius]
    bits = np.unpackbits(np.frombuffer(b"".join(f.to_bytes(BITS // 8, "little") for f in fps), np.uint8).reshape(len(fps), -1), axis=1, bitorder="little")
    planes = [int.from_bytes(p.tobytes(), "little") for p in np.packbits(bits.T, axis=1, bitorder="little")]
    if len(fps) > PAIR_ROWS:
        radii = sorted({radius * k // forests for k in range(1, forests + 1)})
        return list({pair for r in radii for pair in forest(fps, planes, r)})
    out = []
    for i, fp in enumerate(fps):
        near = within(fp, planes, ((1 << len(fps)) - 1) >> (i + 1) << (i + 1), radius)
        out += [(i, j) for j in range(i + 1, len(fps)) if near >> j & 1]
    return out


def _shingle_counts(docs: DataFrame, width: int) -> np.ndarray:
    """How many documents hold shingles of each slot: a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in blocks(batches):
            slots = [(shingle_set(text, width) >> np.uint64(64 - COUNT_BITS)).astype(np.int64) for text in batch.column(1).cast(pa.binary()).to_pylist()]
            counts += np.bincount(np.concatenate(slots), minlength=len(counts))
        slots = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(counts[slots])], ["slot", "n"])

    out = np.zeros(1 << COUNT_BITS, np.int64)
    table = docs.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out[table["slot"].to_numpy()] = table["n"].to_numpy()
    return out


def _keyed(docs: DataFrame, counts: np.ndarray, width: int, similarity: float) -> DataFrame:
    """doc_id, text_hash, node (the hash of the whole set), its size, fingerprint and leading shingles, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            nodes, sizes, lows, highs, leads = [], [], [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                found = shingle_set(text, width)
                n = len(found)
                order = np.lexsort((found, counts[(found >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]))
                low, high = wide_fingerprint(found)
                nodes.append(xxhash.xxh64_intdigest(found.tobytes()))
                sizes.append(n)
                lows.append(low)
                highs.append(high)
                leads.append(found[order[: n - math.ceil(similarity * n - 1e-9) + 1]].tobytes() if n else b"")
            longs = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in (nodes, sizes, lows, highs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *longs, pa.array(leads, pa.binary())], ["doc_id", "text_hash", "node", "size", "low", "high", "lead"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, node long, size long, low long, high long, lead binary")


def _dealt(classes: DataFrame) -> DataFrame:
    """bucket, node and fingerprint, once for every leading shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "lead"):
            lead = [np.frombuffer(b, np.int64) for b in batch.column(3).to_pylist()]
            times = [len(x) for x in lead]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lead)), *(pa.array(np.repeat(batch.column(k).to_numpy(), times)) for k in range(3))], ["bucket", "node", "low", "high"])

    return classes.select("node", "low", "high", "lead").mapInArrow(run, "bucket long, node long, low long, high long")


def _by_bucket(rows: DataFrame, columns: list[str], schema: str, found: Callable[..., pa.RecordBatch]) -> DataFrame:
    """What ``found`` makes of the columns of whole buckets (long, those of fingerprints unsigned), sorted by bucket and node."""
    kinds = [np.uint64 if c in ("low", "high") else np.int64 for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, t) for t in kinds]
        for batch in batches:
            if not batch.num_rows:
                continue
            held = [np.concatenate([h, batch.column(k).to_numpy().view(h.dtype)]) for k, h in enumerate(held)]
            cut = int(np.searchsorted(held[0], held[0][-1]))  # the last bucket may go on in the next batch
            if cut:
                yield found(*(h[:cut] for h in held))
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield found(*held)

    return rows.select(*columns).repartition("bucket").sortWithinPartitions("bucket", "node").mapInArrow(run, schema)


def _spans(keys: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of equal keys of more than one row."""
    ends = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))
    starts = np.append(0, ends[:-1])
    some = ends - starts > 1
    return list(zip(starts[some].tolist(), ends[some].tolist(), strict=True))


def _fingerprints(low: np.ndarray, high: np.ndarray) -> list[int]:
    return [x | y << 64 for x, y in zip(low.tolist(), high.tolist(), strict=True)]


def spanning(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of the pairs that join what the ones before them don't."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    out = []
    for a, b in pairs:
        if (x := top(a)) != (y := top(b)):
            above[x] = y
            out.append((a, b))
    return out


def candidates(classes: DataFrame, radius: int) -> DataFrame:
    """Pairs (a, b) of nodes that join whatever pairs within the radius join in any bucket: spanning forests."""
    dealt = _dealt(classes)
    heavy = checkpointed(dealt.groupBy("bucket").count().where(f"count > {BUCKET_ROWS}").selectExpr("bucket", f"CAST(ceil(count / {BUCKET_ROWS}) AS INT) AS parts"))
    if heavy.limit(1).count():
        # every two parts of a large bucket meet in one cell
        hot = dealt.join(heavy, "bucket").selectExpr("*", "CAST(pmod(xxhash64(node), parts) AS INT) AS own").selectExpr("*", "explode(sequence(0, parts - 1)) AS other")
        cells = hot.selectExpr("xxhash64(bucket, least(own, other), greatest(own, other)) AS bucket", "node", "low", "high")
        dealt = dealt.join(heavy, "bucket", "left_anti").unionByName(cells)

    def found(keys: np.ndarray, nodes: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
        pairs, names = [], nodes.tolist()
        for start, end in _spans(keys):
            pairs += [(names[start + i], names[start + j]) for i, j in bucket_pairs(_fingerprints(low[start:end], high[start:end]), radius, 1)]
        at = np.array(spanning(pairs), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(at.min(axis=1)), pa.array(at.max(axis=1))], ["a", "b"])

    return _by_bucket(dealt, ["bucket", "node", "low", "high"], "a long, b long", found)


def parted_pairs(fps: list[int], groups: list[int], radius: int) -> list[tuple[int, int]]:
    """All pairs of places within the radius whose groups differ. Only tests call it since whole components are checked."""
    if len(set(groups)) < 2:
        return []
    planes = [0] * BITS
    own = dict.fromkeys(groups, 0)
    for k, (fp, group) in enumerate(zip(fps, groups, strict=True)):
        own[group] |= 1 << k
        while fp:
            planes[(fp & -fp).bit_length() - 1] |= 1 << k
            fp &= fp - 1
    out, after = [], (1 << len(fps)) - 1
    for i, (fp, group) in enumerate(zip(fps, groups, strict=True)):
        after &= ~(1 << i)
        near = within(fp, planes, alive, radius) if (alive := after & ~own[group]) else 0
        while near:
            out.append((i, (near & -near).bit_length() - 1))
            near &= near - 1
    return out


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The rows of ``wanted`` (node, of_hash and more) with their shingles; a filter of fixed size spares most other texts."""
    mask = (1 << FILTER_BITS) - 1
    slots = np.zeros(1 << FILTER_BITS, bool)
    slots[wanted.selectExpr(f"of_hash & {mask} AS slot").distinct().toArrow()["slot"].to_numpy()] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            batch = batch.filter(pa.array(slots[batch.column(2).to_numpy() & mask]))
            sets = [shingle_set(text, width) for text in batch.column(1).cast(pa.binary()).to_pylist()]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["of_hash", "shingles"])

    once = docs.mapInArrow(run, "of_hash long, shingles array<long>").groupBy("of_hash").agg(F.first("shingles").alias("shingles"))
    return wanted.join(once, "of_hash").drop("of_hash")


def alike_links(values: np.ndarray, ends: np.ndarray, groups: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Pairs of places of sets as alike as asked that, with the groups given, join whatever such pairs join.

    Set k is ``values[ends[k]:ends[k + 1]]``, each value once. Sets are compared where they share a leading value, in order
    of rising counts among these sets. A place is done when it was compared with all that are neither done nor of its group;
    the places of the largest group that is left needn't be.
    """
    n, sizes, places = len(ends) - 1, np.diff(ends), np.arange(len(ends) - 1)
    owner = np.repeat(places, sizes)
    _, codes, counts = np.unique(values, return_inverse=True, return_counts=True)
    codes = codes[np.lexsort((codes, counts[codes], owner))]
    leads = (sizes - np.ceil(similarity * sizes - 1e-9) + 1).astype(np.int64)
    lead = (np.arange(len(codes)) - ends[owner] < leads[owner]) & (counts[codes] > 1)
    by = np.argsort(codes[lead], kind="stable")
    holders, starts = owner[lead][by], np.append(0, np.cumsum(np.bincount(codes[lead], minlength=len(counts))))
    names = np.unique(groups, return_inverse=True)[1]
    done, marked, out = np.zeros(n, bool), np.zeros(len(counts), bool), []
    while True:
        left = np.bincount(names[~done], minlength=n)
        others = np.flatnonzero(~done & (names != left.argmax()))
        if not len(others):
            return out
        x = others[0]
        done[x] = True
        own = codes[ends[x] : ends[x + 1]]
        first = own[lead[ends[x] : ends[x + 1]]]
        hit = np.zeros(n, bool)
        hit[holders[_ranges(starts[first], starts[first + 1])]] = True
        near = np.flatnonzero(hit & ~done & (names != names[x]) & (np.minimum(sizes, sizes[x]) >= similarity * np.maximum(sizes, sizes[x]) - 1e-6))
        if len(near):
            marked[own] = True
            common = np.add.reduceat(marked[codes[_ranges(ends[near], ends[near + 1])]], np.append(0, np.cumsum(sizes[near])[:-1]), dtype=np.int64)
            marked[own] = False
            near = near[common / (sizes[near] + sizes[x] - common) >= similarity]
            joined, at = np.unique(names[near], return_index=True)
            out += [(int(x), int(y)) for y in near[at]]
            names[np.isin(names, joined)] = names[x]


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All whole numbers from each start to below its end."""
    lengths = ends - starts
    return np.repeat(starts - np.append(0, np.cumsum(lengths)[:-1]), lengths) + np.arange(lengths.sum()) if len(starts) else np.zeros(0, np.int64)


def _links(cells: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that with the groups join all alike nodes of each cell, from cell, node, group and shingles."""

    def found(table: pa.Table) -> pa.RecordBatch:
        keys, nodes, groups = (table.column(k).to_numpy() for k in range(3))
        shingles = table.column(3).combine_chunks()
        values, ends = shingles.flatten().to_numpy(), np.append(0, np.cumsum(shingles.value_lengths().to_numpy())).astype(np.int64)
        pairs = []
        for start, end in _spans(keys):
            of = ends[start : end + 1]
            pairs += [(start + i, start + j) for i, j in alike_links(values[of[0] : of[-1]], of - of[0], groups[start:end], similarity)]
        at = nodes[np.array(pairs, np.int64).reshape(-1, 2)]
        return pa.RecordBatch.from_arrays([pa.array(at.min(axis=1)), pa.array(at.max(axis=1))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last cell may go on in the next batch
            if held and (cut or keys[0] != last):
                yield found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            elif cut:
                yield found(pa.Table.from_batches([batch.slice(0, cut)]))
            held.append(batch.slice(cut))
            last = keys[-1]
        if held:
            yield found(pa.Table.from_batches(held))

    return cells.select("cell", "node", "group", "shingles").repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(run, "a long, b long")


def _parts(rows: str, shingles: str) -> str:
    return f"CAST(greatest(ceil(({rows}) / {PART_ROWS}), least({rows}, ceil(({shingles}) / {PART_SHINGLES}))) AS INT)"


def _first_cells(sets: DataFrame) -> DataFrame:
    """Components of up to two parts as one cell; larger ones by parts, the pivots in each of them."""
    small = sets.where("parts <= 2").selectExpr("component AS cell", "node", "node AS group", "shingles")
    large = sets.where("parts > 2")
    nth = large.selectExpr("component", "node", "row_number() OVER (PARTITION BY component ORDER BY xxhash64(node), node) AS nth")
    pivots = nth.where(f"nth <= {PIVOTS}").select("node")
    own = "CAST(pmod(xxhash64(node, 1), parts) AS INT)"
    plain = large.join(pivots, "node", "left_anti").selectExpr("component", f"{own} AS part", "node", "shingles")
    all_parts = large.join(pivots, "node", "left_semi").selectExpr("component", "explode(sequence(0, parts - 1)) AS part", "node", "shingles")
    return small.unionByName(plain.unionByName(all_parts).selectExpr("xxhash64(component, part) AS cell", "node", "node AS group", "shingles"))


def _further_cells(large: DataFrame, found: DataFrame) -> DataFrame | None:
    """Cells in which every two nodes of a component meet unless found (node, component) joins them already; none if it joins all.

    The largest group of a component is dealt apart from the rest: its own pairs needn't meet.
    """
    named = large.join(found.withColumnRenamed("component", "group"), "node", "left").withColumn("group", F.coalesce("group", "node"))
    groups = named.groupBy("component", "group").agg(F.count("*").alias("n"), F.sum("size").alias("of"))
    whole = groups.groupBy("component").agg(F.max(F.struct("n", "group", "of")).alias("m"), F.sum("n").alias("n"), F.sum("of").alias("of"))
    plan = checkpointed(whole.where("n > m.n").selectExpr("component", "m.group AS main", f"{_parts('n - m.n', 'of - m.of')} AS others", f"{_parts('m.n', 'm.of')} AS mains"))
    if not plan.limit(1).count():
        return None
    dealt = named.join(plan, "component").selectExpr("*", "CAST(pmod(xxhash64(node, 2), IF(group = main, mains, others)) AS INT) AS own")
    with_main = "transform(sequence(0, IF(group = main, others, mains) - 1), k -> xxhash64(component, 1, IF(group = main, k, own), IF(group = main, own, k)))"
    among = "transform(filter(sequence(0, others - 1), k -> k <> own), k -> xxhash64(component, 2, least(k, own), greatest(k, own)))"
    return dealt.selectExpr(f"explode(concat({with_main}, IF(group = main, array(), {among}))) AS cell", "node", "group", "shingles")


def linked(docs: DataFrame, classes: DataFrame, width: int, similarity: float) -> DataFrame:
    """node, component of the nodes that links of sets as alike as asked join, checked exactly.

    Components of the candidates are checked whole. Of large ones each part is checked, together with a few nodes that all
    parts get, which joins most of what is alike; what isn't joined by then meets in cells, every two parts in one.
    """
    near = checkpointed(simhash.components(candidates(classes, radius_of(similarity))))
    members = near.join(classes.select("node", "of_hash", "size"), "node")
    parts = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("size").alias("of")).selectExpr("component", f"{_parts('n', 'of')} AS parts")
    sets = checkpointed(_sets(docs, checkpointed(members.join(parts, "component")), width))
    links = checkpointed(_links(_first_cells(sets), similarity))
    found = simhash.components(links)
    large = sets.where("parts > 2")
    if large.limit(1).count() and (cells := _further_cells(large, found := checkpointed(found))) is not None:
        found = simhash.components(links.unionByName(_links(cells, similarity)))
    return found


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, fp (the hash of the set) and component_id (smallest doc_id linked to it) of every row."""
    view = doc_view(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    rows = checkpointed(_keyed(view, _shingle_counts(view, width), width, similarity))
    classes = checkpointed(rows.groupBy("node").agg(F.min("doc_id").alias("rep"), F.min("text_hash").alias("of_hash"), *(F.first(c).alias(c) for c in ("size", "low", "high", "lead"))))
    found = linked(view, classes, width, similarity)
    named = classes.select("node", "rep").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    whole = named.join(smallest, "component").select("node", "component_id")
    return rows.select("doc_id", "text_hash", "node").join(whole, "node").withColumnRenamed("node", "fp")


def without_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs``, every column, of each component of similar documents: that of the smallest doc_id.

    Sets of shingles link at a Jaccard similarity of ``similarity`` or more. Texts without a word, null and empty ones
    among them, are one group; texts of fewer words than ``width`` link only to those of the same words. Of several rows
    with the smallest doc_id the one with the least text hash stays. An empty table gives an empty one. A link may be lost
    between two sets whose fingerprints differ by more than four standard deviations beyond the expected bits.
    """
    return simhash.one_of_each(docs, grouped(docs, id_col, text_col, width, similarity), id_col, text_col)
