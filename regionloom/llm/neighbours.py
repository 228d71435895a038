"""Approximate nearest neighbours: graphs by NN-descent over parts of the table, searched greedily.

Vectors that are the same are one node. Nodes are dealt to cells by the nearest of some centres, fitted on a bounded
sample, and large cells to parts of at most about 2 * PART_ROWS by a hash, so that a part fits a task. There the graph
starts from short runs of vectors sorted by random sign codes; NN-descent rounds compare each node with the neighbours
(forward and reverse) of its neighbours, pairs met before left out, until next to no edge is replaced. A query goes to
the parts of the cells nearest to it, as many as hold enough of the true neighbours of a sample of the queries, all if
need be. In each it walks from the best of some entries until its beam holds no node that it hasn't walked from; beams
and entries are doubled until some of the part's queries find enough of the part's own best, so recall hangs neither on
the size of the table nor on that of a part. Scores are inner products of the original vectors in double precision.
Vectors are shuffled twice (to find copies, to their parts), queries once for each part that they visit; jobs and what
the driver holds don't grow with the table, but for a few numbers a cell.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionloom.llm.common import checkpointed, shuffle_partitions

DEGREE, TABLES, RUN_ROWS, PER_RUN = 32, 8, 128, 12
#: Rows of a cell on average at most, and at least where a small table is dealt to all shuffle partitions; cells of over twice as many are split.
PART_ROWS, LEAST_ROWS = 1 << 17, 512
#: NN-descent ends with the round that replaces at most this share of the edges.
SETTLED = 0.002
#: Neighbours of each kind, forward and reverse, that are gone through in a round.
JOINED = 12
#: The first width of a beam, and how many nodes a query walks from in a round.
BEAM, FRONT = 64, 4
#: Queries whose neighbours are looked for among all nodes, the share of these that must lie in the cells visited,
#: queries of a part that are compared with all of it, and the share of their best that beams must find.
SAMPLE, ROUTED, TRIED, ENOUGH = 256, 0.97, 64, 0.95
#: Nodes that the centres of cells are fitted on.
FITTED = 16_384


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v (the array as it was): no null, empty or zero vectors, nor such with null, NaN or infinite components, nor of a length other than the commonest."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    v = v.where("id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) AND exists(v, x -> x <> 0)")
    sizes = v.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return v.where(F.size("v") == (sizes[0]["d"] if sizes else 0))


def raw_vectors(rows: DataFrame) -> tuple[DataFrame, np.dtype]:
    """id and x, the components as bytes, and their type: float32 for an array of float, otherwise float64; -0 is 0."""
    kind = np.dtype(np.float32 if isinstance(rows.schema["v"].dataType.elementType, T.FloatType) else np.float64)
    values = rows if kind == np.float32 else rows.withColumn("v", F.col("v").cast("array<double>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind) + kind.type(0)
                raw = flat.tobytes()
                step = len(raw) // batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([raw[at : at + step] for at in range(0, len(raw), step)], pa.binary())], ["id", "x"])

    return values.select("id", "v").mapInArrow(run, "id long, x binary"), kind


def _matrix(column: pa.Array, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _directions(x: np.ndarray) -> np.ndarray:
    """As float32, lengthened to one; scaled before, so that no square is out of range."""
    y = (x / np.maximum(np.abs(x).max(axis=1, keepdims=True), np.finfo(x.dtype).tiny)).astype(np.float32)
    return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), np.finfo(np.float32).tiny)


def _top(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of each row, in any order."""
    k = min(k, score.shape[1])
    return np.argpartition(-score, k - 1, axis=1)[:, :k] if k else np.zeros((len(score), 0), np.int64)


def _ranked(row: np.ndarray, score: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of entries by row those that are among the ``most`` best of theirs, best first, and the places of these."""
    order = np.lexsort((-score, row))
    row = row[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return order[place < most], place[place < most]


class Graph:
    """A part's nodes with their nearest neighbours by NN-descent, and greedy walks over them.

    The similarity of v to u is the inner product of u's direction with v, which ranks u's neighbours as the inner product does.
    """

    def __init__(self, x: np.ndarray, seed: int = 11):
        self.x, self.n = x, len(x)
        most = np.abs(x).max()
        self.y = (x / most).astype(np.float32)
        self.rng = np.random.default_rng(seed)
        self.ids = np.tile(np.arange(self.n, dtype=np.int32)[:, None], (1, min(DEGREE, max(1, self.n - 1))))  # a node's own number: none
        self.sims = np.full(self.ids.shape, -np.inf, np.float32)
        self.fresh = np.zeros(self.ids.shape, bool)
        self.directions = _directions(x)
        for _ in range(TABLES):
            self._sorted_runs()
        while self.n > 2 and self._round() > SETTLED * self.ids.size:
            pass
        self.around = np.hstack([self.ids, self._reverse(DEGREE)[0]])
        del self.directions, self.sims, self.fresh

    def _merge(self, nodes: np.ndarray, row: np.ndarray, other: np.ndarray, sim: np.ndarray) -> int:
        """Put (row, other) edges, rows counting within ``nodes``, into the lists where they are better; how many came in."""
        ok = sim > self.sims[nodes[row], -1]
        row, other, sim = row[ok], other[ok], sim[ok]
        ok = other != nodes[row]
        row, other, sim = row[ok], other[ok], sim[ok]
        ok = np.ones(len(row), bool)
        for at in range(0, len(row), 1 << 18):  # those in the list already
            part = slice(at, at + (1 << 18))
            ok[part] = ~(self.ids[nodes[row[part]]] == other[part, None]).any(axis=1)
        key, first = np.unique(row[ok].astype(np.int64) * self.n + other[ok], return_index=True)
        if not len(key):
            return 0
        row, other, sim = row[ok][first], other[ok][first], sim[ok][first]
        degree = self.ids.shape[1]
        keep, place = _ranked(row, sim, degree)
        row, other, sim = row[keep], other[keep], sim[keep]
        hit, short = np.unique(row, return_inverse=True)
        new_ids, new_sims = np.zeros((len(hit), degree), np.int32), np.full((len(hit), degree), -np.inf, np.float32)
        new_ids[short, place], new_sims[short, place] = other, sim
        own = nodes[hit]
        ids, sims = np.hstack([self.ids[own], new_ids]), np.hstack([self.sims[own], new_sims])
        fresh = np.hstack([self.fresh[own], np.ones(new_ids.shape, bool)])
        order = np.argsort(-sims, axis=1, kind="stable")[:, :degree]
        came = int(((order >= degree) & (np.take_along_axis(sims, order, 1) > -np.inf)).sum())
        self.ids[own], self.sims[own], self.fresh[own] = (np.take_along_axis(a, order, 1) for a in (ids, sims, fresh))
        return came

    def _sorted_runs(self) -> None:
        """Nodes sorted by random sign codes of their directions; within runs all are compared, and the best of each kept."""
        bits = max(1, math.ceil(math.log2(max(2, self.n / RUN_ROWS)))) + 2
        planes = self.rng.standard_normal((bits + 1, self.x.shape[1])).astype(np.float32)
        side = self.directions @ planes.T
        order = np.lexsort((side[:, bits], (side[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))))
        for at in range(0, self.n, RUN_ROWS):
            run = order[max(0, min(at, self.n - RUN_ROWS)) : at + RUN_ROWS]
            sim = self.directions[run] @ self.y[run].T
            np.fill_diagonal(sim, -np.inf)
            best = _top(sim, min(PER_RUN, len(run) - 1))
            self._merge(run, np.repeat(np.arange(len(run)), best.shape[1]), run[best].ravel(), np.take_along_axis(sim, best, 1).ravel())

    def _reverse(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each node the ``most`` nearest nodes whose neighbour it is (its own number: none), and whether those edges are fresh."""
        degree = self.ids.shape[1]
        ids, fresh = np.tile(np.arange(self.n, dtype=np.int32)[:, None], (1, most)), np.zeros((self.n, most), bool)
        to, known = self.ids.ravel(), np.flatnonzero(self.sims.ravel() > -np.inf)
        order = known[np.lexsort((-self.sims.ravel()[known], to[known]))]
        node = to[order]
        place = np.arange(len(order)) - np.searchsorted(node, node)
        ok = place < most
        ids[node[ok], place[ok]] = order[ok] // degree
        fresh[node[ok], place[ok]] = self.fresh.ravel()[order[ok]]
        return ids, fresh

    def _round(self) -> int:
        """One round of NN-descent; how many edges came in."""
        back, back_fresh = self._reverse(JOINED)
        near = np.hstack([self.ids[:, :JOINED], back])
        near_fresh = np.hstack([self.fresh[:, :JOINED], back_fresh])
        self.fresh[:, :JOINED] = False
        came = 0
        for at in range(0, self.n, 1024):
            nodes = np.arange(at, min(self.n, at + 1024))
            via = near[nodes]
            ok = near_fresh[nodes][:, :, None] | near_fresh[via]
            far = near[via]
            row, a, b = np.nonzero(ok & (far != nodes[:, None, None]))
            if not len(row):
                continue
            key = np.unique(row * self.n + far[row, a, b])
            row, other = key // self.n, key % self.n
            sim = np.concatenate([np.einsum("ij,ij->i", self.directions[nodes[row[k : k + 65536]]], self.y[other[k : k + 65536]]) for k in range(0, len(row), 65536)])
            came += self._merge(nodes, row, other, sim)
        return came

    def scores(self, queries: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Inner products in double precision of each query with its row of nodes."""
        return np.einsum("id,ijd->ij", queries.astype(np.float64), self.x[at].astype(np.float64), optimize=False)

    def brute(self, queries: np.ndarray, top: int) -> np.ndarray:
        """Each query's ``top`` best nodes, all compared in double precision, in any order."""
        best, ids = np.zeros((len(queries), 0)), np.zeros((len(queries), 0), np.int64)
        wide = queries.astype(np.float64)
        for at in range(0, self.n, 16_384):
            x = self.x[at : at + 16_384].astype(np.float64)
            best = np.hstack([best, wide @ x.T])
            ids = np.hstack([ids, np.broadcast_to(np.arange(at, at + len(x)), (len(queries), len(x)))])
            pick = _top(best, top)
            best, ids = np.take_along_axis(best, pick, 1), np.take_along_axis(ids, pick, 1)
        return ids

    def walk(self, directions: np.ndarray, width: int, entries: np.ndarray) -> np.ndarray:
        """Places of the nodes in each query's beam of ``width``, best first, once it holds no open node; -1 for none."""
        q = len(directions)
        seen = np.zeros((q, self.n), bool)
        seen[:, entries] = True
        first = directions @ self.y[entries].T
        pick = _top(first, width)
        ids, score = np.full((q, width), -1, np.int64), np.full((q, width), -np.inf, np.float32)
        ids[:, : pick.shape[1]], score[:, : pick.shape[1]] = entries[pick], np.take_along_axis(first, pick, 1)
        is_open = ids >= 0
        order = np.argsort(-score, axis=1, kind="stable")
        ids, score, is_open = (np.take_along_axis(a, order, 1) for a in (ids, score, is_open))
        while len(live := np.flatnonzero(is_open.any(axis=1))):
            some = is_open[live]
            some &= np.cumsum(some, axis=1) <= FRONT
            row, at = np.nonzero(some)
            row = live[row]
            is_open[row, at] = False
            far = self.around[ids[row, at]]
            key = np.unique((row[:, None] * self.n + far).ravel())
            key = key[~seen.ravel()[key]]
            seen.ravel()[key] = True
            row, node = key // self.n, key % self.n
            new = np.einsum("ij,ij->i", directions[row], self.y[node])
            ok = new > score[row, -1]
            row, node, new = row[ok], node[ok], new[ok]
            if not len(row):
                continue
            hit, short = np.unique(row, return_inverse=True)
            place = np.arange(len(row)) - np.searchsorted(row, row)
            more_ids, more = np.full((len(hit), place.max() + 1), -1, np.int64), np.full((len(hit), place.max() + 1), -np.inf, np.float32)
            more_ids[short, place], more[short, place] = node, new
            all_score = np.hstack([score[hit], more])
            order = np.argsort(-all_score, axis=1, kind="stable")[:, :width]
            ids[hit] = np.take_along_axis(np.hstack([ids[hit], more_ids]), order, 1)
            is_open[hit] = np.take_along_axis(np.hstack([is_open[hit], more_ids >= 0]), order, 1)
            score[hit] = np.take_along_axis(all_score, order, 1)
        return ids

    def searcher(self, tried: np.ndarray, top: int) -> Callable[[np.ndarray], np.ndarray]:
        """A function from queries to the nodes found for each, -1 for none; beams and entries are wide enough for the queries ``tried``."""
        mixed = self.rng.permutation(self.n)
        directions, true = _directions(tried), self.brute(tried, top)
        true_scores = self.scores(tried, true)
        least = true_scores.min(axis=1, keepdims=True)
        width, entries = max(BEAM, 2 * top), max(256, 4 * BEAM)
        while True:
            found = self.walk(directions, min(width, self.n), mixed[:entries])
            got = np.where(found >= 0, self.scores(tried, found), -np.inf)
            if (got >= least - 1e-12 * np.abs(least)).sum() >= ENOUGH * true.size or width >= self.n:
                break
            width, entries = 2 * width, 2 * entries
        return lambda queries: self.walk(_directions(queries), min(width, self.n), mixed[:entries])


def centres_of(nodes: DataFrame, count: int, cells: int, kind: np.dtype) -> np.ndarray:
    """Directions of the centres of cells, by k-means on a sample of at most about FITTED nodes."""
    some = nodes.where(F.pmod(F.xxhash64("u", F.lit(17)), F.lit(1_000_000)) < math.ceil(FITTED / count * 1_000_000)).select("x").limit(2 * FITTED)
    y = _directions(_matrix(some.toArrow()["x"].combine_chunks(), kind))
    if cells == 1 or len(y) < cells:
        return y[:1] if len(y) else np.ones((1, 1), np.float32)
    centres = y[np.random.default_rng(5).choice(len(y), cells, replace=False)]
    for _ in range(8):
        near = (y @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, near, y)
        centres = np.where(np.abs(total).max(axis=1, keepdims=True) > 0, total, centres)
        centres = _directions(centres)
    return centres


def true_cells(some: np.ndarray, nodes: DataFrame, top: int, centres: np.ndarray, kind: np.dtype) -> DataFrame:
    """k, cell: of each query in ``some`` the cells of its ``top`` best nodes, all compared."""
    wide = some.astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, ids, cells = np.zeros((len(some), 0)), np.zeros((len(some), 0), np.int64), np.zeros((len(some), 0), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = _matrix(part.column(1), kind)
                best = np.hstack([best, wide @ x.astype(np.float64).T])
                ids = np.hstack([ids, np.broadcast_to(part.column(0).to_numpy(), (len(some), len(x)))])
                cells = np.hstack([cells, np.broadcast_to((_directions(x) @ centres.T).argmax(axis=1), (len(some), len(x)))])
                pick = _top(best, top)
                best, ids, cells = (np.take_along_axis(a, pick, 1) for a in (best, ids, cells))
        k = np.repeat(np.arange(len(some)), best.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(ids.ravel()), pa.array(best.ravel()), pa.array(cells.ravel())], ["k", "u", "score", "cell"])

    found = nodes.select("u", "x").mapInArrow(run, "k long, u long, score double, cell long")
    return found.selectExpr("*", "row_number() OVER (PARTITION BY k ORDER BY score DESC, u) AS n").where(f"n <= {top}").select("k", "cell")


def cells_needed(sought: DataFrame, nodes: DataFrame, top: int, centres: np.ndarray, kind: np.dtype) -> int:
    """In how many of the cells nearest to a query ROUTED of the true neighbours of SAMPLE queries lie."""
    if len(centres) == 1:
        return 1
    some = sought.orderBy(F.xxhash64("rep", F.lit(3)), "rep").limit(SAMPLE).select("x").toArrow()["x"].combine_chunks()
    if not len(some):
        return 1
    x = _matrix(some, kind)
    found = true_cells(x, nodes, top, centres, kind).toArrow()
    rank = np.argsort(np.argsort(-(_directions(x) @ centres.T), axis=1, kind="stable"), axis=1)[found["k"].to_numpy(), found["cell"].to_numpy()]
    return int(np.quantile(rank, ROUTED, method="higher")) + 1


def own_partitions(nodes: DataFrame, count: int) -> list[int]:
    """A key for each of ``count`` parts, such that a partition by hash gets one each."""
    slots = nodes.sparkSession.range(16 * count + 64).selectExpr("CAST(id AS INT) AS id").selectExpr("id", f"pmod(hash(id), {count}) AS slot")
    keys = [r["id"] for r in slots.groupBy("slot").agg(F.min("id").alias("id")).orderBy("slot").collect()]
    return keys + list(range(16 * count + 64, 17 * count + 64 - len(keys)))


def found_in_parts(nodes: DataFrame, sought: DataFrame, top: int, kind: np.dtype, count: int, exact: bool) -> DataFrame:
    """rep, c, score: of each query (rep, x) the best nodes (u, x) of the parts that it visits, top + 1 of each."""
    rows = min(PART_ROWS, max(LEAST_ROWS, math.ceil(count / shuffle_partitions(nodes))))
    centres = centres_of(nodes, count, max(1, count // rows), kind)

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                cell = (_directions(_matrix(part.column(1), kind)) @ centres.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(cell.astype(np.int32))], ["id", "x", "cell"])

    dealt = nodes.selectExpr("u AS id", "x").mapInArrow(celled, "id long, x binary, cell int")
    sizes = np.zeros(len(centres), np.int64)
    for r in dealt.groupBy("cell").count().collect():
        sizes[r["cell"]] = r["count"]
    parts = np.maximum(1, -(-sizes // (2 * rows)))
    starts = np.cumsum(parts) - parts
    keys = own_partitions(nodes, int(parts.sum()))
    visits = len(centres) if exact else cells_needed(sought, nodes, top, centres, kind)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                near = _top(_directions(_matrix(some.column(1), kind)) @ centres.T, visits)
                for cell in np.unique(near):
                    who = pa.array(np.flatnonzero((near == cell).any(axis=1)))
                    for part in range(starts[cell], starts[cell] + parts[cell]) if sizes[cell] else ():
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(who), keys[part], np.int32)), pa.array(np.full(len(who), True)), some.column(0).take(who), some.column(1).take(who)], ["part", "query", "id", "x"])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, find, ids, graph = None, [], None, None, None

        def answers(queries: np.ndarray, reps: pa.Array) -> pa.RecordBatch:
            places = graph.brute(queries, top + 1) if exact else find(queries)[:, : 2 * top + 1]
            score = np.where(places >= 0, graph.scores(queries, places), -np.inf)
            order = np.lexsort((ids[places], -score), axis=1)[:, : top + 1]
            places, score = np.take_along_axis(places, order, 1), np.take_along_axis(score, order, 1)
            row, at = np.nonzero(score > -np.inf)
            return pa.RecordBatch.from_arrays([reps.take(pa.array(row)), pa.array(ids[places[row, at]]), pa.array(score[row, at])], ["rep", "c", "score"])

        for batch in batches:
            keys = batch.column(0).to_numpy().astype(np.int64) * 2 + batch.column(1).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                some = batch.slice(a, b - a)
                if b > a and keys[a] % 2 == 0:
                    if keys[a] // 2 != part:
                        part, held, find, graph = keys[a] // 2, [], None, None
                    held.append((some.column(2).to_numpy(), _matrix(some.column(3), kind)))
                elif b > a:
                    x = _matrix(some.column(3), kind)
                    if held:
                        ids, rows_x = (np.concatenate(c) for c in zip(*held, strict=True))
                        held = []
                        graph = Graph(rows_x) if not exact else Graph.__new__(Graph)
                        graph.x, graph.n = rows_x, len(rows_x)
                        find = None if exact else graph.searcher(x[:TRIED], min(top + 1, graph.n))
                    step = max(1, min(256, (64 << 20) // len(ids)))
                    for at in range(0, len(x), step):
                        yield answers(x[at : at + step], some.column(2).slice(at, step))

    of_cells = [f"element_at(array({', '.join(map(str, c))}), {{}})" for c in (starts, parts, keys)]
    place = f"{of_cells[0].format('cell + 1')} + CAST(pmod(xxhash64(id), {of_cells[1].format('cell + 1')}) AS INT) + 1"
    vectors = dealt.selectExpr(f"{of_cells[2].format(place)} AS part", "FALSE AS query", "id", "x")
    both = vectors.unionByName(sought.select("rep", "x").mapInArrow(sent, "part int, query boolean, id long, x binary"))
    # nodes of a part in one task, then the queries sent there
    return both.repartition(int(parts.sum()), "part").sortWithinPartitions("part", "query", "id").mapInArrow(searched, "rep long, c long, score double")


def search(vectors: DataFrame, top: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", exact: bool = False) -> DataFrame:
    """The ``top`` nearest rows found for each row whose id is divisible by ``every``: query_id, rank, vec_id, score.

    Nearness is the largest inner product in double precision, ties go to the smaller id. A row is no neighbour of
    itself. Of a repeated id with the same vector one row counts; rows that can't be compared (see ``usable``) take no part. With
    at most ``top`` others all are returned; an empty table gives an empty result. ``exact`` compares every query with
    all rows of all parts instead of walking the graphs. Copies are known by 128 bits of hashes.
    """
    spark = vectors.sparkSession
    rows, kind = raw_vectors(usable(vectors, id_col, vector_col))
    rows = rows.selectExpr("id", "x", "xxhash64(x) AS g", "xxhash64(7, x) AS h")
    nodes = checkpointed(rows.groupBy("g", "h", "x").agg(F.min("id").alias("u"), F.min(F.expr(f"IF(id % {every} = 0, id, NULL)")).alias("rep"), F.count("*").alias("n")))
    count = nodes.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # of the same vectors the top + 1 smallest ids can be in a result; a row number up to a limit is cut before the shuffle
    copied = nodes.where("n > 1").select("g", "h", "u", "rep")
    copies = checkpointed(rows.select("id", "g", "h").join(copied, ["g", "h"]).select("id", "u", "rep").distinct())
    members = copies.selectExpr("u AS c", "id AS member", "row_number() OVER (PARTITION BY u ORDER BY id) AS n").where(f"n <= {top + 1}").drop("n")
    sought = nodes.where("rep IS NOT NULL").select("rep", "x")
    found = found_in_parts(nodes, sought, top, kind, count, exact)
    best = found.selectExpr("*", "row_number() OVER (PARTITION BY rep ORDER BY score DESC, c) AS n").where(f"n <= {top + 1}").drop("n")
    each = best.join(members, "c", "left").selectExpr("rep", "coalesce(member, c) AS member", "score")
    near = each.selectExpr("*", "row_number() OVER (PARTITION BY rep ORDER BY score DESC, member) AS n").where(f"n <= {top + 1}").drop("n")
    asked = copies.where(f"id % {every} = 0").selectExpr("rep", "id AS q")
    named = near.join(asked, "rep", "left").selectExpr("coalesce(q, rep) AS q", "member", "score").where("q <> member")
    ranked = named.selectExpr("q AS query_id", "member AS vec_id", "score", "CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, member) AS INT) AS rank")
    return ranked.where(f"rank <= {top}").select("query_id", "rank", "vec_id", "score")
