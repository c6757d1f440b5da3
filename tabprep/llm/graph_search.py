"""Approximate nearest neighbours on robust-pruned directed graphs.

(Subramanya et al., "DiskANN", 2019; batches as in Manohar et al., "ParlayANN", 2024.)

1. **Shards.**  Rows are dealt to shards by a hash of their row number, so copies of
   one vector spread evenly.  There are about ``sqrt(rows / SPREAD)`` shards, but
   none above ``MOST`` rows: a query visits each shard, so few large shards keep
   the queries' work below that of building the graphs.
2. **Graph.**  A shard's equal vectors are one point (of its copies, only the
   smallest ids can ever be among the nearest, so ``k + 1`` are kept).  Points join the graph in
   batches of growing size.  A greedy search from the middle point proposes
   neighbours for each; robust pruning walks through them from the nearest on and drops
   those that are ``ALPHA`` times nearer to a kept neighbour than to the point, which
   keeps diverse edges, long ones too.  Each edge is also offered backwards, and a
   point above ``SLOTS`` edges is pruned again.
3. **Search.**  The stored graphs and the queries (sent to every shard) meet in one
   shuffle; a task holds one shard's graph and answers its queries in batches as
   they arrive, by a beam search of width ``BEAM``.  What the beam holds is measured
   again on the original vectors, in doubles.  A query's results of all shards are merged.

Searches of many points advance together as array operations; every shard's graph
depends on its rows alone, so a lost task gives the same graph again.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
take no part, as query or candidate; vectors of different lengths never meet; rows are told
apart by number, so of repeated ids only the query's own row is left out, and each row
of a repeated query id gets its own results; null ids are candidates, last among ties;
fewer candidates than ``k`` are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.llm.common import list_array, store, table

K, DEGREE, SLOTS, BUILD_BEAM, BEAM, ALPHA, STEP, BATCH = 10, 28, 40, 48, 160, 1.2, 4, 256
SPREAD, MOST, QUERIES_AT_ONCE, SEED = 2048, 262_144, 256, 13
NULL_ID = np.iinfo(np.int64).max


def shards_of(rows: int) -> int:
    return max(1, math.ceil(math.sqrt(rows / SPREAD)), math.ceil(rows / MOST))


class Graph:
    """Points (rows of ``x``) and their edges, an array (points, SLOTS) padded with -1."""

    def __init__(self, x: np.ndarray, edges: np.ndarray | None = None):
        self.original = x
        scale = np.abs(x).max(initial=0) or 1.0
        self.scale = scale
        self.x = (x / scale).astype(np.float32)
        self.middle = int(((self.x - self.x.mean(axis=0)) ** 2).sum(axis=1).argmin()) if len(x) else 0
        self.edges = edges if edges is not None else np.full((len(x), SLOTS), -1, np.int32)

    # ------------------------------------------------------------ greedy search

    def search(self, queries: np.ndarray, beam: int, members: np.ndarray | None = None):
        """(nodes, squared distances) of each query's beam, nearest first; padded with -1 and infinity.

        ``members`` are points whose own row is the query: they are not their own neighbours.
        """
        n, rows = len(queries), np.arange(len(queries))
        node = np.full((n, beam), -1, np.int32)
        near = np.full((n, beam), np.inf, np.float32)
        open_ = np.zeros((n, beam), bool)
        seen = np.zeros((n, len(self.x)), bool)
        node[:, 0], open_[:, 0] = self.middle, True
        near[:, 0] = ((self.x[self.middle] - queries) ** 2).sum(axis=1)
        seen[:, self.middle] = True
        if members is not None:
            seen[rows, members] = True
            own = members == self.middle  # still the way in, but left out of the result below
        live = rows
        while len(live):
            # each live query expands its STEP nearest open nodes
            place = np.cumsum(open_[live], axis=1)
            pick = open_[live] & (place <= STEP)
            at, slot = np.nonzero(pick)
            mine = live[at]
            open_[mine, slot] = False
            to = self.edges[node[mine, slot]]
            who = np.broadcast_to(mine[:, None], to.shape)[to >= 0]
            to = to[to >= 0]
            fresh = ~seen[who, to]
            who, to = who[fresh], to[fresh]
            key = np.unique(who.astype(np.int64) * len(self.x) + to)  # two expanded nodes may share a neighbour
            who, to = key // len(self.x), key % len(self.x)
            seen[who, to] = True
            gap = self.x[to] - queries[who]
            d = np.einsum("ij,ij->i", gap, gap)
            keep = d < near[who, -1]
            who, to, d = who[keep], to[keep], d[keep]
            if len(who):
                got, first, many = np.unique(who, return_index=True, return_counts=True)
                wide = int(many.max())
                new_node, new_near = np.full((len(got), wide), -1, np.int32), np.full((len(got), wide), np.inf, np.float32)
                row, col = np.repeat(np.arange(len(got)), many), np.arange(len(who)) - np.repeat(first, many)
                new_node[row, col], new_near[row, col] = to, d
                all_near = np.concatenate([near[got], new_near], axis=1)
                order = np.argsort(all_near, axis=1, kind="stable")[:, :beam]
                near[got] = np.take_along_axis(all_near, order, axis=1)
                node[got] = np.take_along_axis(np.concatenate([node[got], new_node], axis=1), order, axis=1)
                open_[got] = np.take_along_axis(np.concatenate([open_[got], new_node >= 0], axis=1), order, axis=1)
            live = live[open_[live].any(axis=1)]
        if members is not None and own.any():
            node[own], near[own] = np.where(node[own] == self.middle, -1, node[own]), \
                np.where(node[own] == self.middle, np.inf, near[own])
        return node, near

    # ------------------------------------------------------------ pruning

    def prune(self, points: np.ndarray, pool: np.ndarray, near: np.ndarray, alpha: float) -> np.ndarray:
        """(points, DEGREE) diverse neighbours out of each point's pool (-1: none)."""
        order = np.argsort(near, axis=1, kind="stable")
        pool, near = np.take_along_axis(pool, order, axis=1), np.take_along_axis(near, order, axis=1)
        same = np.zeros(pool.shape, bool)  # a node that came twice has equal distances: neighbours in the order
        same[:, 1:] = (pool[:, 1:] == pool[:, :-1])
        alive = (pool >= 0) & np.isfinite(near) & ~same & (pool != points[:, None])
        v = self.x[np.maximum(pool, 0)]
        square = np.einsum("bcd,bcd->bc", v, v)
        apart = square[:, :, None] + square[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
        out, rows = np.full((len(points), DEGREE), -1, np.int32), np.arange(len(points))
        for i in range(DEGREE):
            has = alive.any(axis=1)
            if not has.any():
                break
            best = alive.argmax(axis=1)
            out[has, i] = pool[rows, best][has]
            alive &= (alpha * alpha * apart[rows, best] > near) | ~has[:, None]
            alive[rows, best] = False
        return out

    def _distances(self, points: np.ndarray, pool: np.ndarray) -> np.ndarray:
        gap = self.x[np.maximum(pool, 0)] - self.x[points][:, None]
        return np.where(pool >= 0, np.einsum("bcd,bcd->bc", gap, gap), np.inf)

    def _insert(self, points: np.ndarray, alpha: float) -> None:
        node, near = self.search(self.x[points], BUILD_BEAM, points)
        old = self.edges[points]
        pool = np.concatenate([node, old], axis=1)
        kept = self.prune(points, pool, np.concatenate([near, self._distances(points, old)], axis=1), alpha)
        self.edges[points] = -1
        self.edges[points, :DEGREE] = kept
        # the same edges backwards
        source, target = np.repeat(points, DEGREE), kept.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        while len(source):  # at most DEGREE new edges a point at a time
            got, first, many = np.unique(target, return_index=True, return_counts=True)
            col = np.arange(len(target)) - np.repeat(first, many)
            now = col < DEGREE
            row = np.repeat(np.arange(len(got)), many)[now]
            new = np.full((len(got), DEGREE), -1, np.int32)
            new[row, col[now]] = source[now]
            both = np.concatenate([self.edges[got], new], axis=1)
            both.sort(axis=1)
            both = both[:, ::-1].copy()
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            full = (both >= 0).sum(axis=1) > SLOTS
            for at in range(0, len(got), 1024):
                some = np.arange(at, min(at + 1024, len(got)))
                part = some[full[some]]
                if len(part):
                    pruned = self.prune(got[part], both[part], self._distances(got[part], both[part]), alpha)
                    self.edges[got[part]] = -1
                    self.edges[got[part], :DEGREE] = pruned
            rest = np.flatnonzero(~full)
            few = np.sort(both[rest], axis=1)[:, ::-1][:, :SLOTS]
            self.edges[got[rest]] = few
            source, target = source[~now], target[~now]

    def build(self) -> Graph:
        """Points join in a random order, by batches of at most ``BATCH`` and a quarter of the graph."""
        order = np.random.default_rng(SEED).permutation(len(self.x))
        order = np.append(self.middle, order[order != self.middle]) if len(order) else order
        at, batch = 1, 1
        while at < len(order):
            self._insert(order[at:at + batch], ALPHA)
            at, batch = at + batch, min(max(1, (at + batch) // 4), BATCH)
        return self

    # ------------------------------------------------------------ queries

    def nearest(self, queries: np.ndarray, beam: int = BEAM):
        """(query row, node, distance) of all that each query's beam holds, exact in doubles."""
        found, _ = self.search((queries / self.scale).astype(np.float32), min(beam, max(1, len(self.x))))
        q, col = np.nonzero(found >= 0)
        node = found[q, col]
        return q, node, exact_distances(queries[q], self.original[node])


def exact_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, also where squares leave the number range."""
    gap = a - b
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        total = (gap * gap).sum(axis=1)
        out = np.sqrt(total)
        odd = ~np.isfinite(total) | (total < 1e-280)
        if odd.any():
            a, b = a[odd], b[odd]
            half = a / 2 - b / 2  # finite
            most = np.maximum(np.abs(half).max(axis=1, initial=0), np.finfo(float).tiny)
            out[odd] = 2 * most * np.sqrt(((half / most[:, None]) ** 2).sum(axis=1))
    return out


_GRAPH = "shard string, kind int, point int, v array<double>, ids array<long>, rows array<long>, edges array<int>"


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, row, v) of the rows that take part, stored, which fixes the row numbers."""
    x = F.transform(qcol(vector).cast("array<double>"), lambda c: c + F.lit(0.0))  # one zero
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(qcol(key).cast("long").alias("id"), x.alias("v")) \
        .where(F.col("v").isNotNull() & finite & F.exists("v", lambda c: c != 0))
    return store(rows.withColumn("row", F.monotonically_increasing_id()), "graph-vectors")


def _shard(n: int) -> Column:
    """Length of the vector and shard number: vectors of different lengths never meet."""
    return F.concat_ws("|", F.size("v").cast("string"), F.pmod(F.xxhash64("row", F.lit(SEED)), F.lit(n)).cast("string"))


def _by_shard(batches: Iterator[pa.RecordBatch], shard: int) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Runs of rows of one shard; rows arrive sorted by it."""
    for batch in batches:
        names = batch.column(shard).to_numpy(zero_copy_only=False)
        edge = np.flatnonzero(names[1:] != names[:-1]) + 1 if len(names) else []
        for lo, hi in zip([0, *edge], [*edge, len(names)]):
            if hi > lo:
                yield names[lo], batch.slice(lo, hi - lo)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def build_graphs(rows: DataFrame, n_shards: int, k: int = K) -> DataFrame:
    """The stored graphs: a row per point, with the ids and row numbers of its smallest copies and its edges."""

    def graph_of(name: str, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = np.concatenate([_matrix(p.column(3)) for p in parts])
        ids = np.concatenate([p.column(1).to_numpy(zero_copy_only=False).astype(np.int64) for p in parts])
        row = np.concatenate([p.column(2).to_numpy() for p in parts])
        order = np.lexsort((row, ids))
        x, ids, row = x[order], ids[order], row[order]
        kind = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
        _, first, of = np.unique(kind, return_index=True, return_inverse=True)
        by = np.argsort(of, kind="stable")  # a point's copies together, smallest ids first
        edge = np.append(np.searchsorted(of[by], np.arange(len(first))), len(by))
        copies = [by[lo:min(hi, lo + k + 1)] for lo, hi in zip(edge[:-1], edge[1:])]
        graph = Graph(x[first]).build()
        for lo in range(0, len(first), 4096):
            some = slice(lo, lo + 4096)
            edges = graph.edges[some]
            n = len(edges)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n), pa.array(np.zeros(n, np.int32)), pa.array(np.arange(lo, lo + n, dtype=np.int32)),
                 list_array(list(graph.original[some]), pa.float64()), list_array([ids[c] for c in copies[some]], pa.int64()),
                 list_array([row[c] for c in copies[some]], pa.int64()), list_array(list(edges), pa.int32())],
                ["shard", "kind", "point", "v", "ids", "rows", "edges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, parts = None, []
        for shard, part in _by_shard(batches, 0):
            if shard != name and parts:
                yield from graph_of(name, parts)
                parts = []
            name = shard
            parts.append(part)
        if parts:
            yield from graph_of(name, parts)

    dealt = rows.select(_shard(n_shards).alias("shard"), F.coalesce("id", F.lit(int(NULL_ID))).alias("id"), "row", "v") \
        .repartition(n_shards, "shard").sortWithinPartitions("shard")
    return store(dealt.mapInArrow(run, _GRAPH), "graphs")


def search_graphs(graphs: DataFrame, queries: DataFrame, n_shards: int, k: int = K, beam: int = BEAM) -> DataFrame:
    """(query_row, query_id, vec_id, row, score): the k nearest that each shard finds, for queries of (id, row, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, graph, parts = None, None, []
        ids = own = None
        for shard, part in _by_shard(batches, 0):
            if shard != name:
                name, graph, parts = shard, None, []
            kinds = part.column(1).to_numpy()
            points, asked = part.slice(0, int((kinds == 0).sum())), part.slice(int((kinds == 0).sum()))
            if points.num_rows:  # a shard's points come first, in order
                parts.append(points)
            if not asked.num_rows or not parts:
                continue
            if graph is None:
                graph = Graph(np.concatenate([_matrix(p.column(3)) for p in parts]),
                              np.concatenate([_matrix(p.column(6)) for p in parts]))
                ids = pa.chunked_array([p.column(4) for p in parts]).combine_chunks()
                own = pa.chunked_array([p.column(5) for p in parts]).combine_chunks()
                start, ids, own = ids.offsets.to_numpy(), ids.flatten().to_numpy(), own.flatten().to_numpy()
            for at in range(0, asked.num_rows, QUERIES_AT_ONCE):
                some = asked.slice(at, QUERIES_AT_ONCE)
                query_row = some.column(5).flatten().to_numpy()
                q, node, d = graph.nearest(_matrix(some.column(3)), beam)
                many = start[node + 1] - start[node]
                copy = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start[node], many)
                q, d = np.repeat(q, many), np.repeat(d, many)
                not_own = own[copy] != query_row[q]
                q, d, copy = q[not_own], d[not_own], copy[not_own]
                order = np.lexsort((own[copy], ids[copy], d, q))
                q, d, copy = q[order], d[order], copy[order]
                rank = np.arange(len(q)) - np.searchsorted(q, q)
                top = rank < k
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_row[q[top]]), some.column(4).flatten().take(pa.array(q[top])), pa.array(ids[copy[top]]),
                     pa.array(own[copy[top]]), pa.array(d[top])], ["query_row", "query_id", "vec_id", "row", "score"])

    none = F.array().cast("array<int>")
    number = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))
    asked = queries.select("id", "row", "v", number.alias("n")).select(
        F.concat_ws("|", F.size("v").cast("string"), F.col("n").cast("string")).alias("shard"), F.lit(1).alias("kind"),
        F.lit(0).alias("point"), "v", F.array("id").alias("ids"), F.array("row").alias("rows"), none.alias("edges"))
    met = graphs.unionByName(asked).repartition(n_shards, "shard").sortWithinPartitions("shard", "kind", "point")
    return met.mapInArrow(run, "query_row long, query_id long, vec_id long, row long, score double")


def nearest_neighbours(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = K,
                       beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of each row that ``is_query`` selects by its ``id``."""
    rows = usable(vectors, key, vector)
    n_shards = shards_of(rows.count())
    graphs = build_graphs(rows, n_shards, k)
    found = search_graphs(graphs, rows.where(is_query), n_shards, k, beam)
    # at most k rows a shard and query
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy("score", "vec_id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("vec_id") != int(NULL_ID), F.col("vec_id")).alias("vec_id"), "score")


def op13_pruned_graph_search(spark, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id and score of the ten nearest of every hundredth vector."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
