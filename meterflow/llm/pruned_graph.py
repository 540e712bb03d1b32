"""Nearest neighbours by inner product over robust-pruned directed graphs, one per shard.

Spark deals the different vectors out to shards of bounded size. Each shard's graph is
built in one task by batches of greedy searches, whose visited nodes are pruned to diverse
edges, and written as rows of the index. Queries then stream past every shard: a beam search in
each, and one ranking over what all of them found.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.common import written
from meterflow.llm.vectors import as_vector, common_length, is_finite, matrix

NEIGHBOURS = 20
# A shard's vectors, and queries that meet a shard in one task, at most about so many.
SHARD_ROWS = 10_000
QUERY_ROWS = 50_000
# Edges of a node, nodes in the beam while building and while searching.
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
# An edge is left out if a kept one ends this much nearer to its end.
RELAXED = 1.2
# Nodes a beam follows at a time, queries that walk side by side, nodes added at a time.
FOLLOWED = 4
SIDE_BY_SIDE = 256


# --------------------------------------------------------------------------
# one shard's graph


def _walk(
    points: np.ndarray, squares: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, width: int, seen_all: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Beam searches side by side: the nodes nearest to each query and their distances, nearest first.

    Distances are squared, less the square of the query. With ``seen_all`` the nodes
    are those followed on the way instead, as candidates for edges; -1 fills up.
    """
    m, degree = len(queries), edges.shape[1]
    rows = np.arange(m)
    seen = np.zeros((m, len(points)), dtype=bool)
    seen[:, start] = True
    beam = np.full((m, width), -1, dtype=np.int32)
    far = np.full((m, width), np.inf, dtype=np.float32)
    followed = np.ones((m, width), dtype=bool)
    beam[:, 0], followed[:, 0] = start, False
    far[:, 0] = squares[start] - 2 * (queries @ points[start])
    trail, trail_far = [], []
    at_once = 1
    while True:
        open_far = np.where(followed, np.inf, far)
        live = np.nonzero(np.isfinite(open_far).any(axis=1))[0]
        if not len(live):
            break
        some = open_far[live]
        picks = np.argpartition(some, at_once - 1, axis=1)[:, :at_once] if at_once < width else np.argsort(some, axis=1)
        real = np.isfinite(np.take_along_axis(some, picks, 1))
        r = live[:, None]
        nodes = np.where(real, beam[r, picks], -1)
        followed[r, picks] |= real
        if seen_all:
            spread, spread_far = np.full((m, picks.shape[1]), -1, np.int32), np.full((m, picks.shape[1]), np.inf, np.float32)
            spread[live], spread_far[live] = nodes, np.where(real, far[r, picks], np.inf)
            trail.append(spread)
            trail_far.append(spread_far)
        next_nodes = np.empty((len(live), nodes.shape[1] * degree), dtype=np.int32)
        fresh = np.empty(next_nodes.shape, dtype=bool)
        for k in range(nodes.shape[1]):
            part = np.where(nodes[:, k, None] >= 0, edges[nodes[:, k]], -1)
            new = (part >= 0) & ~seen[r, part]
            i, j = np.nonzero(new)
            seen[live[i], part[i, j]] = True
            next_nodes[:, k * degree : (k + 1) * degree] = part
            fresh[:, k * degree : (k + 1) * degree] = new
        i, j = np.nonzero(fresh)
        reached = next_nodes[i, j]
        distance = np.full(fresh.shape, np.inf, dtype=np.float32)
        distance[i, j] = squares[reached] - 2 * np.einsum("nd,nd->n", points[reached], queries[live[i]])
        all_nodes = np.concatenate([beam[live], next_nodes], axis=1)
        all_far = np.concatenate([far[live], distance], axis=1)
        all_followed = np.concatenate([followed[live], ~fresh], axis=1)
        kept = np.argpartition(all_far, width - 1, axis=1)[:, :width]
        beam[live] = np.take_along_axis(all_nodes, kept, 1)
        far[live] = np.take_along_axis(all_far, kept, 1)
        followed[live] = np.take_along_axis(all_followed, kept, 1)
        at_once = FOLLOWED
    if seen_all:
        beam, far = np.concatenate(trail, axis=1), np.concatenate(trail_far, axis=1)
    order = np.argsort(far, axis=1, kind="stable")
    far = np.take_along_axis(far, order, 1)
    beam = np.where(np.isfinite(far), np.take_along_axis(beam, order, 1), -1)
    return beam, far


def _pruned(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, relaxed: float) -> np.ndarray:
    """Diverse edges of the nodes ``own``: the nearest candidate is kept, those much nearer to it than to the node go.

    ``candidates`` are different nodes per row other than the node, -1 fills up.
    """
    m, width = candidates.shape
    there = candidates >= 0
    c = points[candidates]
    near = ((c - points[own][:, None, :]) ** 2).sum(axis=2)
    near[~there] = np.inf
    squares = (c * c).sum(axis=2)
    between = squares[:, :, None] + squares[:, None, :] - 2 * (c @ c.transpose(0, 2, 1))
    rows, edges = np.arange(m), np.full((m, degree), -1, dtype=np.int32)
    for k in range(degree):
        best = near.argmin(axis=1)
        found = np.isfinite(near[rows, best])
        if not found.any():
            break
        edges[:, k] = np.where(found, candidates[rows, best], -1)
        # Squared distances: the factor is squared too.
        near[relaxed**2 * between[rows, best] <= near] = np.inf
        near[rows, best] = np.inf
    return edges


def _without_repeats(own: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Rows of nodes sorted, with repeats and the row's own node as -1."""
    nodes = np.sort(nodes, axis=1)[:, ::-1].copy()
    nodes[:, 1:][nodes[:, 1:] == nodes[:, :-1]] = -1
    nodes[nodes == own[:, None]] = -1
    return nodes


def _add_backward(points: np.ndarray, edges: np.ndarray, sources: np.ndarray, relaxed: float) -> None:
    """Give every end of the sources' edges an edge back, pruned where it has too many."""
    degree = edges.shape[1]
    ends = edges[sources]
    back_to, back_from = ends.ravel(), np.repeat(sources, degree)
    back_to, back_from = back_to[back_to >= 0], back_from[back_to >= 0]
    order = np.argsort(back_to, kind="stable")
    back_to, back_from = back_to[order], back_from[order]
    nodes, first, counts = np.unique(back_to, return_index=True, return_counts=True)
    # Nodes with many edges to take get them in turns, so that a turn's candidates stay few.
    for turn in range(0, int(counts.max(initial=0)), degree):
        here = counts > turn
        own, begin, n = nodes[here], first[here] + turn, np.minimum(counts[here] - turn, degree)
        grid = begin[:, None] + np.arange(degree)
        new = np.where(np.arange(degree) < n[:, None], back_from[np.minimum(grid, len(back_from) - 1)], -1)
        both = _without_repeats(own, np.concatenate([edges[own], new.astype(np.int32)], axis=1))
        size = (both >= 0).sum(axis=1)
        few = size <= degree
        edges[own[few]] = np.sort(both[few], axis=1)[:, ::-1][:, :degree]
        for at in range(0, int((~few).sum()), SIDE_BY_SIDE):
            part = np.nonzero(~few)[0][at : at + SIDE_BY_SIDE]
            edges[own[part]] = _pruned(points, own[part], both[part], degree, relaxed)


def _reached(edges: np.ndarray, start: int) -> np.ndarray:
    seen = np.zeros(len(edges), dtype=bool)
    seen[start] = True
    front = np.array([start])
    while len(front):
        ends = np.unique(edges[front])
        front = ends[(ends >= 0)]
        front = front[~seen[front]]
        seen[front] = True
    return seen


def build_graph(
    points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relaxed: float = RELAXED
) -> tuple[np.ndarray, int]:
    """Edges of each point, -1 where it has fewer, and the node that searches start from.

    Points are added in batches that grow with the graph. Every node can be reached from
    the start: one that can't gets an edge from the nearest node found that has a place free, or
    else from the nearest one in a further column.
    """
    n = len(points)
    squares = (points * points).sum(axis=1)
    start = int((squares - 2 * (points @ points.mean(axis=0))).argmin())
    edges = np.full((n, degree), -1, dtype=np.int32)
    order = np.random.default_rng(n).permutation(n)
    order = order[order != start]
    done = 0
    while done < len(order):
        batch = order[done : done + min(SIDE_BY_SIDE, max(1, done))]
        trail, _ = _walk(points, squares, edges, start, points[batch], beam, True)
        edges[batch] = _pruned(points, batch, _without_repeats(batch, trail), degree, relaxed)
        _add_backward(points, edges, batch, relaxed)
        done += len(batch)
    while not (seen := _reached(edges, start)).all():
        lost = np.nonzero(~seen)[0][:SIDE_BY_SIDE]
        next_to = _walk(points, squares, edges, start, points[lost], beam, False)[0]
        for node, near in zip(lost, next_to):
            near = near[near >= 0]
            i, j = np.nonzero(edges[near] < 0)
            if not len(i):
                edges = np.concatenate([edges, np.full((n, 1), -1, dtype=np.int32)], axis=1)
                i, j = [0], [edges.shape[1] - 1]
            edges[near[i[0]], j[0]] = node
    return edges, start


# --------------------------------------------------------------------------
# the index and its use


def _shard(value: Column, rows: int, most: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(max(1, -(-rows // most)))).cast("int")


def _vectors(table: DataFrame, column: str, key: str) -> DataFrame:
    found = table.select(F.col(f"`{key}`").cast("long").alias("id"), as_vector(column).alias("v"))
    found = found.filter(F.col("id").isNotNull() & is_finite(F.col("v")) & F.exists("v", lambda c: c != 0))
    # 0.0 and -0.0 are one number.
    return found.select("id", F.transform("v", lambda c: c + F.lit(0.0)).alias("v"))


def build_index(
    table: DataFrame,
    column: str = "embedding",
    key: str = "vec_id",
    neighbours: int = NEIGHBOURS,
    shard_rows: int = SHARD_ROWS,
    degree: int = DEGREE,
    beam: int = BUILD_BEAM,
    relaxed: float = RELAXED,
) -> DataFrame:
    """The written index: ``shard``, ``node``, ``v``, ``ids``, ``edges``, ``start`` of every different vector.

    ``ids`` are the smallest ids that hold the vector, one more than ``neighbours``: equal vectors
    are equally near to any query and ties go to smaller ids, so no other row with the vector
    can be among a query's nearest. Every usable row is indexed: see :func:`search` for those
    that are not usable. Inner products are made distances by one more dimension, which
    gives all vectors the length of the longest.
    """
    rows = _vectors(table, column, key)
    length = common_length(rows, "v")
    rows = rows.filter(F.size("v") == length)
    # A row for each id and vector; of the ids with one vector the smallest.
    place = Window.partitionBy("v").orderBy("id")
    few = rows.dropDuplicates(["id", "v"]).withColumn("place", F.row_number().over(place)).filter(
        F.col("place") <= neighbours + 1
    )
    few = written(few, "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    different, longest = few.filter("place = 1").agg(F.count("*"), F.max(square)).first()
    grouped = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    sharded = grouped.withColumn("shard", _shard(F.col("v"), different, shard_rows))

    def build(shard: pa.Table) -> pa.Table:
        vectors = matrix(shard.column("v").combine_chunks(), length)
        # Equal input in any order gives an equal graph.
        order = np.lexsort(vectors.T[::-1])
        vectors, shard = vectors[order], shard.take(pa.array(order))
        beyond = np.sqrt(np.maximum(longest - (vectors * vectors).sum(axis=1), 0))
        points = np.concatenate([vectors, beyond[:, None]], axis=1)
        scale = max(np.sqrt(longest), np.finfo(float).tiny)
        edges, start = build_graph((points / scale).astype(np.float32), degree, beam, relaxed)
        n = len(vectors)
        return pa.table(
            {
                "shard": shard.column("shard").cast(pa.int32()),
                "node": pa.array(np.arange(n, dtype=np.int32)),
                "v": shard.column("v").cast(pa.list_(pa.float64())),
                "ids": shard.column("ids").cast(pa.list_(pa.int64())),
                "edges": pa.array([e[e >= 0] for e in edges], pa.list_(pa.int32())),
                "start": pa.array(np.full(n, start, dtype=np.int32)),
            }
        )

    schema = "shard int, node int, v array<double>, ids array<bigint>, edges array<int>, start int"
    return written(sharded.groupBy("shard").applyInArrow(build, schema), "graph")


def search(
    index: DataFrame,
    queries: DataFrame,
    column: str = "embedding",
    key: str = "vec_id",
    neighbours: int = NEIGHBOURS,
    beam: int = SEARCH_BEAM,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the rows found nearest to each query, its own id left out.

    ``score`` is the inner product of the given vectors in doubles; larger is nearer, ties go to the
    smaller id. The index must keep at least as many ``neighbours``. Rows whose id or vector is null,
    and vectors that are empty, all zero, hold null or non-finite entries or have not the length
    most vectors have, take no part on either side. Rows that repeat id and vector count once; an
    id that holds several vectors is ranked once for each as a query. Queries against an
    empty index, and no queries, give no rows.
    """
    spark = index.sparkSession
    first = index.select(F.size("v").alias("length")).first()
    length = first["length"] if first else 0
    asked = _vectors(queries, column, key).filter(F.size("v") == length).dropDuplicates(["id", "v"])
    # The number stands for id and vector, so that what is found needn't carry the vector.
    asked = written(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    n_queries, shards = asked.count(), (index.agg(F.max("shard")).first()[0] or 0) + 1
    blocks = max(1, -(-n_queries // query_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = asked.withColumn("block", _shard(F.struct("id", "v"), n_queries, query_rows))
    asked = asked.withColumn("shard", every(shards))
    met = index.withColumn("block", every(blocks)).unionByName(asked, allowMissingColumns=True)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards * blocks)
    # A shard's nodes in order, then the queries that meet it.
    met = met.repartition(n, "shard", "block").sortWithinPartitions("shard", "block", F.col("node").asc_nulls_last())

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keeps one shard's graph; queries go through as they come."""
        place, nodes, graph = None, [], None
        for batch in batches:
            for here, is_node, rows in _stretches(batch):
                if here != place:
                    place, nodes, graph = here, [], None
                if is_node:
                    nodes.append(rows)
                    continue
                if nodes:
                    graph, nodes = _Graph(pa.Table.from_batches(nodes), length), []
                if graph is not None:
                    yield from graph.nearest(rows, beam, neighbours)

    found = met.mapInArrow(look_up, "query long, id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", place).filter(F.col("rank") <= neighbours)
    return ranked.select(F.col("id").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], bool, pa.RecordBatch]]:
    """Shard and block, whether they are nodes, and rows: the parts of a sorted batch that are alike in these."""
    shard, block = (batch.column(c).to_numpy() for c in ("shard", "block"))
    is_node = batch.column("node").is_valid().to_numpy(zero_copy_only=False)
    other = (shard[1:] != shard[:-1]) | (block[1:] != block[:-1]) | (is_node[1:] != is_node[:-1])
    bounds = [0, *(np.nonzero(other)[0] + 1).tolist(), batch.num_rows]
    for begin, end in zip(bounds, bounds[1:]):
        if end > begin:
            yield (int(shard[begin]), int(block[begin])), bool(is_node[begin]), batch.slice(begin, end - begin)


class _Graph:
    """One shard's graph, from its rows in the order of the nodes."""

    def __init__(self, rows: pa.Table, length: int) -> None:
        self.vectors = matrix(rows.column("v").combine_chunks(), length)
        lists = rows.column("edges").combine_chunks()
        counts = np.diff(lists.offsets.to_numpy())
        self.edges = np.full((len(self.vectors), max(1, counts.max())), -1, dtype=np.int32)
        self.edges[np.arange(self.edges.shape[1]) < counts[:, None]] = lists.flatten().to_numpy()
        ids = rows.column("ids").combine_chunks()
        self.bounds, self.ids = ids.offsets.to_numpy() - ids.offsets[0].as_py(), ids.flatten().to_numpy()
        self.start = rows.column("start")[0].as_py()
        self.length = length

    def nearest(self, block: pa.RecordBatch, beam: int, neighbours: int) -> Iterator[pa.RecordBatch]:
        """Query's number and id, id found and score, in batches of few queries."""
        queries, query_ids = block.column("query").to_numpy(), block.column("id").to_numpy()
        asked = matrix(block.column("v"), self.length)
        for q, node, score in _results(self.vectors, self.edges, self.start, asked, beam, neighbours):
            first = self.bounds[:-1][node]
            n = self.bounds[1:][node] - first
            # Every id of the vectors found.
            flat = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
            q, score, found = np.repeat(q, n), np.repeat(score, n), self.ids[flat]
            own = query_ids[q] == found
            q, score, found = q[~own], score[~own], found[~own]
            order = np.lexsort((found, -score, q))
            q, score, found = q[order], score[order], found[order]
            kept = np.arange(len(q)) - np.searchsorted(q, q) < neighbours
            q, score, found = q[kept], score[kept], found[kept]
            columns = [queries[q], query_ids[q], found, score]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "id", "vec_id", "score"])


def _results(
    vectors: np.ndarray, edges: np.ndarray, start: int, asked: np.ndarray, beam: int, neighbours: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query, node and exact score of the nearest nodes found, ``neighbours`` and one per query."""
    scale = np.abs(vectors).max()
    points = (vectors / scale).astype(np.float32)
    none = np.zeros(len(points), dtype=np.float32)
    for at in range(0, len(asked), SIDE_BY_SIDE):
        part = asked[at : at + SIDE_BY_SIDE]
        sizes = np.abs(part).max(axis=1, keepdims=True)
        # Without squares the distance is the inner product alone, turned round.
        nodes, _ = _walk(points, none, edges, start, (part / sizes).astype(np.float32), max(beam, neighbours + 1), False)
        i, j = np.nonzero(nodes >= 0)
        node = nodes[i, j]
        score = np.einsum("nd,nd->n", vectors[node], part[i])
        order = np.lexsort((node, -score, i))
        i, node, score = i[order], node[order], score[order]
        kept = np.arange(len(i)) - np.searchsorted(i, i) <= neighbours
        yield i[kept] + at, node[kept], score[kept]


def nearest(
    table: DataFrame, queries: DataFrame, column: str = "embedding", key: str = "vec_id", neighbours: int = NEIGHBOURS, **build: float
) -> DataFrame:
    """The rows of ``table`` nearest to each row of ``queries``, by :func:`build_index` and :func:`search`."""
    return search(build_index(table, column, key, neighbours, **build), queries, column, key, neighbours)
