"""Approximate nearest neighbours on robust-pruned directed graphs, one for each shard.

*Build.*  Vectors are dealt to shards of about ``shard_rows`` by hash.  In a
shard each vector is searched greedily in the graph so far; the nodes that the
search expands are its possible neighbours.  Pruning keeps the nearest one,
drops those that are closer to it than to the vector by the factor ``alpha``,
and goes on with the rest, so long and short edges in different directions
remain.  Edges are added both ways and pruned again where a node has too many.

*Search.*  A task loads one shard's graph and streams the queries past it, in
batches; a beam search finds what is near, and exact distances in double
precision rank what the beams hold.

The graph is built and searched in single precision on vectors less their
shard's mean, divided by the largest component, and distances are sums of squared
differences: neither a common offset nor the size of the values costs accuracy.
The scores are computed in double precision from the vectors as they are.

Equal vectors are one node.  Of a node's rows only the ``k + 1`` smallest ids
can be among a query's k nearest, so no more are listed.

Defined results: vectors that are null, empty, zero, or hold a null or
non-finite component take no part, nor do rows with a null id; only vectors of
one length are compared with each other; rows that repeat id and vector count
once, rows that repeat an id with another vector are further candidates; ties
in distance go to the smaller id; with fewer than k candidates all are
returned; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import scratch_folder
from tidewater.llm.vector_shards import beside_shards, matrix, search_shards


@dataclass(frozen=True)
class GraphRule:
    shard_rows: int = 20_000
    degree: int = 32
    beam: int = 80
    alpha: float = 1.2
    batch: int = 128
    query_rows: int = 256

    @property
    def room(self) -> int:
        """Edges that a node may have before it is pruned to ``degree``; only while the graph is built."""
        return self.degree * 3 // 2


# ------------------------------------------------------------ one shard


@dataclass(frozen=True)
class Frame:
    """Where a shard's vectors lie: the power of two, the mean and the size that are taken out of them."""

    exponent: int
    mean: np.ndarray
    size: float

    @classmethod
    def of(cls, x: np.ndarray) -> Frame:
        exponent = int(np.frexp(np.abs(x).max())[1])
        small = np.ldexp(x, -exponent)
        mean = small.mean(axis=0)
        return cls(exponent, mean, float(np.abs(small - mean).max()) or 1.0)

    def inside(self, x: np.ndarray) -> np.ndarray:
        """The vectors in single precision; those far outside the shard at its horizon."""
        with np.errstate(over="ignore"):
            return np.clip((np.ldexp(x, -self.exponent) - self.mean) / self.size, -1e15, 1e15).astype(np.float32)


def exact_distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of x (b, r, d) to q (b, d); powers of two keep squares within range."""
    most = np.maximum(np.abs(x).max(axis=(1, 2), initial=0), np.abs(q).max(axis=1))
    exponent = np.frexp(most)[1]
    apart = np.ldexp(x, -exponent[:, None, None]) - np.ldexp(q, -exponent[:, None])[:, None, :]
    return np.ldexp(np.sqrt((apart**2).sum(axis=2)), exponent[:, None])


def squared(x: np.ndarray, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of x[ids] (b, r) to q (b, d)."""
    apart = x[ids] - q[:, None, :]
    return np.einsum("brd,brd->br", apart, apart)


def beam_search(
    x: np.ndarray, edges: np.ndarray, entry: int, q: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, distances, expanded ids) for each query: the beam at the end, and the nodes that were expanded; -1 pads."""
    rows, n = len(q), len(x)
    ids = np.full((rows, beam), -1)
    far = np.full((rows, beam), np.inf, np.float32)
    done = np.zeros((rows, beam), bool)
    seen = np.zeros((rows, n), bool)
    ids[:, 0], seen[:, entry] = entry, True
    far[:, 0] = squared(x, np.full((rows, 1), entry), q)[:, 0]
    expanded = []
    active = np.arange(rows)
    while len(active):
        open_ = np.where(done[active], np.inf, far[active])
        pick = open_.argmin(axis=1)
        go = np.isfinite(open_[np.arange(len(active)), pick])
        active, pick = active[go], pick[go]
        if not len(active):
            break
        done[active, pick] = True
        node = ids[active, pick]
        column = np.full(rows, -1)
        column[active] = node
        expanded.append(column)
        near = edges[node]
        new = (near >= 0) & ~seen[active[:, None], near]
        seen[active[:, None], near] |= near >= 0
        d = np.full(near.shape, np.inf, np.float32)
        row, slot = np.nonzero(new)
        apart = x[near[row, slot]] - q[active[row]]
        d[row, slot] = np.einsum("nd,nd->n", apart, apart)
        all_d = np.concatenate([far[active], d], axis=1)
        best = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        take = np.arange(len(active))[:, None]
        ids[active] = np.concatenate([ids[active], near], axis=1)[take, best]
        done[active] = np.concatenate([done[active], np.zeros_like(new)], axis=1)[take, best]
        far[active] = all_d[take, best]
    ids[~np.isfinite(far)] = -1
    return ids, far, np.stack(expanded, axis=1) if expanded else np.zeros((rows, 0), int)


def robust_prune(x: np.ndarray, node: np.ndarray, options: np.ndarray, rule: GraphRule) -> np.ndarray:
    """The kept neighbours (b, degree) of each node among its options (b, c); -1 pads."""
    options = np.sort(options, axis=1)
    bad = (options < 0) | (options == node[:, None])
    bad[:, 1:] |= options[:, 1:] == options[:, :-1]
    v = x[options] - x[node][:, None, :]  # seen from the node, so that close neighbours stay apart
    d = np.where(bad, np.inf, np.einsum("brd,brd->br", v, v))
    order = np.argsort(d, axis=1, kind="stable")
    take = np.arange(len(node))
    options, d, v = options[take[:, None], order], d[take[:, None], order], v[take[:, None], order]
    norms = np.einsum("brd,brd->br", v, v)
    between = norms[:, :, None] + norms[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
    alive = np.isfinite(d)
    kept = np.full((len(node), rule.degree), -1)
    for slot in range(rule.degree):
        pick = alive.argmax(axis=1)
        some = alive[take, pick]
        if not some.any():
            break
        kept[some, slot] = options[some, pick[some]]
        alive &= rule.alpha**2 * between[take, pick] > d
        alive[take, pick] = False
        alive[~some] = False
    return kept


def in_batches(rows: np.ndarray, size: int) -> list[np.ndarray]:
    return [rows[at : at + size] for at in range(0, len(rows), size)]


def build_graph(x: np.ndarray, rule: GraphRule) -> tuple[np.ndarray, int]:
    """(edges, entry) of a shard's vectors; -1 pads."""
    n = len(x)
    edges = np.full((n, rule.room), -1)
    entry = int(squared(x, np.arange(n)[None, :], x.mean(axis=0)[None, :])[0].argmin())
    if n == 1:
        return edges[:, : rule.degree], entry
    rng = np.random.default_rng(7)
    edges[:, : rule.degree // 2] = rng.integers(0, n, (n, rule.degree // 2))
    edges[:, 0] = np.roll(np.arange(n), 1)  # a ring: every node can be reached
    for node in in_batches(rng.permutation(n), rule.batch):
        ids, _, expanded = beam_search(x, edges, entry, x[node], rule.beam)
        kept = robust_prune(x, node, np.concatenate([expanded, ids[:, : rule.degree], edges[node]], axis=1), rule)
        edges[node] = -1
        edges[node, : rule.degree] = kept
        source, slot = np.nonzero(kept >= 0)
        add_back(x, edges, kept[source, slot], node[source], rule)
    for node in in_batches(np.flatnonzero((edges >= 0).sum(axis=1) > rule.degree), rule.batch):
        kept = robust_prune(x, node, edges[node], rule)
        edges[node] = -1
        edges[node, : rule.degree] = kept
    return -np.sort(-edges, axis=1)[:, : rule.degree], entry


def add_back(x: np.ndarray, edges: np.ndarray, target: np.ndarray, source: np.ndarray, rule: GraphRule) -> None:
    """Add edges target -> source; nodes that have no room for theirs are pruned."""
    if not len(target):
        return
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    node, first, count = np.unique(target, return_index=True, return_counts=True)
    # nodes that gain many edges get them in several rounds, which keeps the option table narrow
    width = rule.degree
    for done in range(0, int(count.max()), width):
        some = count > done
        options = np.full((some.sum(), width), -1)
        n = np.minimum(count[some] - done, width)
        row = np.repeat(np.arange(len(n)), n)
        column = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        options[row, column] = source[(first[some] + done)[row] + column]
        mine = node[some]
        joined = -np.sort(-np.concatenate([edges[mine], options], axis=1), axis=1)
        joined[:, 1:][joined[:, 1:] == joined[:, :-1]] = -1
        fits = (joined >= 0).sum(axis=1) <= rule.room
        for rows in in_batches(np.flatnonzero(~fits), rule.batch):
            kept = robust_prune(x, mine[rows], joined[rows], rule)
            edges[mine[rows]] = -1
            edges[mine[rows], : rule.degree] = kept
        edges[mine[fits]] = -np.sort(-joined[fits], axis=1)[:, : rule.room]


# ----------------------------------------------------------------- on Spark


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def nodes(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(node, id, vector, dim): usable rows with the 64-bit hash of their vector."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
    return rows.select(F.xxhash64("vector").alias("node"), "id", "vector", F.size("vector").alias("dim"))


def build_index(rows: DataFrame, rule: GraphRule) -> tuple[DataFrame, int]:
    """(dim, shard, nodes, vectors, edges, entry) with one row a shard, and the number of shards of a length."""
    distinct = rows.groupBy("node", "dim").agg(F.first("vector").alias("vector"))
    shards = max(1, math.ceil(distinct.count() / rule.shard_rows))
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int"))
    # a shard is few bytes and much work: a task each, not merged by size
    dealt = dealt.repartition(shards, "dim", "shard")

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        x = matrix(group["vector"])
        edges, entry = build_graph(Frame.of(x).inside(x), rule)
        return pa.table(
            {
                "dim": group["dim"].slice(0, 1),
                "shard": group["shard"].slice(0, 1),
                "nodes": pa.array([group["node"].to_numpy().tobytes()], pa.binary()),
                "vectors": pa.array([x.tobytes()], pa.binary()),
                "edges": pa.array([edges.astype(np.int32).tobytes()], pa.binary()),
                "entry": pa.array([entry], pa.int32()),
            }
        )

    schema = "dim int, shard int, nodes binary, vectors binary, edges binary, entry int"
    return dealt.groupBy("dim", "shard").applyInArrow(build, schema), shards


class GraphShard:
    """A shard's graph, loaded once for all queries that stream past it."""

    def __init__(self, row: dict) -> None:
        self.ids = np.frombuffer(row["nodes"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(self.ids), -1)
        self.edges = np.frombuffer(row["edges"], np.int32).reshape(len(self.ids), -1).astype(np.int64)
        self.entry = row["entry"]
        self.frame = Frame.of(self.vectors)
        self.small = self.frame.inside(self.vectors)

    def nearest(self, q: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, distances) of the k nearest nodes found for each query; distance inf pads."""
        found, _, _ = beam_search(self.small, self.edges, self.entry, self.frame.inside(q), beam)
        exact = exact_distances(self.vectors[found], q)
        exact[found < 0] = np.inf
        best = np.argsort(exact, axis=1, kind="stable")[:, :k]
        take = np.arange(len(q))[:, None]
        return found[take, best], exact[take, best]


def search_index(index: DataFrame, shards: int, queries: DataFrame, k: int, rule: GraphRule) -> DataFrame:
    """(query_id, node, score): the k + 1 nearest nodes of each shard."""

    def search(shard: GraphShard, rows: pa.Table) -> pa.Table:
        place, score = shard.nearest(matrix(rows["query"]), k + 1, rule.beam)
        ok = np.isfinite(score)
        ids = np.repeat(rows["query_id"].to_numpy(), place.shape[1]).reshape(place.shape)
        return pa.table({"query_id": ids[ok], "node": shard.ids[place[ok]], "score": score[ok]})

    wanted = queries.select(F.col("id").alias("query_id"), F.col("vector").alias("query"), "dim")
    beside = beside_shards(index, shards, wanted, ["query_id"])
    return search_shards(beside, GraphShard, search, "query_id long, node long, score double", most=rule.query_rows)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, rule: GraphRule = GraphRule(),
    key: str = "vec_id", column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, score): for each row of ``queries`` the k nearest other rows of ``vectors`` found."""
    folder = scratch_folder(vectors.sparkSession, "graph")
    rows = nodes(vectors, key, column)
    index, shards = build_index(rows, rule)
    index.write.parquet(f"{folder}/index")
    index = vectors.sparkSession.read.parquet(f"{folder}/index")
    found = search_index(index, shards, nodes(queries, key, column).distinct(), k, rule)
    first = Window.partitionBy("node").orderBy("id")
    members = rows.select("node", "id").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    pairs = found.join(members, "node").where(F.col("id") != F.col("query_id"))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
