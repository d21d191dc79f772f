"""Exact top-k search by inner product on a bit-sliced index.

*Index.*  In a shard every component is an attribute of ``bits`` bits: its
distance from the shard's smallest value in steps of a ``2 ** bits``-th of the
range.  Slice (j, i) is the bitmap of the rows whose attribute j has bit i.

*Sum.*  A query's component, times the attribute's step, is the attribute's
weight, quantised to ``weight_bits`` bits; where it is negative the complement
of the slices is added.  All bitmaps that count 2**p are added by carry-save
adders, three to a sum and a carry, so the rows' approximate scores come out as
slices again, without a number for any row.

*Selection.*  From the most significant slice downward a bitmap of rows still
equal to the k-th best and one of better rows give the k-th largest sum; a
comparison with that sum less the greatest possible rounding error gives the
bitmap of the rows that may be among the best.  Only these boundary rows are
scored exactly, as 64-bit integers, and ranked; ties go to the smaller id.

The k best of all shards are merged by a window.  Rounding is bounded, not
estimated, so results are exact whatever the values; values of very uneven
size only make more boundary rows.

Defined results: see :mod:`tidewater.llm.vector_shards`; an id is no candidate
of its own; with fewer than k candidates all are returned; an empty table gives
no rows; a score beyond a long's range is the end of the range, and ranks so.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.vector_shards import LONG_MAX, Shard, beside_shards, build_shards, integers, matrix, one_row_an_id, scores, search_shards


@dataclass(frozen=True)
class SliceRule:
    shard_rows: int = 1 << 16
    bits: int = 6
    weight_bits: int = 8


def add_up(columns: dict[int, list[np.ndarray]]) -> list[np.ndarray | None]:
    """Slices of the sum, least significant first, of bitmaps that count 2**p each, listed by p; None is an empty slice."""
    out: list[np.ndarray | None] = []
    p = 0
    while p <= max(columns, default=-1):
        here = columns.pop(p, [])
        while sum(map(len, here)) > 1:
            pool = np.concatenate(here)
            n = len(pool) // 3
            if n:  # three bitmaps make a sum and a carry
                a, b, c = pool[:n], pool[n : 2 * n], pool[2 * n : 3 * n]
                half = a ^ b
                columns.setdefault(p + 1, []).append((a & b) | (half & c))
                here = [half ^ c, pool[3 * n :]]
            else:
                columns.setdefault(p + 1, []).append(pool[:1] & pool[1:2])
                here = [pool[:1] ^ pool[1:2]]
        here = [h for h in here if len(h)]
        out.append(here[0][0] if here else None)
        p += 1
    return out


def largest(slices: list[np.ndarray | None], alive: np.ndarray, k: int) -> int:
    """The k-th largest sum among the rows in ``alive``, of which there are k at least."""
    better, equal, value = np.zeros_like(alive), alive, 0
    for p in range(len(slices) - 1, -1, -1):
        ones = equal & slices[p] if slices[p] is not None else np.zeros_like(alive)
        if int(np.bitwise_count(better | ones).sum()) >= k:
            equal, value = ones, value | 1 << p
        else:
            better, equal = better | ones, equal ^ ones
    return value


def at_least(slices: list[np.ndarray | None], alive: np.ndarray, value: int) -> np.ndarray:
    """The bitmap of the rows in ``alive`` whose sum is ``value`` or more."""
    if value <= 0:
        return alive
    if value >> len(slices):
        return np.zeros_like(alive)
    more, equal = np.zeros_like(alive), alive
    for p in range(len(slices) - 1, -1, -1):
        ones = equal & slices[p] if slices[p] is not None else np.zeros_like(alive)
        if value >> p & 1:
            equal = ones
        else:
            more, equal = more | ones, equal ^ ones
    return more | equal


def bitmap(flags: np.ndarray, words: int) -> np.ndarray:
    packed = np.packbits(flags, axis=-1, bitorder="little")
    room = np.zeros((*flags.shape[:-1], words * 8), np.uint8)
    room[..., : packed.shape[-1]] = packed
    return room.view(np.uint64)


class SlicedShard:
    """The slices of a shard and its exact vectors."""

    def __init__(self, shard: Shard, rule: SliceRule) -> None:
        self.shard, self.rule = shard, rule
        x = shard.vectors
        # a power of two brings the values below 1, so that no sum overflows
        self.exponent = int(np.frexp(np.abs(x).max())[1])
        small = np.ldexp(x, -self.exponent)
        self.low = small.min(axis=0)
        self.top = (1 << rule.bits) - 1
        self.step = np.maximum((small.max(axis=0) - self.low) / self.top, 1e-300)
        level = np.minimum(np.floor((small - self.low) / self.step), self.top).astype(np.int64)
        self.words = -(-len(x) // 64)
        self.all = bitmap(np.ones(len(x), bool), self.words)
        # (dim, bit, words)
        self.slices = np.stack([bitmap((level >> i & 1).T.astype(bool), self.words) for i in range(rule.bits)], axis=1)

    def boundary(self, query: np.ndarray, alive: np.ndarray, k: int) -> np.ndarray:
        """Places of the rows in ``alive`` that can be among its k best."""
        if int(np.bitwise_count(alive).sum()) <= k:
            return self.places(alive)
        scale = int(np.frexp(np.abs(query).max(initial=0))[1])
        q = np.ldexp(query, -scale)
        weight = np.abs(q) * self.step
        if not weight.max() > 0:
            return self.places(alive)
        unit = weight.max() / ((1 << self.rule.weight_bits) - 1)
        whole = np.floor(weight / unit).astype(np.int64)
        columns: dict[int, list[np.ndarray]] = {}
        flip = np.where(q < 0, ~np.uint64(0), np.uint64(0))
        for bit in range(self.rule.weight_bits):
            some = np.flatnonzero(whole >> bit & 1)
            if len(some):
                added = self.slices[some] ^ flip[some, None, None]
                for i in range(self.rule.bits):
                    columns.setdefault(bit + i, []).append(added[:, i])
        sums = add_up(columns)
        kth = largest(sums, alive, k)
        # score - constant lies in [unit * sum - below, unit * sum + above]
        below = float(weight[q < 0].sum())
        above = float(weight[q > 0].sum()) + self.top * float((weight - unit * whole).sum())
        slack = 1e-9 * (float(np.abs(q).sum()) + unit * (kth + 1))  # rounding of these doubles
        least = unit * kth - below - above - 2 * slack
        constant = float((q * self.low).sum()) - self.top * float(weight[q < 0].sum())
        end = math.ldexp(float(LONG_MAX), -max(-900, self.exponent + scale))  # scores from here on are equal
        if least + constant <= -end:
            return self.places(alive)
        saturated = end - constant - above - 2 * slack
        return self.places(at_least(sums, alive, math.floor(min(least, saturated) / unit)))

    def places(self, rows: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(rows.view(np.uint8), bitorder="little"))

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows but the query's own."""
        alive = self.all
        own = int(np.searchsorted(self.shard.ids, query_id))
        if own < len(self.shard.ids) and self.shard.ids[own] == query_id:
            alive = alive.copy()
            alive[own >> 6] &= ~(np.uint64(1) << np.uint64(own & 63))
        rows = self.boundary(query, alive, k)
        found = scores(self.shard.vectors[rows], query[None, :])[:, 0]
        if len(found) > k:
            keep = found >= np.partition(found, len(found) - k)[len(found) - k]
            rows, found = rows[keep], found[keep]
        order = np.lexsort((self.shard.ids[rows], ~found))[:k]
        return self.shard.ids[rows[order]], found[order]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, rule: SliceRule = SliceRule()) -> DataFrame:
    """(query_id, rank, id, score): the k rows of ``vectors`` with the largest inner products, for each row of ``queries``.

    Both are rows of :func:`tidewater.llm.vector_shards.vector_rows`.
    """
    index, shards = build_shards(vectors, rule.shard_rows, "slices")
    wanted = one_row_an_id(queries).select(F.col("id").alias("query_id"), F.col("vector").alias("query"), "dim")

    def search(shard: SlicedShard, rows: pa.Table) -> pa.Table:
        ids, q = rows["query_id"].to_numpy(), integers(matrix(rows["query"]))
        found = [shard.best(int(i), v, k) for i, v in zip(ids, q, strict=True)]
        return pa.table(
            {
                "query_id": np.repeat(ids, [len(f[0]) for f in found]),
                "id": np.concatenate([f[0] for f in found]),
                "score": np.concatenate([f[1] for f in found]),
            }
        )

    beside = beside_shards(index, shards, wanted, ["query_id"])
    found = search_shards(beside, lambda row: SlicedShard(Shard.of(row), rule), search, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
