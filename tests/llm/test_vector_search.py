"""Hard negatives and bit-sliced search against brute force by Python integers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidewater.llm import bit_sliced, graph_ann, hard_negatives, queries
from tidewater.llm.vector_shards import LONG_MAX, LONG_MIN, vector_rows

Q = queries.queries()
SCHEMA = "vec_id long, embedding array<double>, label int"


def taking_part(rows, label=lambda i, l: l):
    """{id: (label, integers)}; of a repeated id the smallest (label, vector)."""
    out: dict = {}
    for i, v, l in rows:
        if i is None or not v or l is None or any(x is None or not math.isfinite(256 * x) for x in v):
            continue
        row = (label(i, l), tuple(v))
        out[i] = min(out.get(i, row), row)
    return {i: (l, [math.floor(256 * x) for x in v]) for i, (l, v) in out.items()}


def ranked(rows, i):
    """[(score, id)] of the other rows, best first."""
    q = rows[i][1]
    found = []
    for j, (_, v) in rows.items():
        if j != i and len(v) == len(q):
            found.append((-min(LONG_MAX, max(LONG_MIN, sum(a * b for a, b in zip(q, v)))), j))
    return [(-s, j) for s, j in sorted(found)]


def best(rows, every=50, k=5):
    return sorted((i, n, j, s) for i in rows if i % every == 0 for n, (s, j) in enumerate(ranked(rows, i)[:k], 1))


def negatives(rows, every=100):
    out = []
    for i in rows:
        if i % every:
            continue
        found = ranked(rows, i)
        for p, positive in [x for x in found if rows[x[1]][0] == rows[i][0]][:5]:
            fits = [x for x in found if rows[x[1]][0] != rows[i][0] and 80 * p <= 100 * x[0] <= 100 * p][:5]
            out += [(i, positive, n, j, p, s) for n, (s, j) in enumerate(fits, 1)]
    return sorted(out)


def turned(i, l):
    return (l + 1) % 10 if i % 7 == 0 else l


def awkward(scale=1.0, n=400):
    """Clusters, a hot vector, zero, odd and broken rows, repeated ids."""
    rng = random.Random(3)
    middles = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [scale * (m + rng.gauss(0, 0.3)) for m in middles[i % 5]], rng.randrange(4)) for i in range(n)]
    hot = [scale * x for x in (0.5, -0.25, 0.75, 0.0, -1.0, 0.125)]
    rows += [(n + i, hot, i % 3) for i in range(n // 2)]
    rows += [(5000, [0.0] * 6, 1), (5100, [0.0] * 6, 2), (5200, hot, None), (5300, None, 1), (None, hot, 1), (5400, [], 1)]
    rows += [(5500, [float("nan")] * 6, 1), (5600, [float("inf")] + hot[1:], 1), (5700, [None] + hot[1:], 1)]
    rows += [(5800, [0.5, 0.25], 1), (5801, [0.5, 1.0], 1), (5802, [0.25, 0.75], 2), rows[0], (100, hot, 0), (-100, hot, 3)]
    return rows


@pytest.mark.parametrize("scale", [1.0, 1e-9, 3e6, 1e20, 1e300])
def test_bit_sliced_search_is_exact(spark, scale):
    rows = awkward(scale, 400 if scale == 1 else 120)
    table = vector_rows(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    want = best(taking_part([(i, v, 0) for i, v, _ in rows]))
    for rule in (bit_sliced.SliceRule(), bit_sliced.SliceRule(shard_rows=70, bits=2, weight_bits=3)):
        found = bit_sliced.top_k(table, table.where("id % 50 = 0"), 5, rule)
        assert sorted(map(tuple, found.collect())) == want


@pytest.mark.parametrize("scale", [1.0, 3e6, 1e20])
def test_hard_negatives_are_exact(spark, scale):
    rows = awkward(scale, 400 if scale == 1 else 120)
    table = vector_rows(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", hard_negatives.F.col("label"))
    want = negatives(taking_part(rows))
    assert len(want) > 30
    for rule in (hard_negatives.MiningRule(), hard_negatives.MiningRule(shard_rows=90, members=2, block=16, sample=4)):
        found = hard_negatives.mine(table, table.where("id % 100 = 0"), rule)
        assert sorted(map(tuple, found.collect())) == want


def test_queries_on_the_awkward_table(spark, folder):
    from tables import vectors

    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in vectors()]
    found = Q["op12_bit_sliced"](spark, folder).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, found)) == best(taking_part([(i, v, 0) for i, v, _ in rows]))
    found = Q["op11_hard_negatives"](spark, folder).collect()
    assert sorted(map(tuple, found)) == negatives(taking_part(rows, turned))


def test_walk_ends_before_the_list_does():
    """In clustered data most of a list is never scored, and the result is still the whole one."""
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(40, 16))
    x = np.floor(256 * (np.repeat(middles, 100, axis=0) + 0.02 * rng.normal(size=(4000, 16))))
    shard = hard_negatives.Shard(np.arange(4000), np.arange(4000) % 2, x)
    rule = hard_negatives.MiningRule(block=64)
    members, scored = x[:8], 0

    def counting(a, b, scores=hard_negatives.scores):
        nonlocal scored
        scored += len(a)
        return scores(a, b)

    hard_negatives.scores, real = counting, hard_negatives.scores
    try:
        low, high = np.full(8, LONG_MIN), np.full(8, LONG_MAX)
        who, ids, score = hard_negatives.walk(shard, members, np.arange(8) % 2, np.arange(8), {}, rule, np.arange(8), low, high, True, 5)
    finally:
        hard_negatives.scores = real
    assert scored < 400
    s = (x @ members.T).astype(np.int64)
    for w in range(8):
        others = [j for j in range(4000) if j % 2 == w % 2 and j != w]
        assert sorted(zip(-score[who == w], ids[who == w])) == sorted((-s[j, w], j) for j in others)[:5]


def test_sums_and_selection_of_slices():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 2, (30, 200)).astype(bool)
    weight = rng.integers(0, 4, 30)
    columns = {int(p): [bit_sliced.bitmap(values[weight == p], 4)] for p in np.unique(weight)}
    sums = bit_sliced.add_up(columns)
    want = (values * (1 << weight)[:, None]).sum(axis=0)
    bits = [np.zeros(256, np.uint8) if s is None else np.unpackbits(s.view(np.uint8), bitorder="little") for s in sums]
    assert (sum(b.astype(int) << p for p, b in enumerate(bits))[:200] == want).all()
    alive = bit_sliced.bitmap(np.ones(200, bool), 4)
    for k in (1, 5, 200):
        kth = bit_sliced.largest(sums, alive, k)
        assert kth == np.sort(want)[-k]
        some = np.unpackbits(bit_sliced.at_least(sums, alive, kth).view(np.uint8), bitorder="little")
        assert (some[:200] == (want >= kth)).all()


@pytest.mark.parametrize("move", ["offset", "large", "small", "huge", "two far clusters", "outlier query"])
def test_graph_search_keeps_recall_wherever_the_vectors_lie(spark, move):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 16))
    x = {
        "offset": x + 1000, "large": x * 1e20, "small": x * 1e-160, "huge": x * 1e300,
        "two far clusters": x + 1e4 * (np.arange(1500) % 2)[:, None], "outlier query": x,
    }[move]
    if move == "outlier query":
        x[700] = 50.0
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rule = graph_ann.GraphRule(shard_rows=800, degree=16, beam=48)
    found = graph_ann.nearest(table, table.where("vec_id % 100 = 0"), 10, rule).collect()
    small = x / np.abs(x).max()
    hits = 0
    for q in range(0, 1500, 100):
        far = np.sqrt(((small - small[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        best = np.argsort(far, kind="stable")[:10]
        mine = sorted((r["rank"], r.id, r.score) for r in found if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        for _, i, score in mine:
            assert math.isclose(score / np.abs(x).max(), far[i], rel_tol=1e-9)
        hits += len({m[1] for m in mine} & set(best.tolist()))
    assert hits >= 0.9 * 150


def test_graph_search_reads_a_small_part_of_a_shard():
    """Distances computed for a query are under a tenth of a shard of clustered vectors."""
    rng = np.random.default_rng(9)
    x = (rng.normal(size=(60, 12))[rng.integers(0, 60, 6000)] + 0.3 * rng.normal(size=(6000, 12))).astype(np.float32)
    rule = graph_ann.GraphRule(degree=16, beam=24)
    edges, entry = graph_ann.build_graph(x, rule)
    ids, _, expanded = graph_ann.beam_search(x, edges, entry, x[::100], 24)
    seen = [len(np.unique(edges[e[e >= 0]])) for e in expanded]
    assert max(seen) < 600
    hits = 0
    for q, found in zip(range(0, 6000, 100), ids):
        far = ((x - x[q]) ** 2).sum(axis=1)
        hits += len(set(found[:10].tolist()) & set(np.argsort(far, kind="stable")[:10].tolist()))
    assert hits >= 0.9 * 600
