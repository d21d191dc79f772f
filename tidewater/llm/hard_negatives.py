"""Hard negatives by lists that the anchors of a cluster share.

*Clusters.*  Spherical k-means on a bounded sample of the anchors gives the
centres; every anchor belongs to the nearest one.  In a task the members of a
cluster (at most ``members`` at a time) have their own mean direction, and the
greatest angle between it and a member is the cluster's opening.

*Lists.*  A candidate at angle t from the mean direction has with no member a
smaller angle than t - opening, so its inner product with a member u is at most
|u| |candidate| cos(max(0, t - opening)).  The shard's candidates are sorted by
that bound once a cluster, and all members walk the list in blocks.  A member
stops when what is left has a bound below its last kept score, or below the
least score it may take: its result is then certified.

*Two walks.*  The first finds each anchor's ``positives`` best rows of its own
label, merged over the shards by a window.  The second finds for each (anchor,
positive) the ``negatives`` best rows of other labels whose score lies between
``percent`` hundredths of the positive's score and all of it.

Scores are exact integers.  Where a product may leave the range that double
precision holds exactly, scores are computed with Python integers and the list
is walked to its end.

Defined results: see :mod:`tidewater.llm.vector_shards`; a row with a null
label takes no part; an anchor without a row of its label has no rows in the
result, nor has a positive without a negative in its range (a negative positive
score leaves an empty range); ties in score go to the smaller id; a score beyond
a long's range is the end of the range, and ranks so.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import scratch_folder
from tidewater.llm.vector_shards import (
    LONG_MAX, LONG_MIN, Shard, beside_shards, build_shards, exact_in_double, integers, matrix, one_row_an_id, scores, search_shards,
)


@dataclass(frozen=True)
class MiningRule:
    positives: int = 5
    negatives: int = 5
    percent: int = 80
    shard_rows: int = 1 << 15
    members: int = 128
    block: int = 4096
    #: Anchors that the centres are fitted on, and how many centres there are at most.
    sample: int = 10_000
    centres: int = 256


# ------------------------------------------------------------------ clusters


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; zero rows stay."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def fit_centres(anchors: DataFrame, rule: MiningRule) -> dict[int, np.ndarray]:
    """Centres for each length of vector in a sample of ``rule.sample`` anchors."""
    sample = anchors.select("dim", "vector", "id").orderBy(F.xxhash64("id"), "id").limit(rule.sample).toArrow()
    out = {}
    for dim in set(sample["dim"].to_pylist()):
        x = unit_rows(integers(matrix(sample.filter(pa.compute.equal(sample["dim"], dim))["vector"])))
        n = max(1, min(rule.centres, math.isqrt(len(x))))
        centres = x[np.random.default_rng(11).permutation(len(x))[:n]]
        for _ in range(8):
            nearest = (x @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, x)
            centres = np.where(np.bincount(nearest, minlength=n)[:, None] > 0, unit_rows(sums), centres)
        out[dim] = centres
    return out


def with_cluster(anchors: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """``anchors`` with the number of the nearest centre; 0 for a length that has none."""

    def nearest(batches):
        for batch in batches:
            cluster = np.zeros(batch.num_rows, np.int32)
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims):
                if int(dim) in centres:
                    rows = np.flatnonzero(dims == dim)
                    x = unit_rows(integers(matrix(batch["vector"].take(pa.array(rows)))))
                    cluster[rows] = (x @ centres[int(dim)].T).argmax(axis=1)
            yield batch.append_column("cluster", pa.array(cluster))

    fields = anchors.select("id", "label", "vector", "dim")
    return fields.mapInArrow(nearest, "id long, label long, vector array<double>, dim int, cluster int")


# ---------------------------------------------------------------------- walk


def shared_list(shard: Shard, members: np.ndarray, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): the candidates by their greatest possible inner product with a member of length 1, largest first."""
    if not known:
        known["norm"] = np.linalg.norm(shard.vectors, axis=1)
        known["unit"] = unit_rows(shard.vectors)
    unit = unit_rows(members)
    middle = unit_rows(unit.sum(axis=0, keepdims=True))[0]
    cosine = np.clip(unit @ middle, -1, 1)
    angle = np.arccos(np.clip(known["unit"] @ middle, -1, 1))
    opening = np.arccos(cosine).max()  # a zero vector has angle 90 degrees here and the score 0 with any
    # 1e-7 of an angle and 1e-9 of a length cover what rounding does
    bounds = known["norm"] * np.cos(np.maximum(0, angle - opening - 1e-7)) * (1 + 1e-9) + 1e-9 * known["norm"]
    bounds = np.where(bounds > 0, bounds, 0.0)  # also of those that can't be positive with any member
    order = np.argsort(-bounds, kind="stable")
    return order, bounds[order]


def walk(
    shard: Shard, members: np.ndarray, labels: np.ndarray, ids: np.ndarray, known: dict, rule: MiningRule,
    row_of: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(walker, id, score): the k best candidates of each walker, ties to the smaller id.

    Walker w is member ``row_of[w]`` and takes scores from ``low[w]`` to
    ``high[w]``, of its own label (but its own row) or of others.
    """
    certain = exact_in_double(shard.vectors, members, 100)
    none = np.zeros(0, np.int64)
    if certain:
        order, bounds = shared_list(shard, members, known)
        length = np.linalg.norm(members, axis=1)
    else:
        order, bounds = np.arange(len(shard.ids)), np.full(len(shard.ids), np.inf)
        length = np.ones(len(members))
    kept = (none, none, none)
    last = np.full(len(row_of), LONG_MIN)  # the k-th best score so far, where there are k
    full = np.zeros(len(row_of), bool)
    active = np.flatnonzero(low <= high)
    for at in range(0, len(order), rule.block):
        best_left = bounds[at] * length[row_of[active]] + 1e-6
        done = (best_left < low[active]) | (full[active] & (best_left < last[active]))
        active = active[~done]
        if not len(active):
            break
        rows = np.sort(order[at : at + rule.block])  # in the order of their ids
        who, back = np.unique(row_of[active], return_inverse=True)
        score = scores(shard.vectors[rows], members[who]).T[back]
        matching = shard.labels[rows][None, :] == labels[row_of[active]][:, None]
        fits = matching if same else ~matching
        fits &= shard.ids[rows][None, :] != ids[row_of[active]][:, None]
        fits &= (score >= np.maximum(low, last)[active][:, None]) & (score <= high[active][:, None])
        if np.count_nonzero(fits) > 16 * k * len(active):  # of a block, the k best with smaller ids first
            kth = np.partition(np.where(fits, score, LONG_MIN), -k, axis=1)[:, -k][:, None]
            tie = fits & (score == kth)
            fits = (fits & (score > kth)) | (tie & (np.cumsum(tie, axis=1) <= k))
        walker, column = np.nonzero(fits)
        new = (active[walker], shard.ids[rows][column], score[walker, column])
        joined = [np.concatenate(pair) for pair in zip(kept, new, strict=True)]
        by = np.lexsort((joined[1], ~joined[2], joined[0]))
        first = np.searchsorted(joined[0][by], joined[0][by])
        by = by[np.arange(len(by)) - first < k]
        kept = tuple(column[by] for column in joined)
        count = np.bincount(kept[0], minlength=len(row_of))
        full = count >= k
        end = np.cumsum(count) - 1
        last[full] = kept[2][end[full]]
    return kept


# ------------------------------------------------------------------ on Spark


def least_of(positive: np.ndarray, percent: int) -> np.ndarray:
    """The smallest integer s with percent * positive <= 100 * s, by Python integers."""
    return np.array([min(LONG_MAX, -(-percent * p // 100)) for p in positive.tolist()], np.int64)


def mine(candidates: DataFrame, anchors: DataFrame, rule: MiningRule = MiningRule()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each row of ``anchors``.

    Both are rows of :func:`tidewater.llm.vector_shards.vector_rows`.
    """
    spark = candidates.sparkSession
    index, shards = build_shards(candidates, rule.shard_rows, "negatives")
    wanted = one_row_an_id(anchors)
    wanted = with_cluster(wanted, fit_centres(wanted, rule)).withColumnsRenamed({"id": "anchor_id", "label": "anchor_label", "vector": "anchor"})

    def load(row: dict) -> tuple[Shard, dict]:
        return Shard.of(row), {}

    def members(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(vectors, labels, ids) of a batch's anchors, and the anchor of each row."""
        ids = rows["anchor_id"].to_numpy()
        _, first, back = np.unique(ids, return_index=True, return_inverse=True)
        vectors = integers(matrix(rows["anchor"].take(pa.array(first))))
        return vectors, rows["anchor_label"].to_numpy()[first], ids[first], back

    def find_positives(loaded: tuple[Shard, dict], rows: pa.Table) -> pa.Table:
        shard, known = loaded
        vectors, labels, ids, back = members(rows)
        low, high = np.full(len(back), LONG_MIN), np.full(len(back), LONG_MAX)
        w, found, score = walk(shard, vectors, labels, ids, known, rule, back, low, high, True, rule.positives)
        return pa.table({"anchor_id": ids[back][w], "positive_id": found, "positive_score": score})

    beside = beside_shards(index, shards, wanted, ["cluster", "anchor_id"])
    found = search_shards(
        beside, load, find_positives, "anchor_id long, positive_id long, positive_score long", "cluster", rule.members
    )
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    ranked = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= rule.positives).drop("_n")
    path = f"{scratch_folder(spark, 'negatives')}/positives"
    ranked.join(wanted, "anchor_id").write.parquet(path)
    positives = spark.read.parquet(path)

    def find_negatives(loaded: tuple[Shard, dict], rows: pa.Table) -> pa.Table:
        shard, known = loaded
        vectors, labels, ids, back = members(rows)
        high = rows["positive_score"].to_numpy()
        low = least_of(high, rule.percent)
        w, found, score = walk(shard, vectors, labels, ids, known, rule, back, low, high, False, rule.negatives)
        return pa.table(
            {
                "anchor_id": ids[back][w],
                "positive_id": rows["positive_id"].to_numpy()[w],
                "positive_score": high[w],
                "negative_id": found,
                "negative_score": score,
            }
        )

    beside = beside_shards(index, shards, positives, ["cluster", "anchor_id", "positive_id"])
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = search_shards(beside, load, find_negatives, schema, "cluster", rule.members * rule.positives)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rule.negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
