"""Integer vectors dealt to packed shards, and queries streamed past them.

A shard is one stored row: ids, labels and vectors of some tens of thousands of
candidates, packed, so that a task loads it once.  :func:`beside_shards` lays
the queries behind each shard's row, in order; a task holds one shard and a
small batch of queries, however many queries there are.

Vectors become integers: each component x is floor(256 * x), x as double.
:func:`scores` gives inner products exactly, as 64-bit integers; one beyond
their range is given as the nearest end of the range.

Defined results: vectors that are null or empty, or hold a component that is
null or not finite (256 times it included), take no part, nor do rows with a
null id; only vectors of one length meet; rows that repeat an id are one row,
the one with the smallest (label, vector).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import scratch_folder

LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1
#: Integers up to here are exact in double precision.
EXACT = 1 << 53


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & (F.abs(v * 256.0) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def vector_rows(table: DataFrame, key: str, column: str, label: Column | None = None) -> DataFrame:
    """(id, label, vector, dim) of the rows that take part; a null ``label`` keeps a row out."""
    rows = table.select(
        F.col(key).cast("long").alias("id"),
        (F.lit(0) if label is None else label).cast("long").alias("label"),
        F.col(column).cast("array<double>").alias("vector"),
    )
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    return rows.withColumn("dim", F.size("vector"))


def one_row_an_id(rows: DataFrame, *keys: str) -> DataFrame:
    least = rows.groupBy(*keys, "id").agg(F.min(F.struct("label", "vector", "dim")).alias("_row"))
    return least.select(*keys, "id", "_row.*")


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def integers(vectors: np.ndarray) -> np.ndarray:
    return np.floor(vectors * 256.0)


def packed(values: np.ndarray) -> tuple[str, bytes]:
    """Type and bytes of integral doubles in the narrowest type that holds them."""
    most = float(np.abs(values).max(initial=0))
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
    return kind, values.astype(kind).tobytes()


@dataclass
class Shard:
    """Candidates of one length, ordered by id."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray  # integral doubles

    @classmethod
    def of(cls, row: dict) -> Shard:
        ids = np.frombuffer(row["ids"], np.int64)
        vectors = np.frombuffer(row["vectors"], row["kind"]).astype(np.float64).reshape(len(ids), -1)
        return cls(ids, np.frombuffer(row["labels"], np.int64), vectors)


def build_shards(rows: DataFrame, shard_rows: int, name: str) -> tuple[DataFrame, int]:
    """(the stored shards: dim, shard, ids, labels, kind, vectors; how many there are of a length)."""
    spark = rows.sparkSession
    shards = max(1, math.ceil(rows.count() / shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    # one exchange: the two groupings below are finer than the shards
    dealt = one_row_an_id(dealt.repartition(shards, "shard"), "shard")

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        kind, data = packed(integers(matrix(group["vector"])))
        return pa.table(
            {
                "dim": group["dim"].slice(0, 1),
                "shard": group["shard"].slice(0, 1),
                "ids": pa.array([group["id"].to_numpy().tobytes()], pa.binary()),
                "labels": pa.array([group["label"].to_numpy().tobytes()], pa.binary()),
                "kind": pa.array([kind]),
                "vectors": pa.array([data], pa.binary()),
            }
        )

    path = f"{scratch_folder(spark, name)}/shards"
    schema = "dim int, shard int, ids binary, labels binary, kind string, vectors binary"
    dealt.groupBy("shard", "dim").applyInArrow(pack, schema).write.parquet(path)
    return spark.read.parquet(path), shards


def beside_shards(index: DataFrame, shards: int, queries: DataFrame, order: list[str]) -> DataFrame:
    """Each shard's row followed by all queries of its length, sorted by ``order``, in one partition.

    A shard is copied to several lanes, each with a part of the queries, only
    where there are fewer shards than tasks can run at a time; equal values of
    ``order[0]`` stay in one lane.
    """
    lanes = max(1, math.ceil(2 * index.sparkSession.sparkContext.defaultParallelism / shards))
    copies = index.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).withColumn("_later", F.lit(False))
    wanted = queries.withColumns(
        {
            "shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))),
            "lane": F.pmod(F.xxhash64(order[0]), F.lit(lanes)).cast("int"),
            "_later": F.lit(True),
        }
    )
    both = copies.unionByName(wanted, allowMissingColumns=True)
    keys = ["dim", "shard", "lane"]
    return both.repartition(shards * lanes, *keys).sortWithinPartitions(*keys, "_later", *order)


def search_shards(
    beside: DataFrame, load: Callable[[dict], object], search: Callable[[object, pa.Table], pa.Table], schema: str,
    group: str | None = None, most: int = 256,
) -> DataFrame:
    """``search(load(shard's row), queries)`` for each shard and each batch of at most ``most`` of its queries.

    With ``group`` a batch holds one value of that column only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard, held = None, None, []

        def flush(all_: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            rows = pa.Table.from_batches(held) if held else None
            held = []
            while rows is not None and rows.num_rows:
                n = min(most, rows.num_rows)
                if group:
                    value = rows[group].to_numpy()
                    n = min(n, int(np.argmax(np.r_[value[1:] != value[:-1], True])) + 1)
                if n == rows.num_rows < most and not all_:
                    held = rows.combine_chunks().to_batches()
                    return
                if shard is not None:
                    yield from search(shard, rows.slice(0, n)).to_batches()
                rows = rows.slice(n)

        for batch in batches:
            at = np.stack([batch[c].to_numpy() for c in ("dim", "shard", "lane")], axis=1)
            later = batch["_later"].to_numpy(zero_copy_only=False)
            new = np.r_[True, (at[1:] != at[:-1]).any(axis=1)] | ~later
            first = np.flatnonzero(new)
            for lo, hi in zip(first.tolist(), [*first[1:].tolist(), batch.num_rows]):
                here = tuple(at[lo].tolist())
                if here != key:
                    yield from flush(True)
                    key, shard = here, None
                if not later[lo]:
                    shard, lo = load(batch.slice(lo, 1).to_pylist()[0]), lo + 1
                if hi > lo:
                    held.append(batch.slice(lo, hi - lo))
                    yield from flush(False)
        yield from flush(True)

    return beside.mapInArrow(run, schema)


def exact_in_double(a: np.ndarray, b: np.ndarray, margin: int = 1) -> bool:
    """Whether inner products of rows of the two, times ``margin``, are exact in double precision."""
    most = float(np.abs(a).max(initial=0)), float(np.abs(b).max(initial=0))
    return all(m < EXACT for m in most) and int(most[0]) * int(most[1]) * a.shape[-1] * margin < EXACT


def as_objects(values: np.ndarray) -> np.ndarray:
    """Integral doubles as Python integers."""
    out = np.empty(values.shape, object)
    out.ravel()[:] = [int(v) for v in values.ravel().tolist()]
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a (n, d) with those of b (m, d) as int64 (n, m), ends of the range beyond it."""
    if exact_in_double(a, b):
        return (a @ b.T).astype(np.int64)
    product = as_objects(a) @ as_objects(b).T
    return np.clip(product, LONG_MIN, LONG_MAX).astype(np.int64)
