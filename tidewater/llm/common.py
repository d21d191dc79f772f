"""Helpers shared by the operators: text columns, byte slices, scratch space.

Text identity.  Several operators work once per *distinct* text and hand the
result back to every row that holds it, so a group of exact copies, however
large, is one unit of work.  The identity is :func:`text_key`, the 64-bit
xxHash of the UTF-8 bytes; two different texts share one with probability
about n*n / 2**65 (one in 37 for a billion distinct texts).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def small_batches(spark: SparkSession, most: str = "4m") -> None:
    """Let at most ``most`` bytes of rows go to a Python worker at a time, however long the texts.

    An executor runs several workers beside its heap; each holds one batch and
    what it makes of it.  A setting other than Spark's default stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == f"{64 << 20}b":
        spark.conf.set(name, most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text") -> Column:
    return F.xxhash64(text_of(column))


def distinct_texts(docs: DataFrame, column: str = "text") -> DataFrame:
    """(text_id, text): one row per distinct text, partitioned by text_id.

    The only exchange in here carries the text once; plans that use the
    result several times reuse that exchange.
    """
    return docs.select(text_key(column).alias("text_id"), text_of(column).alias("text")).dropDuplicates(["text_id"])


def with_ids(df: DataFrame, ids: DataFrame, key: str, most: int = 2_000_000) -> DataFrame:
    """The rows of ``df`` whose ``key`` (a long) is in ``ids``, a stored table of distinct keys.

    Up to ``most`` keys (16 MB) are sent to every task, so that ``df`` is not
    shuffled; beyond that Spark plans an ordinary join.
    """
    return df.join(F.broadcast(ids) if ids.count() <= most else ids, key, "left_semi")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of the keys that more than one row of ``df`` has.

    Counts are combined before the shuffle.  Grouped by a struct, the result
    doesn't count as dealt by the key: a join with it gets an exchange on both
    sides right below, where adaptive execution can split a key that a large
    part of all rows has.
    """
    counted = df.groupBy(F.struct(key).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1).select(f"_key.{key}", "n")


def join_back(rows: DataFrame, results: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``results``, one row for each value of ``keys``.

    ``results`` is often dealt by the keys already, and then no exchange stands
    below its side of the join.  Joined by a struct of them both sides get
    one, so adaptive execution can split a key that a large part of all rows has.
    """
    keyed = results.select(F.struct(*keys).alias("_key"), *[c for c in results.columns if c not in keys])
    return rows.withColumn("_key", F.struct(*keys)).join(keyed, "_key", how).drop("_key")


def byte_slices(column: pa.Array, max_bytes: int = 1 << 17) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column without nulls into runs of rows of about ``max_bytes``.

    Yields (first row, end row, bytes, offsets); row ``first + r`` holds
    ``bytes[offsets[r]:offsets[r + 1]]``.  A run has one row at least, so one
    long text is never split.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    rows = len(column)
    if not rows:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=width)[column.offset : column.offset + rows + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scrambling of 64-bit words."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class RangeHash:
    """64-bit hashes of byte ranges: after one pass over the bytes any range costs a few operations.

    Every byte value stands for a random word, weighted by the power of an odd
    base that belongs to its place; a range's sum is divided by the power of
    its start.  ``salt`` picks other words, for a second, independent hash.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, salt: int = 0) -> None:
        seeds = np.arange(1, 257, dtype=np.uint64) + np.uint64(salt << 16)
        self.word = mix64(seeds * np.uint64(self.BASE))
        self.power = self.back = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        n = len(data)
        if len(self.power) <= n:  # the powers serve all later slices
            room = max(n, 1 << 16) + 1
            inverse = pow(self.BASE, -1, 1 << 64)
            self.power = np.cumprod(np.r_[np.uint64(1), np.full(room, self.BASE, np.uint64)], dtype=np.uint64)
            self.back = np.cumprod(np.r_[np.uint64(1), np.full(room, inverse, np.uint64)], dtype=np.uint64)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.word[data] * self.power[:n], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.total[end] - self.total[start]) * self.back[start] + (end - start).astype(np.uint64))


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, for tables written between steps."""
    prepare_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def prepare_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` use the folder named by ``spark.checkpoint.dir``.

    A folder of our own is set only where none is named and every task runs
    in this process; on a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
    elif context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
