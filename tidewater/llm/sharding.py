"""Sharding by rendezvous hashing.

Every record key draws one number per shard from a hash of (key, shard); the
record goes to the shard with the best draw.  With weights w the draw is
-ln(u) / w and the smallest wins, which gives each shard a share in proportion
to its weight.  A new shard can only win records for itself, no record moves
between old shards.  Key and shard list decide alone, so any task places a
record without coordination.

Slots number the records of a shard without gaps.  A shard may hold a large
part of all rows, so it is numbered in buckets: rows are ranked inside a
(shard, bucket) and shifted by the number of rows in the buckets before it.
The table of bucket sizes has shards x buckets rows; buckets grow with the
row count so that one has about ``bucket_rows`` rows.  Rows that repeat key and
text are counted before the shuffle and numbered as one, whose slots are dealt
out again in parts of ``part_rows``: however many there are, no task ranks or
writes them all.

Defined results: a null key is read as the empty string and placed like any
key; a null text has no bytes; rows repeated exactly get a slot each; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import text_of


def unit_draw(key: Column, shard: Column) -> Column:
    """A number in (0, 1) from the key and a shard number (52 bits of the 64-bit hash)."""
    bits = F.shiftrightunsigned(F.xxhash64(key, shard), 12)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def draw(key: Column, shard: int, weight: float) -> Column:
    """(draw, shard): what the key draws for one shard."""
    key = F.coalesce(key.cast("string"), F.lit(""))
    return F.struct((-F.log(unit_draw(key, F.lit(shard))) / F.lit(float(weight))).alias("draw"), F.lit(shard).alias("shard"))


def best_draw(key: Column, weights: Sequence[float]) -> Column:
    """The smallest (draw, shard) of a key; equal draws go to the smaller shard."""
    if not weights or any(not w > 0 or math.isinf(w) for w in weights):
        raise ValueError("weights must be positive and finite")
    return F.array_min(F.array(*[draw(key, s, w) for s, w in enumerate(weights)]))


def assign_shards(
    docs: DataFrame,
    weights: Sequence[float] = (1.0,) * 40,
    key: str = "doc_id",
    text: str = "text",
    bucket_rows: int = 250_000,
    part_rows: int = 65_536,
) -> DataFrame:
    """One row per record: key, size, text_crc32, shard, slot, grown_shard.

    ``grown_shard`` is the place with one more shard of weight 1.
    """
    rows = docs.select(
        F.col(key),
        (F.octet_length(text_of(text)) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text_of(text)).alias("text_crc32"),
    )
    count = docs.count()
    buckets = max(1, math.ceil(count / (len(weights) * bucket_rows)))
    drawn = rows.select("*", best_draw(F.col(key), weights).alias("best"), draw(F.col(key), len(weights), 1.0).alias("new"))
    placed = drawn.select(
        key,
        "size",
        "text_crc32",
        F.col("best.shard").alias("shard"),
        F.least("best", "new")["shard"].alias("grown_shard"),
        F.pmod(F.xxhash64(F.col(key), F.col("text_crc32"), F.col("size")), F.lit(buckets)).cast("int").alias("bucket"),
    )
    counted = placed.groupBy(*placed.columns).agg(F.count(F.lit(1)).alias("n"))
    sizes = counted.groupBy("shard", "bucket").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "bucket").orderBy(F.col(key).asc_nulls_first(), "text_crc32", "size")
    above = inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = counted.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0)))
    last = F.lit(part_rows) - 1
    parts = (
        numbered.join(starts, ["shard", "bucket"])
        .withColumn("start", F.col("first") + F.col("above"))
        .withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(part_rows).cast("long"))))
        .hint("rebalance", key, "at")
    )
    place = F.explode(F.sequence(F.col("at"), F.least(F.col("at") + last, F.col("n") - 1)))
    return parts.withColumn("place", place).select(
        key,
        "size",
        "text_crc32",
        "shard",
        (F.col("start") + F.col("place")).cast("long").alias("slot"),
        "grown_shard",
    )


def write_shards(docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * 40, key: str = "doc_id") -> None:
    """Write whole records as Parquet, one folder per shard."""
    docs.withColumn("shard", best_draw(F.col(key), weights)["shard"]).write.partitionBy("shard").parquet(path)
