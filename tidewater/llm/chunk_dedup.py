"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text (each byte's word enters at the low
end and is shifted out after 16 bytes).  A cut falls where the hash is smaller
than at all places within ``reach`` bytes before and not larger than at those
after it, so a cut depends on nearby bytes only: an insertion moves the cuts
around it and no others, and a passage has the same chunks wherever it stands.
Chunks hold more than ``reach`` bytes, about twice as many on average (first
and last chunk of a text aside).

Chunks are deduplicated by a 128-bit digest: the occurrence in the document of
the smallest id (and in it the first) stays, others go if they lie in a run of
neighbouring such chunks of ``min_bytes`` at least; shorter repeats are the
common coin of a language.  Exact copies of a text go as a whole if it has
``min_bytes`` at least; copies of a shorter text all stay.

There is no longest chunk: a stretch of period ``reach`` or less has no cut and
is one chunk with its neighbours, so it is not found in other surroundings.

Scale: texts are shuffled once, by text id; digests alone are counted first,
combined before the shuffle, so a chunk in a third of all documents is one row
a task, and only chunks whose digest occurs twice are stored and compared.

Defined results: a null text is an empty one, with no chunk; ids that are null
count as larger than any other; rows that repeat id and text are one document
and get equal results; an empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import RangeHash, byte_slices, distinct_texts, join_back, mix64, repeated_keys, scratch_folder, text_key, text_of

#: Bytes of padding between the texts of a slice.
GAP = 64


@dataclass(frozen=True)
class ChunkRule:
    reach: int = 24
    min_bytes: int = 64


def gear_hash(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the 16 bytes that end there: sum of word[byte] << age."""
    word = mix64(np.arange(1000, 1256, dtype=np.uint64) * np.uint64(RangeHash.BASE)).astype(np.uint32)
    h = word[data]
    for age in (1, 2, 4, 8):  # sums over 2, 4, 8, 16 bytes
        h[age:] += h[:-age].copy() << np.uint32(age)
    return h * np.uint32(0x9E3779B1)


def least_before(h: np.ndarray, reach: int) -> np.ndarray:
    """The smallest of the ``reach`` values before each place; edges count as largest."""
    top = np.uint32(0xFFFFFFFF)
    out = np.full(len(h), top, np.uint32)
    out[1:] = h[:-1]
    width = 1
    while width < reach:
        step = min(width, reach - width)
        out[step:] = np.minimum(out[step:], out[:-step].copy())
        width += step
    return out


def cuts(data: np.ndarray, offsets: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the chunks of the texts in ``data``; places count from the slice's start."""
    rows = len(offsets) - 1
    sizes = np.diff(offsets)
    # texts apart from each other, so that none sees its neighbour
    shift = GAP * (np.arange(rows) + 1)
    padded = np.zeros(len(data) + GAP * (rows + 1), np.uint8)
    padded[np.arange(len(data)) + np.repeat(shift, sizes)] = data
    h = gear_hash(padded)
    cut = (h < least_before(h, reach)) & (h <= least_before(h[::-1], reach)[::-1])
    at = np.flatnonzero(cut)
    row = np.searchsorted(offsets[:-1] + shift, at, side="right") - 1
    at, row = at[row >= 0], row[row >= 0]
    at = at - shift[row]
    inside = (at > offsets[row]) & (at < offsets[row + 1])
    full = np.flatnonzero(sizes)
    start = np.concatenate((at[inside], offsets[:-1][full]))
    row = np.concatenate((row[inside], full))
    order = np.lexsort((start, row))
    start, row = start[order], row[order]
    end = np.empty_like(start)
    end[:-1] = start[1:]
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    end[last] = offsets[row[last] + 1]
    return row, start, end


def chunk_rows(texts: DataFrame, rule: ChunkRule) -> DataFrame:
    """(h, h2, text_id, start, size): every chunk with its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = RangeHash(1), RangeHash(2)
        seen: set[int] = set()  # copies in one task are cut once
        for batch in batches:
            new = [i not in seen and not seen.add(i) for i in batch["text_id"].to_pylist()]
            batch = batch.filter(pa.array(new))
            for lo, hi, data, offsets in byte_slices(batch["text"]):
                row, start, end = cuts(data, offsets, rule.reach)
                first.load(data)
                second.load(data)
                ids = batch["text_id"][lo:hi].to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first.of(start, end).view(np.int64)),
                        pa.array(second.of(start, end).view(np.int64)),
                        pa.array(ids[row]),
                        pa.array((start - offsets[row]).astype(np.int32)),
                        pa.array((end - start).astype(np.int32)),
                    ],
                    ["h", "h2", "text_id", "start", "size"],
                )

    return texts.select("text_id", "text").mapInArrow(run, "h long, h2 long, text_id long, start int, size int")


def repeated_chunks(docs: DataFrame, key: str, text: str, rule: ChunkRule) -> DataFrame:
    """(text_id, repeats): for each text its repeated chunks (start, size, later), later if not the one that stays."""
    spark = docs.sparkSession
    rows = docs.select(text_key(text).alias("text_id"), text_of(text).alias("text"), F.col(key).alias("id"))
    chunks = chunk_rows(rows, rule)
    # copies of a text repeat its digests; they only make this first sieve a little wider
    often = repeated_keys(chunks, "h").select("h")
    path = scratch_folder(spark, "chunks")
    chunks.join(often, "h").dropDuplicates(["text_id", "start"]).write.parquet(path)
    least = rows.groupBy("text_id").agg(F.min("id").alias("least"))
    found = spark.read.parquet(path).join(least, "text_id")
    place = F.struct(F.col("least").isNull().alias("none"), "least", "text_id", "start")
    # grouped by a struct for the same reason as in repeated_keys
    owner = found.groupBy(F.struct("h", "h2").alias("_key")).agg(F.min(place).alias("owner"), F.count(F.lit(1)).alias("n"))
    owner = owner.where(F.col("n") > 1).select("_key.*", "owner")
    owned = found.join(owner, ["h", "h2"]).select(
        "text_id",
        F.struct("start", "size", (~place.eqNullSafe(F.col("owner"))).alias("later")).alias("chunk"),
    )
    # as many chunks as the text has at most
    return owned.groupBy("text_id").agg(F.sort_array(F.collect_list("chunk")).alias("repeats"))


def runs_of(chunks: list[dict], min_bytes: int) -> list[tuple[int, int]]:
    """Runs of neighbouring chunks with ``min_bytes`` or more."""
    spans: list[list[int]] = []
    for chunk in chunks:
        start, end = chunk["start"], chunk["start"] + chunk["size"]
        if spans and spans[-1][1] == start:
            spans[-1][1] = end
        else:
            spans.append([start, end])
    return [(a, b) for a, b in spans if b - a >= min_bytes]


def cut_out(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def dedup_texts(docs: DataFrame, rule: ChunkRule = ChunkRule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per distinct text: text_id, n_bytes, n_repeated, n_removed, n_spans, kept (binary).

    n_repeated counts the bytes of all runs that occur elsewhere too, those
    that stay included.
    """
    texts = distinct_texts(docs, text)
    repeats = repeated_chunks(docs, key, text, rule)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for value, chunks in zip(batch["text"], batch["repeats"], strict=True):
                data, chunks = value.as_py().encode(), chunks.as_py() or []
                repeated = sum(b - a for a, b in runs_of(chunks, rule.min_bytes))
                spans = runs_of([c for c in chunks if c["later"]], rule.min_bytes)
                kept = cut_out(data, spans)
                for c, x in zip(columns, (len(data), repeated, len(data) - len(kept), len(spans), kept), strict=True):
                    c.append(x)
            types = [*[pa.int64()] * 4, pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["text_id"], *arrays], ["text_id", "n_bytes", "n_repeated", "n_removed", "n_spans", "kept"]
            )

    joined = texts.join(repeats, "text_id", "left").select("text_id", "text", "repeats")
    return joined.mapInArrow(
        remove, "text_id long, n_bytes long, n_repeated long, n_removed long, n_spans long, kept binary"
    )


def per_document(
    docs: DataFrame, results: DataFrame, rule: ChunkRule = ChunkRule(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The results of :func:`dedup_texts` for each row of ``docs``, with n_copies; later copies go whole.

    Takes any subset of the result columns; ``kept`` and ``kept_sha256`` are
    emptied where the row goes.
    """
    rows = docs.select(F.col(key).alias("id"), text_key(text).alias("text_id"))
    copies = rows.groupBy("text_id").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n_copies"))
    joined = join_back(rows, copies.join(results, "text_id"), "text_id")
    goes = ~F.col("id").eqNullSafe(F.col("least")) & (F.col("n_bytes") >= rule.min_bytes)
    instead = {
        "n_removed": F.col("n_bytes"),
        "n_spans": F.lit(1).cast("long"),
        "kept": F.lit(b""),
        "kept_sha256": F.sha2(F.lit(b""), 256),
    }
    columns = [
        F.when(goes, instead[c]).otherwise(F.col(c)).alias(c) if c in instead else F.col(c)
        for c in results.columns
        if c != "text_id"
    ]
    return joined.select(F.col("id").alias(key), *columns, "n_copies")


def dedup_substrings(
    docs: DataFrame, rule: ChunkRule = ChunkRule(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document with what is left of its text (``kept``, binary: a cut may fall inside a character)."""
    return per_document(docs, dedup_texts(docs, rule, key, text), rule, key, text)
