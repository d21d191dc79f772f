"""Suffix-array dedup by prefix-free parsing.

Removes every byte that is covered by a string of ``length`` bytes which also
starts anywhere else.

*Parse.*  A rolling hash of 8 bytes sets triggers: in any ``reach``
consecutive places the one with the smallest hash (the last of equals) is a
trigger.  Triggers cut texts into phrases; equal strings of ``length`` bytes
have their first trigger at the same place, so each string is seen from that
trigger: some bytes of the phrase before it (a suffix of a dictionary entry)
and the bytes after it (a suffix of the parse).

*Order.*  Only triggers whose following bytes occur twice matter; a 64-bit
hash finds them.  For these the suffixes of the parse are sorted by the bytes
after the trigger, the suffixes of the dictionary by the bytes before it read
backwards; longest common prefixes of neighbours give, for every length, the
classes of equal suffixes.  Both orders combined give the corpus order: the
string that starts o bytes before a trigger occurs twice just if another
trigger has the same class of o bytes before and of length - o bytes after.

Scale: each distinct text is shuffled once; the parse is cut into independent
parts by the hash of the bytes after the trigger, which equal strings share.
Sorting works on bounded blocks of whole parts.  A part of over ``crowd``
triggers (a passage in a great many texts) is not sorted in one task: its
strings are counted by a 128-bit hash, combined before the shuffle.  Copies of
a text are one text.

Defined results: a null text is an empty one; a text shorter than ``length``
loses nothing; rows that repeat a text, with whatever id, are copies of each
other and lose everything if the text is long enough; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.chunk_dedup import cut_out
from tidewater.llm.common import RangeHash, byte_slices, distinct_texts, join_back, mix64, repeated_keys, scratch_folder, text_key, text_of

#: Bytes of text that are parsed at a time, and triggers that are sorted at a time.
PIECE, BLOCK = 1 << 17, 20_000


@dataclass(frozen=True)
class RepeatRule:
    length: int = 400
    reach: int = 160
    crowd: int = 20_000

    @property
    def after(self) -> int:
        """Bytes after the trigger that every string of a part shares."""
        return self.length - self.reach + 1


def triggers(data: np.ndarray, offsets: np.ndarray, rule: RepeatRule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigger, first, last): the strings that start at first..last have this first trigger."""
    n, none = len(data), np.zeros(0, np.int64)
    if n < rule.length:
        return none, none, none
    gram = np.lib.stride_tricks.as_strided(data, (n - 7, 8), (1, 1)).copy().view("<u8").ravel()
    mask = np.uint64(0xFFFFFFFF)
    # one word orders by hash, then by place from the right
    best = (mix64(gram) & ~mask) | (mask - np.arange(n - 7, dtype=np.uint64))
    width = 1
    while width < rule.reach:
        step = min(width, rule.reach - width)
        best = np.minimum(best[:-step], best[step:])
        width += step
    starts = [np.arange(a, b - rule.length + 1) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()) if b - a >= rule.length]
    if not starts:
        return none, none, none
    start = np.concatenate(starts)
    at = (mask - (best[start] & mask)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[new], start[new], start[np.r_[new[1:] - 1, len(start) - 1]]


def pieces(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, shifts, bytes, offsets) of slices; a long text comes in overlapping pieces, the strings of each in one."""
    for lo, hi, data, offsets in byte_slices(column, PIECE):
        if hi - lo > 1 or len(data) <= 2 * PIECE:
            yield np.arange(lo, hi), np.zeros(hi - lo, np.int64), data, offsets
        else:
            for at in range(0, len(data) - length + 1, PIECE):
                part = data[at : at + PIECE + length - 1]
                yield np.array([lo]), np.array([at]), part, np.array([0, len(part)])


def parse(texts: DataFrame, rule: RepeatRule) -> DataFrame:
    """(text_id, at, ahead, behind, k): triggers, how many bytes before them strings start, and the hash of the bytes after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = RangeHash(3)
        seen: set[int] = set()  # copies in one task are parsed once
        for batch in batches:
            new = [i not in seen and not seen.add(i) for i in batch["text_id"].to_pylist()]
            batch = batch.filter(pa.array(new))
            ids = batch["text_id"].to_numpy(zero_copy_only=False)
            for rows, shifts, data, offsets in pieces(batch["text"], rule.length):
                at, first, last = triggers(data, offsets, rule)
                if not len(at):
                    continue
                hashed.load(data)
                row = np.searchsorted(offsets, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[rows[row]]),
                        pa.array(at - offsets[row] + shifts[row]),
                        pa.array((at - first).astype(np.int32)),
                        pa.array((at - last).astype(np.int32)),
                        pa.array(hashed.of(at, at + rule.after).view(np.int64)),
                    ],
                    ["text_id", "at", "ahead", "behind", "k"],
                )

    return texts.select("text_id", "text").mapInArrow(run, "text_id long, at long, ahead int, behind int, k long")


def contexts(live: DataFrame, rule: RepeatRule) -> DataFrame:
    """(k, k2, text_id, at, left, right) of the triggers in column ``sparse`` of each text.

    ``left`` holds the bytes before the trigger, read backwards, ``right``
    those behind the shared ones; k2 is a second hash of the shared bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = RangeHash(4)
        for batch in batches:
            for text_id, text, found in zip(batch["text_id"], batch["text"], batch["sparse"], strict=True):
                data = text.as_py().encode()
                for lo in range(0, len(found.values), 20_000):
                    part = found.values[lo : lo + 20_000]
                    at, ahead, behind, k = (part.field(c).to_numpy(zero_copy_only=False) for c in ("at", "ahead", "behind", "k"))
                    base = int(at[0]) if len(at) else 0
                    hashed.load(np.frombuffer(data, np.uint8)[base : int(at[-1]) + rule.after])
                    places = list(zip(at.tolist(), ahead.tolist(), behind.tolist(), strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(k),
                            pa.array(hashed.of(at - base, at - base + rule.after).view(np.int64)),
                            pa.array(np.full(len(at), text_id.as_py())),
                            pa.array(at),
                            pa.array([data[a - o : a][::-1] for a, o, _ in places], pa.binary()),
                            pa.array([data[a + rule.after : a + rule.length - o] for a, _, o in places], pa.binary()),
                        ],
                        ["k", "k2", "text_id", "at", "left", "right"],
                    )

    return live.where(F.size("sparse") > 0).mapInArrow(
        run, "k long, k2 long, text_id long, at long, left binary, right binary"
    )


def byte_matrix(values: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, lengths): the strings padded with zeros."""
    joined = b"".join(v.ljust(width, b"\0") for v in values)
    return np.frombuffer(joined, np.uint8).reshape(len(values), width), np.fromiter(map(len, values), np.int64, len(values))


def suffix_order(part: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): rows sorted by part, then bytes; bytes shared with the row before, -1 at a new part."""
    rows, width = matrix.shape
    keyed = np.concatenate([part.astype(">u4").view(np.uint8).reshape(rows, 4), matrix], axis=1)
    order = np.argsort(np.ascontiguousarray(keyed).view(f"S{width + 4}").ravel(), kind="stable")
    ordered = matrix[order]
    differ = np.ones((rows, width + 1), bool)
    differ[1:, :width] = ordered[1:] != ordered[:-1]
    common = differ.argmax(axis=1)
    common[np.r_[True, part[order][1:] != part[order][:-1]]] = -1
    return order, common


def repeated_strings(
    k: np.ndarray, left: list[bytes], right: list[bytes], rule: RepeatRule
) -> tuple[np.ndarray, np.ndarray]:
    """(most, fewest) bytes before each trigger at which a repeated string starts; -1 if none does."""
    rows, width = len(left), rule.reach - 1
    _, part = np.unique(k, axis=0, return_inverse=True)
    part = part.ravel()
    before, n_before = byte_matrix(left, width)
    behind, n_behind = byte_matrix(right, width)
    order_b, common_b = suffix_order(part, before)
    order_a, common_a = suffix_order(part, behind)
    most, fewest = np.full(rows, -1), np.full(rows, -1)
    class_b, class_a = np.empty(rows, np.int64), np.empty(rows, np.int64)
    for o in range(rule.reach):
        need = width - o  # bytes behind the shared ones
        some = np.flatnonzero((n_before >= o) & (n_behind >= need))
        if len(some) < 2:
            continue
        class_b[order_b] = np.cumsum(common_b < o)
        class_a[order_a] = np.cumsum(common_a < need)
        both = class_b[some] * (rows + 1) + class_a[some]
        order = np.argsort(both, kind="stable")
        same = both[order][1:] == both[order][:-1]
        twice = np.zeros(len(some), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = some[twice]
        most[hit] = o
        fewest[hit[fewest[hit] < 0]] = o
    return most, fewest


def sorted_spans(parts: DataFrame, rule: RepeatRule) -> DataFrame:
    """(text_id, a, b): bytes covered by repeated strings, from parts that are sorted in one task each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(block: pa.Table) -> pa.RecordBatch:
            k = np.stack([block["k"].to_numpy(), block["k2"].to_numpy()], axis=1)
            most, fewest = repeated_strings(k, block["left"].to_pylist(), block["right"].to_pylist(), rule)
            hit = most >= 0
            at, ids = block["at"].to_numpy()[hit], block["text_id"].to_numpy()[hit]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(at - most[hit]), pa.array(at - fewest[hit] + rule.length)], ["text_id", "a", "b"]
            )

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK:
                block = pa.Table.from_batches(held)
                last = int(np.searchsorted(block["k"].to_numpy(), block["k"][-1].as_py()))  # the last part may go on
                if last:
                    yield solve(block.slice(0, last))
                held = block.slice(last).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield solve(pa.Table.from_batches(held))

    return parts.repartition("k").sortWithinPartitions("k").mapInArrow(run, "text_id long, a long, b long")


def counted_spans(live: DataFrame, rule: RepeatRule) -> DataFrame:
    """(text_id, a, b) for crowded parts: every string by its 128-bit hash, counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = RangeHash(5), RangeHash(6)
        for batch in batches:
            for text_id, text, found in zip(batch["text_id"], batch["text"], batch["crowded"], strict=True):
                data = np.frombuffer(text.as_py().encode(), np.uint8)
                for lo in range(0, len(found.values), 1000):
                    part = found.values[lo : lo + 1000]
                    at, ahead, behind = (part.field(c).to_numpy(zero_copy_only=False) for c in ("at", "ahead", "behind"))
                    start = np.concatenate([np.arange(a - o, a - p + 1) for a, o, p in zip(at, ahead, behind, strict=True)])
                    base = int(start[0])
                    window = data[base : int(start[-1]) + rule.length]
                    first.load(window)
                    second.load(window)
                    here = start - base
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(first.of(here, here + rule.length).view(np.int64)),
                            pa.array(second.of(here, here + rule.length).view(np.int64)),
                            pa.array(np.full(len(start), text_id.as_py())),
                            pa.array(start),
                        ],
                        ["h", "h2", "text_id", "a"],
                    )

    strings = live.where(F.size("crowded") > 0).mapInArrow(run, "h long, h2 long, text_id long, a long")
    # grouped by a struct for the same reason as in repeated_keys
    often = strings.groupBy(F.struct("h", "h2").alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    often = often.where(F.col("n") > 1).select("_key.*")
    return strings.join(often, ["h", "h2"], "left_semi").select("text_id", "a", (F.col("a") + rule.length).alias("b"))


def dedup_texts(docs: DataFrame, rule: RepeatRule = RepeatRule(), text: str = "text") -> DataFrame:
    """One row per distinct text: text_id, n_bytes, n_removed, n_spans, kept (binary).

    A text that several rows hold is treated here as if it stood once.
    """
    spark = docs.sparkSession
    # copies of a text in other tasks only make more triggers live
    found = parse(docs.select(text_key(text).alias("text_id"), text_of(text).alias("text")), rule)
    place = F.struct("at", "ahead", "behind", "k")
    crowded = F.col("n") > rule.crowd
    # as many triggers as the text has at most
    live = (
        found.join(repeated_keys(found, "k"), "k")
        .groupBy("text_id")
        .agg(
            F.sort_array(F.collect_set(F.when(~crowded, place))).alias("sparse"),
            F.sort_array(F.collect_set(F.when(crowded, place))).alias("crowded"),
        )
    )
    path = scratch_folder(spark, "triggers")
    live.write.parquet(path)
    texts = distinct_texts(docs, text)
    with_text = texts.join(spark.read.parquet(path), "text_id").select("text_id", "text", "sparse", "crowded")
    spans = sorted_spans(contexts(with_text, rule), rule).unionByName(counted_spans(with_text, rule))
    covered = spans.groupBy("text_id").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for value, found in zip(batch["text"], batch["spans"], strict=True):
                data, runs = value.as_py().encode(), []
                for span in found.as_py() or []:
                    if runs and span["a"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], span["b"])
                    else:
                        runs.append([span["a"], span["b"]])
                kept = cut_out(data, runs)
                for c, x in zip(columns, (len(data), len(data) - len(kept), len(runs), kept), strict=True):
                    c.append(x)
            arrays = [pa.array(c, t) for c, t in zip(columns, [*[pa.int64()] * 3, pa.binary()], strict=True)]
            yield pa.RecordBatch.from_arrays([batch["text_id"], *arrays], ["text_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = texts.join(covered, "text_id", "left").select("text_id", "text", "spans")
    return joined.mapInArrow(remove, "text_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def per_document(
    docs: DataFrame, results: DataFrame, rule: RepeatRule = RepeatRule(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The results of :func:`dedup_texts` for each row of ``docs``; texts that several rows hold go whole.

    Takes any subset of the result columns; ``kept`` and ``kept_sha256`` are
    emptied where the row goes.
    """
    rows = docs.select(F.col(key).alias("id"), text_key(text).alias("text_id"))
    copies = rows.groupBy("text_id").agg(F.count(F.lit(1)).alias("n_copies"))
    goes = (F.col("n_copies") > 1) & (F.col("n_bytes") >= rule.length)
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
    joined = join_back(rows, copies.join(results, "text_id"), "text_id")
    return joined.select(F.col("id").alias(key), *columns)


def dedup_repeats(docs: DataFrame, rule: RepeatRule = RepeatRule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with what is left of its text (``kept``, binary: a cut may fall inside a character)."""
    return per_document(docs, dedup_texts(docs, rule, text), rule, key, text)
