"""Byte-level BPE encoding and decoding.

A text is cut into pre-tokens by a pattern.  Two tiers turn a pre-token into
ids:

1. a minimal perfect hash over the vocabulary maps the pre-token's bytes to
   the one slot where its entry can stand; if the entry equals the bytes, its
   id is the answer;
2. every other pre-token starts as a linked list of its bytes, and a heap
   yields the adjacent pair of lowest rank (leftmost first) until no pair is
   in the vocabulary: O(n log n) even for a pre-token of megabytes.

Results of recent pre-tokens are kept in a bounded table per task.

The rank file and the pattern are parameters; the file is read on the driver
and its entries travel with the function (their number is the vocabulary's,
whatever the data).

Defined results: a null text is an empty one and has no ids; an id that the
vocabulary lacks, or a null id, fails the decoding; null id lists decode to no
bytes.  Repeated rows and empty tables need nothing special, other columns
pass through untouched.
"""

from __future__ import annotations

import base64
from array import array
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import mix64, text_of

#: Pre-tokens whose ids a task remembers, and the longest that it keeps.
CACHE_ENTRIES = 300_000
CACHE_CHARS = 64

WORD = (1 << 64) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Entry bytes to id, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


@dataclass
class PerfectHash:
    """Minimal perfect hash by hash-and-displace.

    Keys fall into buckets.  A bucket with several keys stores the first seed
    that sends all of them to free slots; a bucket with one key stores the
    slot itself (as -slot - 1).
    """

    displace: np.ndarray
    slots: int

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        n = len(keys)
        h = cls.hashes(keys)
        if len(np.unique(h)) != n:
            raise ValueError("two entries share a 64-bit hash")
        buckets = max(1, n // 3)
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=buckets)
        ends = np.cumsum(sizes)
        displace = np.zeros(buckets, np.int64)
        free = np.ones(n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] < 2:
                break
            own = h[order[ends[b] - sizes[b] : ends[b]]]
            seed = 1
            while True:  # many seeds at a time
                seeds = np.arange(seed, seed + 64, dtype=np.uint64)
                at = (mix64(own[None, :] + seeds[:, None] * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)
                good = free[at].all(axis=1)
                for k in np.flatnonzero(good):
                    if len(set(at[k].tolist())) == len(own):
                        displace[b] = seed + k
                        free[at[k]] = False
                        break
                else:
                    seed += 64
                    continue
                break
        left = np.flatnonzero(free)
        ones = np.flatnonzero(sizes == 1)
        displace[ones] = -left[: len(ones)] - 1
        return cls(displace, n)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The only slot where a key of each hash can stand."""
        if not self.slots:
            return np.zeros(len(h), np.int64)
        d = self.displace[(h % np.uint64(len(self.displace))).astype(np.int64)]
        seeded = mix64(h + d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.slots)
        return np.where(d < 0, -d - 1, seeded.astype(np.int64))

    def find_one(self, key: bytes) -> int:
        """The same for one key, in plain integers."""
        h = xxhash.xxh64_intdigest(key)
        d = int(self.displace[h % len(self.displace)])
        if d < 0:
            return -d - 1
        x = (h + d * 0x9E3779B97F4A7C15) & WORD  # as mix64 does
        x = (x ^ (x >> 33)) * 0xFF51AFD7ED558CCD & WORD
        x = (x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53 & WORD
        return (x ^ (x >> 33)) % self.slots


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by merges: a heap of pairs over a linked list."""
    n = len(piece)
    end = list(range(1, n + 1))  # end[i]: where the part that starts at i stops; 0 once it is merged away
    before = list(range(-1, n - 1))
    get = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of the two parts has changed since
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := get(piece[i : end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
        j = before[i]
        if j >= 0 and (r := get(piece[j:stop])) is not None:
            heappush(heap, (r, j, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


@dataclass
class Vocabulary:
    """Entries by slot of the perfect hash, and the split pattern."""

    pattern: str
    table: PerfectHash
    entries: list[bytes]
    ids: list[int]
    ranks: dict[bytes, int] = field(repr=False)

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        ranks = read_ranks(path)
        keys = list(ranks)
        table = PerfectHash.build(keys)
        slot = table.find(PerfectHash.hashes(keys))
        entries: list[bytes] = [b""] * len(keys)
        ids = [0] * len(keys)
        for s, key in zip(slot.tolist(), keys, strict=True):
            entries[s], ids[s] = key, ranks[key]
        return cls(pattern, table, entries, ids, ranks)

    def resolve(self, piece: bytes) -> list[int]:
        """The ids of a pre-token: its own entry, or what the merges leave."""
        if self.entries:
            slot = self.table.find_one(piece)
            if self.entries[slot] == piece:
                return [self.ids[slot]]
        return merge_bytes(piece, self.ranks)

    def by_id(self) -> dict[int, bytes]:
        return {i: entry for entry, i in self.ranks.items()}


class Resolved(dict):
    """Pre-token to its ids, packed as 32-bit integers; a missing one is resolved, and kept while there is room."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        packed = array("i", self.vocabulary.resolve(piece.encode())).tobytes()
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = packed
        return packed


def id_lists(text: Column, vocabulary: Vocabulary, verify: bool = False) -> Column:
    """array<int> of the ids of a text column.

    With ``verify`` each text's ids are decoded again in the same worker; a
    difference is an error.
    """
    entry = vocabulary.by_id() if verify else {}
    split, known = regex.compile(vocabulary.pattern), Resolved(vocabulary)

    def encode(texts: pa.Array) -> pa.Array:
        offsets, flat = [0], bytearray()
        for value in texts:
            whole = value.as_py() or ""
            packed = b"".join(map(known.__getitem__, split.findall(whole)))
            if verify and b"".join(map(entry.__getitem__, memoryview(packed).cast("i"))) != whole.encode():
                raise ValueError("the decoded ids differ from the text")
            flat += packed
            offsets.append(len(flat) // 4)
        values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(flat)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    encode.__annotations__ = {"texts": pa.Array, "return": pa.Array}  # read by arrow_udf
    return F.arrow_udf(encode, "array<int>")(text)


def bytes_of(ids: Column, vocabulary: Vocabulary) -> Column:
    """binary of the bytes that an array<int> of ids stands for."""
    entry = vocabulary.by_id()

    def decode(lists: pa.Array) -> pa.Array:
        flat, offsets = lists.values.to_numpy(zero_copy_only=not lists.values.null_count), lists.offsets.to_pylist()
        get = entry.__getitem__
        return pa.array([b"".join(map(get, flat[a:b].tolist())) for a, b in zip(offsets, offsets[1:])], pa.binary())

    decode.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(decode, "binary")(ids)


def encode(
    df: DataFrame, vocabulary: Vocabulary, column: str = "text", into: str = "token_ids", verify: bool = False
) -> DataFrame:
    return df.withColumn(into, id_lists(text_of(column), vocabulary, verify))


def decode(df: DataFrame, vocabulary: Vocabulary, column: str = "token_ids", into: str = "decoded") -> DataFrame:
    return df.withColumn(into, bytes_of(F.coalesce(F.col(column), F.array().cast("array<int>")), vocabulary))
