"""MinHash near-duplicates from bottom-k sketches of one hash function.

A text's set is its distinct word shingles, each as a 64-bit hash.  Its sketch
holds the smallest k hashes; a set of at most ``whole`` shingles is kept whole.

1. *Inverted lists* of the retained values generate candidates.  Two sketches
   of sets with similarity t share at least c values (all but certainly, see
   :func:`least_overlap`), so they share one among the first s - c + 1 of s
   values in any common order.  The order used is by frequency, rarest first,
   counted over all texts: a passage that many documents quote falls out of
   the lists unless it makes up most of a document.
2. Each list is first compared with one pivot, its member with the fewest
   rarer values.  Links that hold give components; then the pairs that are
   still in different components are compared, those of long lists after
   listing their members anew with whole sets.  A group of n near copies
   costs about n comparisons, not n * n.
3. The *union sketch* of a pair estimates its similarity and filters;
   the exact Jaccard similarity of the full sets verifies the rest.

Exact copies are one text throughout (see :mod:`tidewater.llm.common`).

Defined results: a null text is an empty one; a text without words has an
empty set and is linked with nothing but stays a document of its own; with
fewer words than a shingle holds, the words together are the only shingle.
Rows that repeat a text, with whatever id, are linked as copies if the text
has words.  Component ids are the smallest id in the component; ids that are
null are ignored for it, and a component without any id has a null one.  Rows
that repeat a doc_id get the components of their texts.  An empty table gives
no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import (
    RangeHash,
    byte_slices,
    join_back,
    mix64,
    repeated_keys,
    scratch_folder,
    text_key,
    text_of,
    with_ids,
)
from tidewater.llm.components import components

BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class NearRule:
    """Shingle width in words, similarity in percent, and sketch sizes."""

    width: int = 5
    percent: int = 80
    k: int = 128
    whole: int = 256
    #: Members from which on a list's texts are compared by whole sets.
    crowd: int = 16
    #: Standard errors by which a sketch may fall short of what it estimates.
    slack: float = 5.0


# ---------------------------------------------------------------- shingles


def word_hashes(data: np.ndarray, offsets: np.ndarray, hashed: RangeHash | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every word of the texts in ``data``, A-Z lowered."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    separator = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.zeros(n + 1, bool)
    first[offsets] = True  # where a text starts
    begin = ~separator
    begin[1:] &= separator[:-1] | first[1:n]
    stop = ~separator
    stop[:-1] &= separator[1:] | first[1:n]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    lowered = np.where((data >= 65) & (data <= 90), data + 32, data)
    hashed = hashed or RangeHash()
    hashed.load(lowered)
    return np.searchsorted(offsets, start, side="right") - 1, hashed.of(start, end)


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, width: int, hashed: RangeHash | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(set offsets, hashes): the sorted distinct shingles of each text."""
    rows = len(offsets) - 1
    doc, word = word_hashes(data, offsets, hashed)
    per_doc = np.bincount(doc, minlength=rows)
    first_word = np.concatenate(([0], np.cumsum(per_doc)))
    docs, hashes = [], []
    for m in range(1, width + 1):  # shorter texts are one shingle of all their words
        if m < width:
            of = np.flatnonzero(per_doc == m)
            at = first_word[of]
        else:
            at = np.arange(max(0, len(word) - width + 1))
            at = at[doc[at] == doc[at + width - 1]]
            of = doc[at]
        if len(at):
            joined = np.full(len(at), np.uint64(m))
            for j in range(m):
                joined = mix64(joined * BASE + word[at + j])
            docs.append(of)
            hashes.append(joined.view(np.int64))
    if not docs:
        return np.zeros(rows + 1, np.int64), np.zeros(0, np.int64)
    doc, value = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=rows)))), value


def _map_sets(batches: Iterator[pa.RecordBatch], width: int, keep: list[str]):
    """(columns to keep, set offsets, hashes) for slices of the batches' rows."""
    hashed = RangeHash()
    for batch in batches:
        for lo, hi, data, offsets in byte_slices(batch["text"]):
            bounds, values = shingle_sets(data, offsets, width, hashed)
            yield [batch[c][lo:hi] for c in keep], bounds, values


def with_set_sizes(docs: DataFrame, width: int, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` (which has a text) and n, the size of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, bounds, _ in _map_sets(batches, width, keep):
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(bounds), pa.int64())], [*keep, "n"])

    return docs.select(*keep, "text").mapInArrow(run, docs.select(*keep, F.lit(0).cast("long").alias("n")).schema)


def full_sets(texts: DataFrame, width: int) -> DataFrame:
    """(text_id, shingles) with the sorted distinct shingles of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, bounds, values in _map_sets(batches, width, ["text_id"]):
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([*kept, lists], ["text_id", "shingles"])

    return texts.select("text_id", "text").mapInArrow(run, "text_id long, shingles array<long>")


def retained_values(texts: DataFrame, rule: NearRule) -> DataFrame:
    """(text_id, tier, n, v): one row for each value that a sketch retains.

    Tier 0 holds whole sets, tier 1 bottom-k sketches.  A set near ``whole``
    is in both, since its partners may be in either.
    """
    low = rule.whole * rule.percent // 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies in one task count once
        for (ids,), bounds, values in _map_sets(batches, rule.width, ["text_id"]):
            ids, sizes = ids.to_numpy(zero_copy_only=False), np.diff(bounds)
            new = np.zeros(len(ids), bool)
            for r, i in enumerate(ids.tolist()):
                if i not in seen:
                    seen.add(i)
                    new[r] = True
            place = np.arange(len(values)) - np.repeat(bounds[:-1], sizes)
            for tier in (0, 1):
                fits = new & (sizes <= rule.whole if tier == 0 else sizes >= max(low, rule.k))
                some = np.repeat(fits, sizes) & (place < (rule.whole if tier == 0 else rule.k))
                rows = np.repeat(np.arange(len(ids)), sizes)[some]
                for cut in range(0, len(rows), 100_000):
                    r = rows[cut : cut + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[r]),
                            pa.array(np.full(len(r), tier, np.int32)),
                            pa.array(sizes[r].astype(np.int32)),
                            pa.array(values[some][cut : cut + 100_000] ^ tier),
                        ],
                        ["text_id", "tier", "n", "v"],
                    )

    return texts.select("text_id", "text").mapInArrow(run, "text_id long, tier int, n int, v long")


# -------------------------------------------------------------- candidates


def kept_values(tier: Column, n: Column, rule: NearRule) -> Column:
    """How many values the sketch of a set of n has."""
    return F.when(tier == 0, n).otherwise(F.lit(rule.k))


def least_overlap(tier: Column, n: Column, m: Column, rule: NearRule) -> Column:
    """The least number of values that sketches of linked sets of sizes n and m share.

    Whole sets: exactly, p (n + m) / (100 + p).  Sketches share what the k
    smallest of the union hold in common, a draw without replacement from a
    union of at most 100/p of the larger set: its mean less ``slack`` standard
    errors.
    """
    p, k = rule.percent / 100, rule.k
    exact = F.ceil(rule.percent * (n + m) / (100 + rule.percent))
    left = F.greatest(F.lit(0.0), 1 - k * p / F.greatest(n, m))
    drawn = F.ceil(p * k - rule.slack * F.sqrt(k * p * (1 - p) * left))
    return F.when(tier == 0, exact).otherwise(drawn)


def index_entries(values: DataFrame, rule: NearRule) -> DataFrame:
    """(v, tier, text_id, n, i): the values under which each sketch is listed.

    i is the value's place among the sketch's values, rarest first.  Values of
    one text only come first and are not listed: they lead nowhere.
    """
    shared = repeated_keys(values, "v").withColumnRenamed("n", "texts")
    # a sketch has `whole` values at most, so these lists are bounded
    listed = (
        values.join(shared, "v")
        .groupBy("text_id", "tier")
        .agg(F.max("n").alias("n"), F.sort_array(F.collect_set(F.struct("texts", "v"))).alias("list"))
    )
    n, tier = F.col("n"), F.col("tier")
    size = kept_values(tier, n, rule)
    # the smallest requirement over all sizes that a partner can have
    p = rule.percent / 100
    least = F.when(tier == 0, F.ceil(p * n)).otherwise(least_overlap(tier, n / p, n / p, rule))
    first = size - F.size("list")
    room = F.greatest(F.lit(0), (size - least + 1 - first)).cast("int")
    return listed.select(
        "text_id", "tier", "n", first.alias("first"), F.posexplode_outer(F.slice("list", F.lit(1), room)).alias("at", "value")
    ).where(F.col("at").isNotNull()).select(
        F.col("value.v").alias("v"), "tier", "text_id", "n", (F.col("first") + F.col("at") + 1).cast("int").alias("i")
    )


def may_link(a: str, b: str, rule: NearRule) -> Column:
    """Sizes and places of two entries of one list allow a link."""
    na, nb, ia, ib, tier = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.i"), F.col(f"{b}.i"), F.col(f"{a}.tier")
    rest = F.least(kept_values(tier, na, rule) - ia, kept_values(tier, nb, rule) - ib) + 1
    return (100 * F.least(na, nb) >= rule.percent * F.greatest(na, nb)) & (rest >= least_overlap(tier, na, nb, rule))


def pair_of(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def pivot_pairs(entries: DataFrame, rule: NearRule) -> DataFrame:
    """(a, b): every list's members with the member that has the fewest rarer values."""
    pivots = (
        entries.groupBy("v", "tier")
        .agg(F.min(F.struct("i", "text_id", "n")).alias("p"), F.count(F.lit(1)).alias("members"))
        .where(F.col("members") > 1)
        .select("v", "tier", "p")
    )
    both = join_back(entries.select("v", "tier", F.struct("i", "text_id", "n", "tier").alias("e")), pivots, "v", "tier")
    pairs = both.where((F.col("e.text_id") != F.col("p.text_id")) & may_link("e", "p", rule))
    return pairs.select(*pair_of(F.col("e.text_id"), F.col("p.text_id"))).distinct()


def labelled(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """``entries`` with the root of each text, and the spread of roots and number of members of each list."""
    named = entries.join(roots.withColumnRenamed("node", "text_id"), "text_id", "left").withColumn(
        "root", F.coalesce("root", "text_id")
    )
    lists = named.groupBy("v", "tier").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members")
    )
    return join_back(named, lists.where(F.col("lo") != F.col("hi")).select("v", "tier", "members"), "v", "tier")


def size_band(n: Column) -> Column:
    """The number of a band of sizes, each 3% wide; sizes up to 33 have one each."""
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(1.03)) + F.lit(1e-9)).cast("int")


def partner_sizes(rule: NearRule) -> tuple[Column, Column]:
    """The sizes of the smaller sets that an entry (tier, n, i) may link with; none where the second is below the first.

    With whole sets the entry's place leaves n - i + 1 values to share at most,
    which bounds the sum of both sizes; a sketch's requirement depends on the
    larger set alone.
    """
    n, i, tier = F.col("n"), F.col("i"), F.col("tier")
    left = kept_values(tier, n, rule) - i + 1
    smallest = F.ceil(rule.percent * n / 100)
    sum_of_both = F.floor((100 + rule.percent) * left / rule.percent + F.lit(1e-9))
    fits = left >= least_overlap(tier, n, n, rule)
    largest = F.when(tier == 0, F.least(n, sum_of_both - n)).otherwise(F.when(fits, n).otherwise(0))
    return smallest, largest


def may_be_smaller(rule: NearRule) -> Column:
    """An entry's place allows a link with a set at least as large."""
    n, i, tier = F.col("n"), F.col("i"), F.col("tier")
    left = kept_values(tier, n, rule) - i + 1
    most = F.floor(100 * n / rule.percent)
    return left >= F.when(tier == 0, least_overlap(tier, n, n, rule)).otherwise(least_overlap(tier, most, most, rule))


def apart_pairs(mixed: DataFrame, rule: NearRule) -> DataFrame:
    """(a, b): pairs of a list that have different roots.

    The larger set of a pair looks for the smaller one in the bands of sizes
    that its own size and place leave open, so entries that cannot link for
    either do not meet, however long their list is.
    """
    entry = F.struct("text_id", "n", "i", "tier", "root")
    smallest, largest = partner_sizes(rule)
    bands = F.when(largest >= smallest, F.sequence(size_band(smallest), size_band(largest)))
    x = mixed.select("v", "tier", F.explode(bands).alias("band"), entry.alias("x"))
    y = mixed.where(may_be_smaller(rule)).select("v", "tier", size_band(F.col("n")).alias("band"), entry.alias("y"))
    smaller_last = F.struct("x.n", "x.text_id") > F.struct("y.n", "y.text_id")
    pairs = x.join(y, ["v", "tier", "band"]).where(
        smaller_last & (F.col("x.root") != F.col("y.root")) & may_link("x", "y", rule)
    )
    return pairs.select(*pair_of(F.col("x.text_id"), F.col("y.text_id"))).distinct()


def open_pairs(
    entries: DataFrame, roots: DataFrame, tested: DataFrame, texts: DataFrame, folder: str, rule: NearRule
) -> DataFrame:
    """(a, b): pairs that share a list, are in different components and have not been tested.

    The members of a list of over ``crowd`` are listed anew, among themselves
    and with whole sets: the exact requirement lets hardly a pair through that
    is not linked, where a sketch must allow for chance.  The lists are written
    once, since each is read several times.
    """
    spark = entries.sparkSession
    labelled(entries, roots).write.parquet(f"{folder}/mixed")
    mixed = spark.read.parquet(f"{folder}/mixed")
    crowded = F.col("members") > rule.crowd
    mixed.where(crowded).select("text_id").distinct().write.parquet(f"{folder}/crowd")
    whole = replace(rule, whole=(1 << 31) - 1)
    again = index_entries(retained_values(with_ids(texts, spark.read.parquet(f"{folder}/crowd"), "text_id"), whole), whole)
    again.write.parquet(f"{folder}/entries-whole")
    labelled(spark.read.parquet(f"{folder}/entries-whole"), roots).write.parquet(f"{folder}/mixed-whole")
    mixed_whole = spark.read.parquet(f"{folder}/mixed-whole")
    pairs = apart_pairs(mixed.where(~crowded), rule).unionByName(apart_pairs(mixed_whole, whole))
    return pairs.distinct().join(tested, ["a", "b"], "left_anti")


def verify(pairs: DataFrame, sets: DataFrame, rule: NearRule) -> DataFrame:
    """(a, b) of the pairs whose full sets are similar enough.

    The union sketch spares large sets the exact comparison; two sets that are
    kept whole are always compared exactly.
    """
    k, p = rule.k, rule.percent / 100
    of = lambda end: sets.select(F.col("text_id").alias(end), F.col("shingles").alias(f"set_{end}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    a, b = F.col("set_a"), F.col("set_b")
    # the k smallest of the union, and how many of them are in both
    heads = F.slice(F.array_sort(F.array_union(F.slice(a, 1, k), F.slice(b, 1, k))), 1, k)
    shared = F.size(F.array_intersect(heads, F.array_intersect(F.slice(a, 1, k), F.slice(b, 1, k))))
    size = F.size(heads)
    error = F.sqrt(size * p * (1 - p) + F.lit(0.0))
    whole = F.greatest(F.size(a), F.size(b)) <= rule.whole
    likely = whole | (shared >= p * size - rule.slack * error - 1)
    common = F.size(F.array_intersect(a, b))
    exact = 100 * common >= rule.percent * (F.size(a) + F.size(b) - common)
    return both.where(likely).where(exact).select("a", "b")


# ---------------------------------------------------------------- operator


def text_links(docs: DataFrame, rule: NearRule, text: str = "text") -> DataFrame:
    """(a, b): links between different texts that connect all linked texts.

    Every two linked texts are in one component of these links; links inside a
    component that is already connected are not listed.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark, "near")
    texts = docs.select(text_key(text).alias("text_id"), text_of(text).alias("text"))
    index_entries(retained_values(texts, rule), rule).write.parquet(f"{folder}/entries")
    entries = spark.read.parquet(f"{folder}/entries")
    # texts that share a list with another one; the others can have no link
    lists = entries.groupBy("v", "tier").agg(F.min("text_id").alias("lo"), F.max("text_id").alias("hi"))
    lists = lists.where(F.col("lo") != F.col("hi")).select("v", "tier")
    members = join_back(entries, lists, "v", "tier", how="left_semi")
    members.write.parquet(f"{folder}/members")
    members = spark.read.parquet(f"{folder}/members")
    members.select("text_id").distinct().write.parquet(f"{folder}/candidates")
    candidates = with_ids(texts, spark.read.parquet(f"{folder}/candidates"), "text_id")
    candidates.dropDuplicates(["text_id"]).write.parquet(f"{folder}/texts")
    candidates = spark.read.parquet(f"{folder}/texts")
    sets = full_sets(candidates, rule.width)
    pivot_pairs(members, rule).write.parquet(f"{folder}/pairs")
    tested = spark.read.parquet(f"{folder}/pairs")
    verify(tested, sets, rule).write.parquet(f"{folder}/links-1")
    links = spark.read.parquet(f"{folder}/links-1")
    left = open_pairs(members, components(links), tested, candidates, folder, rule)
    verify(left, sets, rule).write.parquet(f"{folder}/links-2")
    return links.unionByName(spark.read.parquet(f"{folder}/links-2"))


def text_groups(docs: DataFrame, rule: NearRule, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(text_id, component, chosen): the smallest id of each text's component, and the text that has it."""
    roots = components(text_links(docs, rule, text)).withColumnRenamed("node", "text_id")
    least = docs.select(text_key(text).alias("text_id"), F.col(key).alias("id")).groupBy("text_id").agg(F.min("id").alias("id"))
    named = least.join(roots, "text_id", "left").withColumn("root", F.coalesce("root", "text_id"))
    best = named.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_id")).alias("best"))
    return join_back(named, best, "root").select(
        "text_id", F.col("best.id").alias("component"), F.col("best.text_id").alias("chosen")
    )


def near_duplicates(docs: DataFrame, rule: NearRule = NearRule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, text_id, n_shingles, component_id, kept."""
    rows = docs.select(F.col(key).alias("id"), text_key(text).alias("text_id"), text_of(text).alias("text"))
    sized = with_set_sizes(rows, rule.width, ["id", "text_id"])
    groups = text_groups(docs, rule, key, text).select("text_id", "component")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component"))
    return join_back(sized, groups, "text_id", how="left").select(
        F.col("id").alias(key),
        "text_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def keep_one(docs: DataFrame, rule: NearRule = NearRule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns and one row of each group of near copies.

    The row of the smallest id stays (a null id only where the group has no
    other); of rows that repeat both id and text one stays.  Texts without
    words all stay.
    """
    groups = text_groups(docs, rule, key, text)
    chosen = groups.where(F.col("text_id") == F.col("chosen")).select("text_id", F.col("component").alias("id"))
    rows = docs.select(F.struct("*").alias("row"), text_key(text).alias("text_id"), F.col(key).alias("id"))
    worded = text_of(f"row.{text}").rlike(r"[^\x20\x09-\x0D]")
    r, c = rows.where(worded).alias("r"), chosen.alias("c")
    same = (F.col("r.text_id") == F.col("c.text_id")) & F.col("r.id").eqNullSafe(F.col("c.id"))
    first = r.join(c, same, "left_semi").dropDuplicates(["text_id", "id"])
    return first.select("row.*").unionByName(rows.where(~worded).select("row.*"))
