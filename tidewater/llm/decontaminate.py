"""Benchmark decontamination by exact n-gram windows, in DataFrame expressions only.

A benchmark item's windows are its runs of 13 consecutive normalised words (an
item of fewer words is one window).  Windows are broadcast as a hash set; each
document's own windows are hashed, probed against it, and every hash hit is
verified word by word.  All document words inside verified windows are hit.

Scale: documents are only scanned.  Probing happens inside the scan's stage
and hits (few) are grouped by text, so no text is shuffled.  A broadcast set
holds ``max_windows`` windows at most; a larger benchmark is probed in that
many blocks, each a scan of its own.

Defined results: a null or empty text has no words and no hits; an item
without words has no window; an item whose id is null makes words hit but is
not listed or counted; an item id that is repeated counts once; a window that
several items share counts for each; repeated documents get equal results; an
empty benchmark leaves every document clean.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import join_back, text_key, text_of

# Fixed by the contract: what separates words once A-Z are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Normalised words.  lower() would also change letters beyond A-Z, so it serves ASCII texts only."""
    lowered = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def windows_of(words: Column, length: int | Column) -> Column:
    """All runs of ``length`` words, as arrays."""
    length = F.lit(length) if isinstance(length, int) else length
    starts = F.sequence(F.lit(1), F.size(words) - length + 1)
    runs = F.transform(starts, lambda i: F.slice(words, i, length))
    return F.when(F.size(words) >= length, runs).otherwise(F.array().cast("array<array<string>>"))


def benchmark_windows(benchmark: DataFrame, length: int = 13) -> DataFrame:
    """(n, gram, items): every distinct window of n words, with the ids of its items as strings."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(text_of()).alias("words"))
    runs = F.explode_outer(windows_of(F.col("words"), F.least(F.lit(length), F.size("words"))))
    grams = words.select("item", runs.alias("gram")).where(F.size("gram") > 0)
    return grams.groupBy("gram").agg(F.collect_set("item").alias("items")).select(F.size("gram").alias("n"), "gram", "items")


def with_window_hashes(df: DataFrame, n: int, words: str = "words", into: str = "hashes") -> DataFrame:
    """``df`` with the hash of every run of n words (none if there are fewer).

    Hashes of runs are joined pairwise: 1, 2, 4, ... words, then two
    overlapping runs make one of n.  Every step is a projection of its own and
    reads array items by position, in constant time; slice() inside a lambda
    would copy the whole array for each window.
    """
    df = df.withColumn(into, F.transform(words, lambda w: F.xxhash64(w)))
    width = 1
    while width < n:
        step = min(width, n - width)
        firsts = F.slice(into, 1, F.greatest(F.size(into) - step, F.lit(0)))
        df = df.withColumn(into, F.transform(firsts, lambda x, i: F.xxhash64(x, F.get(into, i + step))))
        width += step
    return df


def find_hits(docs: DataFrame, benchmark: DataFrame, length: int = 13, max_windows: int = 200_000) -> DataFrame:
    """(text_id, n_hit, items): one row per distinct text that holds a window of an item."""
    windows = benchmark_windows(benchmark, length)
    # at most `length` rows: how many windows there are of each length
    counts = {r["n"]: r["count"] for r in windows.groupBy("n").count().collect()}
    texts = docs.select(text_key().alias("text_id"), words_of(text_of()).alias("words"))
    found = []
    for n, count in sorted(counts.items()):
        # the outer form keeps the optimizer from repeating the hashing in a filter below
        probes = with_window_hashes(texts, n).select("text_id", "words", F.posexplode_outer("hashes").alias("at", "hash"))
        # not written as an equality: that would become a join key, computed for every window of every text
        same = F.array_contains(F.array(F.slice("words", F.col("at") + 1, n)), F.col("gram"))
        blocks = math.ceil(count / max_windows)
        for block in range(blocks):
            part = windows.where((F.size("gram") == n) & (F.pmod(F.xxhash64("gram"), F.lit(blocks)) == block))
            hash_of = F.coalesce(F.get("hashes", F.lit(0)), F.lit(0))  # never null, so no filter repeats it below
            keyed = with_window_hashes(part, n, "gram").select(hash_of.alias("hash"), "gram", "items")
            # max_windows windows of `length` words at most
            hit = probes.join(F.broadcast(keyed), "hash").where(same)
            found.append(hit.select("text_id", "at", F.lit(n).alias("n"), "items"))
    if not found:
        return docs.limit(0).select(
            text_key().alias("text_id"), F.lit(0).alias("n_hit"), F.array().cast("array<string>").alias("items")
        )
    hits = reduce(DataFrame.unionByName, found)
    # bounded by the text: its windows, and the items that share one
    covered = F.flatten(F.collect_set(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)))
    return hits.groupBy("text_id").agg(
        F.size(F.array_distinct(covered)).alias("n_hit"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")
    )


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """The contract's rule: at least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(docs: DataFrame, benchmark: DataFrame, length: int = 13, key: str = "doc_id") -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, item_ids (sorted strings), contaminated."""
    hits = find_hits(docs, benchmark, length)
    sizes = docs.select(key, text_key().alias("text_id"), F.size(words_of(text_of())).cast("long").alias("n_words"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    items = F.coalesce(F.array_sort("items"), F.array().cast("array<string>"))
    return join_back(sizes, hits, "text_id", how="left").select(
        key,
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("item_ids"),
        is_contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, length: int = 13) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    hits = find_hits(docs, benchmark, length)
    sizes = docs.select(text_key().alias("text_id"), F.size(words_of(text_of())).alias("n_words"))
    # n_words belongs to the text, so the flagged texts alone decide
    bad = is_contaminated(F.col("n_hit"), F.col("n_words"))
    flagged = join_back(sizes, hits, "text_id").where(bad).select("text_id").distinct()
    rows = docs.select(F.struct("*").alias("row"), text_key().alias("text_id"))
    return join_back(rows, flagged, "text_id", how="left_anti").select("row.*")
