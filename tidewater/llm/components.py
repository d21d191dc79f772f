"""Connected components of a link table by alternating star contraction.

Each round hangs every node's larger neighbours, then its smaller ones, below
the smallest node it knows; the number of rounds grows with the logarithm of
the longest chain.  Minima are taken by grouped aggregation (combined before
the shuffle) and joined back so that adaptive execution can split a node with
very many links; each round is cut off with ``checkpoint()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import join_back, prepare_checkpoints


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the component's smallest node.

    Links are undirected; loops, repeats and nulls are ignored.
    """
    prepare_checkpoints(links.sparkSession)
    edges = (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
        .checkpoint()
    )
    state = None
    while True:
        # large star: the larger neighbours of u go below the smallest neighbour of u (or u itself)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            join_back(both.where(F.col("v") > F.col("u")), low, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        # small star: u and its smaller neighbours go below the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = join_back(large, low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
