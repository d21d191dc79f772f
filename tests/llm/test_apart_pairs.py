"""Pairs of a list that are still apart: by bands of sizes, against every pair."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidewater.llm import minhash

SCHEMA = "v long, tier int, text_id long, n int, i int, root long, members long"


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_every_pair_that_may_link_is_listed(spark, percent):
    rule = minhash.NearRule(percent=percent, k=32, whole=64)
    rng = random.Random(percent)
    rows = []
    for v in range(6):
        for t in range(60):
            tier = v % 2
            n = rng.choice([1, 2, 3, 5, 8, 20, 21, 33, 34, 35, 60, 64] if tier == 0 else [40, 52, 64, 80, 100, 130, 400, 2000])
            rows.append((v, tier, t, n, rng.randint(1, max(1, (n if tier == 0 else 32) // 2)), rng.randint(0, 20), 60))
    table = spark.createDataFrame(rows, SCHEMA)
    got = {(r.a, r.b) for r in minhash.apart_pairs(table, rule).collect()}
    x, y = table.alias("x"), table.alias("y")
    meet = (F.col("x.v") == F.col("y.v")) & (F.col("x.text_id") < F.col("y.text_id")) & (F.col("x.root") != F.col("y.root"))
    want = x.join(y, meet & minhash.may_link("x", "y", rule)).select("x.text_id", "y.text_id").distinct().collect()
    assert got == {tuple(r) for r in want} and got


def test_templated_texts_under_the_threshold_do_not_meet(spark):
    """One list of 5,000 sets of five, whose second value is shared: no link is possible, no row is joined."""
    rule = minhash.NearRule(width=4)
    table = spark.range(5000).select(
        F.lit(1).cast("long").alias("v"), F.lit(0).alias("tier"), F.col("id").alias("text_id"), F.lit(5).alias("n"),
        F.lit(2).alias("i"), F.col("id").alias("root"), F.lit(5000).cast("long").alias("members"),
    )
    assert table.where(minhash.may_be_smaller(rule)).count() == 0
    assert minhash.apart_pairs(table, rule).count() == 0
