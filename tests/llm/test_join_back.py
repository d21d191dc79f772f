"""Results are joined back to rows so that a hot text can be split."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidewater.llm import chunk_dedup, decontaminate, prefix_free
from tidewater.llm.common import join_back


def sides_of_last_join(df) -> list[str]:
    """What stands below the sorts of the topmost sort-merge join of the plan."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    start = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    depth = lambda line: len(re.match(r"[\s:|+\-*]*", line)[0])
    below, own = [], depth(lines[start])
    children = [i for i in range(start + 1, len(lines)) if depth(lines[i]) == own + 3]
    for i in children[:2]:
        while "Sort [" in lines[i] or "Project" in lines[i]:
            i += 1
        below.append(lines[i])
    return below


@pytest.mark.parametrize("module", [chunk_dedup, prefix_free])
def test_an_exchange_stands_right_below_the_join(spark, module):
    docs = spark.createDataFrame([(i, "a text that many rows hold " * (1 + i % 3)) for i in range(30)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        results = module.dedup_texts(docs).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
        sides = sides_of_last_join(module.per_document(docs, results))
        assert len(sides) == 2 and all("Exchange hashpartitioning(_key" in s and "ENSURE_REQUIREMENTS" in s for s in sides), sides
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_contaminated_texts_are_joined_back_the_same_way(spark):
    words = " ".join(f"word{i}" for i in range(20))
    docs = spark.createDataFrame([(i, words if i % 2 else "clean") for i in range(30)], "doc_id long, text string")
    items = spark.createDataFrame([("a", words)], "item_id string, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for found in (decontaminate.report(docs, items), decontaminate.remove_contaminated(docs, items)):
            sides = sides_of_last_join(found)
            assert len(sides) == 2 and all("Exchange hashpartitioning(_key" in s for s in sides), sides
        assert sorted(r.doc_id for r in decontaminate.remove_contaminated(docs, items).collect()) == list(range(0, 30, 2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_join_back_keeps_rows_and_columns(spark):
    rows = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, 9)], "id long, text_id long")
    results = spark.createDataFrame([(7, "a"), (8, None)], "text_id long, x string")
    found = join_back(rows, results, "text_id")
    assert found.columns == ["id", "text_id", "x"]
    assert sorted(map(tuple, found.collect()), key=str) == [(1, 7, "a"), (2, 7, "a"), (3, 8, None)]
    whole = join_back(rows, results, "text_id", how="left")
    assert sorted(map(tuple, whole.collect()), key=str) == [(1, 7, "a"), (2, 7, "a"), (3, 8, None), (4, 9, None)]
    assert [tuple(r) for r in join_back(rows, results.select("text_id"), "text_id", how="left_anti").collect()] == [(4, 9)]
