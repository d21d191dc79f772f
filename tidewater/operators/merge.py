"""MERGE semantics as DataFrame algebra.

Each function returns DataFrames (the rows to write, or the new table state);
writing them is the job of ``tidewater.sources.tables``.  Keys are compared
with ``=``, so a NULL key never matches -- split such rows off first
(``dedup.split_null_keys``).

Scale notes: the anti-join against the target is the only shuffle.  Pass
``target_filter`` (e.g. the batch's day range) so the target scan is pruned to
the partitions the batch can touch instead of reading the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def _prune(target: DataFrame, target_filter: Column | None) -> DataFrame:
    return target if target_filter is None else target.filter(target_filter)


def rows_to_insert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    target_filter: Column | None = None,
) -> DataFrame:
    """``WHEN NOT MATCHED THEN INSERT *``: source rows whose key is absent."""
    existing = _prune(target, target_filter).select(*keys)
    return source.join(existing, list(keys), "left_anti")


def insert_if_absent(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    target_filter: Column | None = None,
) -> DataFrame:
    """New table state after an insert-only merge."""
    new_rows = rows_to_insert(target, source, keys, target_filter).select(*target.columns)
    return target.unionByName(new_rows)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *``.

    Target rows whose key appears in the source are replaced by the source
    row; others are kept.  The source must be unique on ``keys``.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def rows_without_match(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    target_condition: Column | None = None,
) -> DataFrame:
    """``WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.k = s.k AND cond)``."""
    return source.join(_prune(target, target_condition).select(*keys), list(keys), "left_anti")
