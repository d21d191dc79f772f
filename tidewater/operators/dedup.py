"""Keyed de-duplication and latest-row-per-key.

Both use ``row_number() == 1`` over the key: Catalyst plans a partial
``WindowGroupLimit`` before the shuffle, so every map task keeps at most one
row per key and a hot key cannot pile up in one reducer.
"""

from __future__ import annotations

import datetime as dt
import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _order(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row per key under ``order_by`` (ties broken by the order only).

    Put enough columns in ``order_by`` to make it total when the survivor
    must be reproducible.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order_by))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def drop_duplicate_keys(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """One row per key.

    Without ``order_by`` any survivor is kept (``dropDuplicates``: a hash
    aggregate with map-side combine).  With ``order_by`` the first row under
    that order survives, so re-running a batch keeps the same row.
    """
    if order_by is None:
        return df.dropDuplicates(list(keys))
    return top_one_per_key(df, keys, order_by)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str = "event_time",
    tie_break: Sequence[Column | str] = (),
) -> DataFrame:
    """Most recent row per key (NULL times sort last)."""
    return top_one_per_key(df, keys, [F.col(time_col).desc_nulls_last(), *tie_break])


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every key set, rows with a NULL key).

    A NULL key never matches in a merge, so such rows would be re-inserted by
    every batch; they go to a quarantine output instead.
    """
    any_null = None
    for k in keys:
        cond = F.col(k).isNull()
        any_null = cond if any_null is None else (any_null | cond)
    return df.filter(~any_null), df.filter(any_null)


def batch_days(batch: DataFrame, keys: Sequence[str], time_col: str = "event_time") -> tuple[list[dt.date], int]:
    """(days of the rows with every key set, number of rows with a NULL key), in one job.

    The days are literals for the caller, which prune exactly the partitions a
    batch touches; there are as many as the calendar has at most.
    """
    broken = functools.reduce(operator.or_, [F.col(k).isNull() for k in keys])
    days, n_bad = batch.select(F.collect_set(F.when(~broken, F.to_date(time_col))), F.count_if(broken)).first()
    return sorted(days), n_bad
