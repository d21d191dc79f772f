"""Slowly changing dimension, type 2.

Two forms with the same result:

* :func:`scd2_merge` -- incremental, one micro-batch against the current
  dimension: (1) close current rows whose tracked attributes changed,
  ``effective_end`` = the batch's ``effective_start``; (2) insert a new
  current version for every staged key without a current row after step 1.
  Keys absent from the batch are untouched; nothing is deleted.
* :func:`scd2_history` -- bulk, builds every version from per-(key, batch)
  states in one window pass (backfills, replays, and the oracle for the
  incremental form).

A state that arrives late, by event time, can split a version, move the start
of one, or join two equal neighbours' states.  A version alone doesn't tell: it
hides at which times its state was seen again.  So the states themselves are
kept (``logged_states``), and the versions of the keys that have a late one
(``late_keys``) are built anew from all their states; the result is that of
``scd2_history`` whatever order batches come in.

Change detection is NULL-safe: a value turning into NULL or back is a change.
Every batch carries one literal ``batch_ts``, so the closing and the opening
row of a change share the same instant and versions are contiguous.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.functions.geo import country_of
from tidewater.functions.keys import surrogate_key
from tidewater.operators.dedup import latest_per_key
from tidewater.schemas import DIM_COUNTRY, DIM_DEVICE


@dataclass(frozen=True)
class Scd2Spec:
    key: str
    tracked: tuple[str, ...]
    sk_col: str
    sk_parts: tuple[str, ...]  # hashed together with effective_start, in order
    columns: tuple[str, ...]
    start: str = "effective_start"
    end: str = "effective_end"
    current: str = "is_current"


DEVICE = Scd2Spec(
    key="iot_device_id",
    tracked=("latitude", "longitude", "timezone"),
    sk_col="device_sk",
    sk_parts=("iot_device_id",),
    columns=tuple(DIM_DEVICE.fieldNames()),
)
COUNTRY = Scd2Spec(
    key="iot_device_id",
    tracked=("country_code", "country_name", "city"),
    sk_col="country_sk",
    sk_parts=("iot_device_id", "country_code"),
    columns=tuple(DIM_COUNTRY.fieldNames()),
)


def any_changed(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True when any pair differs, NULL-safely."""
    return functools.reduce(operator.or_, [~a.eqNullSafe(b) for a, b in zip(left, right)])


def _sk(spec: Scd2Spec, start: Column) -> Column:
    return surrogate_key(*[F.col(p) for p in spec.sk_parts], start.cast("string"))


def _ts(batch_ts) -> Column:
    return batch_ts if isinstance(batch_ts, Column) else F.lit(batch_ts).cast("timestamp")


# ---------------------------------------------------------------------------
# staging: one row per key from a batch


def device_states(batch: DataFrame, time_col: str = "event_time", keep_time: bool = False) -> DataFrame:
    """Latest reading per device: key + tracked device attributes (+ its
    time as ``_state_time`` with ``keep_time``)."""
    latest = latest_per_key(batch, [DEVICE.key], time_col)
    extra = [F.col(time_col).cast("timestamp").alias("_state_time")] if keep_time else []
    return latest.select(DEVICE.key, *DEVICE.tracked, *extra)


def country_states(batch: DataFrame, time_col: str = "event_time", boxes=None, keep_time: bool = False) -> DataFrame:
    """Latest reading per device resolved to its country (native lookup)."""
    states = in_country(device_states(batch, time_col, keep_time=True), boxes)
    return states if keep_time else states.drop("_state_time")


def in_country(states: DataFrame, boxes=None) -> DataFrame:
    """Device states (with their time) resolved to countries."""
    c = country_of("latitude", "longitude") if boxes is None else country_of("latitude", "longitude", boxes)
    return states.select(COUNTRY.key, c.alias("_c"), "_state_time").select(COUNTRY.key, "_c.*", "_state_time")


def logged_states(states: DataFrame) -> DataFrame:
    """Device states (with their time) as rows of the log of states."""
    return states.select(DEVICE.key, F.col("_state_time").alias("state_time"), *DEVICE.tracked)


def tracked_states(log: DataFrame, spec: Scd2Spec) -> DataFrame:
    """States of a dimension (with ``_state_time``) from rows of the log of
    states.  Of several states of a device at one time the smallest counts, so
    the result doesn't depend on the order they came in."""
    once = log.groupBy(DEVICE.key, "state_time").agg(F.min(F.struct(*DEVICE.tracked)).alias("_s"))
    states = once.select(DEVICE.key, "_s.*", F.col("state_time").alias("_state_time"))
    return in_country(states) if spec is COUNTRY else states


def late_keys(log: DataFrame, states: DataFrame, key: str = DEVICE.key) -> DataFrame:
    """Keys of ``states`` whose state isn't newer than all in the log."""
    newest = log.groupBy(key).agg(F.max("state_time").alias("_newest"))
    return states.join(newest, key).filter(F.col("state_time") <= F.col("_newest")).select(key)


def stage_versions(states: DataFrame, spec: Scd2Spec, batch_ts=None, effective_from: str = "batch") -> DataFrame:
    """Turn one-row-per-key states into candidate dimension rows.

    ``effective_from="batch"`` (default): every version starts at the batch
    instant ``batch_ts`` -- arrival order.  ``"event_time"``: a version starts
    at the time of the reading that produced it (``states`` from
    ``device_states(..., keep_time=True)``), so a late batch is placed where
    it belongs in time; pair it with ``scd2_merge(..., ignore_older=True)``.
    """
    if effective_from == "event_time":
        start = F.col("_state_time")
    elif effective_from == "batch":
        start = _ts(batch_ts)
    else:
        raise ValueError(f"effective_from must be 'batch' or 'event_time', not {effective_from!r}")
    return (
        states.withColumn(spec.start, start)
        .withColumn(spec.sk_col, _sk(spec, F.col(spec.start)))
        .withColumn(spec.end, F.lit(None).cast("timestamp"))
        .withColumn(spec.current, F.lit(True))
        .select(*spec.columns)
    )


# ---------------------------------------------------------------------------
# incremental merge


def scd2_merge(dim: DataFrame, stage: DataFrame, spec: Scd2Spec, ignore_older: bool = False) -> DataFrame:
    """New dimension state after merging one staged batch (see module doc).

    ``stage`` must hold one row per key (``stage_versions`` output).  With
    ``ignore_older`` a staged row that does not start after the key's current
    version is ignored, so a late batch cannot replace a newer state.
    """
    cur = dim.filter(F.col(spec.current) == F.lit(True))
    history = dim.filter(~F.coalesce(F.col(spec.current), F.lit(False)))
    if ignore_older:
        stage = newer_states(cur, stage, spec)
    closed, current = scd2_changes(cur, stage, spec)
    return history.select(*spec.columns).unionByName(closed).unionByName(current)


def newer_states(cur: DataFrame, stage: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Staged rows that start after their key's current version, or have none."""
    starts = cur.select(spec.key, F.col(spec.start).alias("_cur_start"))
    joined = stage.join(starts, spec.key, "left")
    return joined.filter(F.col("_cur_start").isNull() | (F.col(spec.start) > F.col("_cur_start"))).select(*spec.columns)


def scd2_changes(cur: DataFrame, stage: DataFrame, spec: Scd2Spec) -> tuple[DataFrame, DataFrame]:
    """(versions that the staged batch closes, the current versions after it).

    ``cur`` holds the current versions of any set of keys that has the staged
    ones, so a store merges the buckets that a batch changes and leaves the rest.
    """
    s = stage.select(
        spec.key,
        F.col(spec.start).alias("_s_start"),
        *[F.col(c).alias(f"_s_{c}") for c in spec.tracked],
    )
    matched = cur.join(s, spec.key, "left")
    closes = F.col("_s_start").isNotNull() & any_changed(
        [F.col(c) for c in spec.tracked], [F.col(f"_s_{c}") for c in spec.tracked]
    )
    instead = {spec.end: F.col("_s_start"), spec.current: F.lit(False)}
    closed = matched.filter(closes).select(*[instead.get(c, F.col(c)).alias(c) for c in spec.columns])
    kept = matched.filter(~closes).select(*spec.columns)
    opened = stage.join(kept.select(spec.key), spec.key, "left_anti").select(*spec.columns)
    return closed, kept.unionByName(opened)


def changing_keys(dim: DataFrame, stage: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Staged keys that would open a version: no current row yet, or a
    tracked attribute differs (NULL-safe).  Empty means the merge is a no-op,
    so a writer can skip rewriting the dimension."""
    cur = dim.filter(F.col(spec.current) == F.lit(True)).select(
        spec.key, F.lit(True).alias("_has_current"), *[F.col(c).alias(f"_t_{c}") for c in spec.tracked]
    )
    j = stage.select(spec.key, *spec.tracked).join(cur, spec.key, "left")
    differs = any_changed([F.col(c) for c in spec.tracked], [F.col(f"_t_{c}") for c in spec.tracked])
    return j.filter(F.col("_has_current").isNull() | differs).select(spec.key)


# ---------------------------------------------------------------------------
# bulk history


def _flag_changes(states: DataFrame, spec: Scd2Spec, batch_col: str) -> DataFrame:
    w = Window.partitionBy(spec.key).orderBy(batch_col)
    first = F.lag(F.col(batch_col)).over(w).isNull()
    changed = any_changed([F.col(c) for c in spec.tracked], [F.lag(F.col(c)).over(w) for c in spec.tracked])
    return states.withColumn("_changed", first | changed)


def scd2_history(states: DataFrame, spec: Scd2Spec, batch_col: str) -> DataFrame:
    """Full dimension from states with one row per (key, batch).

    A version starts at each batch whose state differs from the key's
    previous state; it ends where the next version starts.
    """
    versions = _flag_changes(states, spec, batch_col).filter("_changed")
    w = Window.partitionBy(spec.key).orderBy(batch_col)
    nxt = F.lead(F.col(batch_col)).over(w)
    return (
        versions.withColumn(spec.start, F.col(batch_col).cast("timestamp"))
        .withColumn(spec.end, nxt.cast("timestamp"))
        .withColumn(spec.current, nxt.isNull())
        .withColumn(spec.sk_col, _sk(spec, F.col(spec.start)))
        .select(*spec.columns)
    )
