"""Hourly rollup of the fact table and its upsert.

Aggregation is two-level so the heavy pass stays a hash aggregate with
map-side combine:

1. group by (hour, device, country) -> per-metric sum and count plus the
   latest event time (fixed-width buffers only: HashAggregate);
2. group the reduced rows by (hour, device): add sums and counts, and take
   the country of the latest event (``max_by`` on a string plans as a sort
   aggregate, cheap on the already reduced rows).

Grouping by (hour, device) -- the merge key -- means a device that changes
country inside an hour yields one row, not two conflicting ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.functions.timefn import hour_bucket
from tidewater.operators.merge import upsert
from tidewater.schemas import HOURLY, HOURLY_AVG_SOURCES, HOURLY_KEYS

DEFAULT_LOOKBACK = "2 HOURS"


def window_start(as_of: Column, lookback: str = DEFAULT_LOOKBACK) -> Column:
    """Start of the recomputed range: ``date_trunc('hour', as_of - lookback)``."""
    return F.date_trunc("hour", as_of - F.expr(f"INTERVAL {lookback}"))


def hourly_rollup(fact: DataFrame, since: Column | None = None, hour: Column | None = None) -> DataFrame:
    """Hourly averages per device over facts with ``event_time >= since``
    (all facts when ``since`` is None).

    ``hour`` is the hour of the event time where the facts have it as a column:
    facts that are dealt by it and the device are then not dealt again.
    """
    src = fact if since is None else fact.filter(F.col("event_time") >= since)
    hour = hour_bucket("event_time") if hour is None else hour
    first = src.groupBy(
        hour.alias("hour_bucket"), "iot_device_id", "country_code"
    ).agg(
        F.max("event_time").alias("_last"),
        *[F.sum(F.col(c).cast("double")).alias(f"_s_{c}") for c in HOURLY_AVG_SOURCES],
        *[F.count(c).alias(f"_n_{c}") for c in HOURLY_AVG_SOURCES],
    )
    second = first.groupBy(*HOURLY_KEYS).agg(
        F.max_by("country_code", "_last").alias("country_code"),
        *[
            F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_n_{c}")).alias(f"avg_{c}")
            for c in HOURLY_AVG_SOURCES
        ],
    )
    return second.select(*[F.col(f.name).cast(f.dataType) for f in HOURLY.fields])


def hourly_rollup_by_country(fact: DataFrame, since: Column | None = None) -> DataFrame:
    """The single-pass form grouping by (hour, device, country) -- what a
    three-key GROUP BY gives; one row per country a device reported from."""
    src = fact if since is None else fact.filter(F.col("event_time") >= since)
    return src.groupBy(
        hour_bucket("event_time").alias("hour_bucket"), "iot_device_id", "country_code"
    ).agg(*[F.avg(F.col(c).cast("double")).alias(f"avg_{c}") for c in HOURLY_AVG_SOURCES]).select(
        *[F.col(f.name).cast(f.dataType) for f in HOURLY.fields]
    )


def refresh_hourly(
    existing: DataFrame,
    fact: DataFrame,
    as_of: Column,
    lookback: str = DEFAULT_LOOKBACK,
) -> DataFrame:
    """New rollup state: recompute the trailing window and upsert it by
    (hour, device).  Hours before the window keep their stored values."""
    recomputed = hourly_rollup(fact, window_start(as_of, lookback))
    return upsert(existing, recomputed, HOURLY_KEYS)


def touched_hours(batch: DataFrame) -> DataFrame:
    """Distinct (hour, device) pairs a batch wrote -- recompute exactly these
    to absorb late data of any age."""
    return batch.select(hour_bucket("event_time").alias("hour_bucket"), "iot_device_id").distinct()


def refresh_hours(fact: DataFrame, hours: DataFrame) -> DataFrame:
    """Recomputed rollup rows for exactly the given (hour, device) pairs
    (a semi join on the distinct pairs).  The join deals the facts by hour and
    device, and the rollup stays on these parts: a pair has a row a second at most."""
    src = fact.withColumn("_hb", hour_bucket("event_time")).join(
        hours.withColumnRenamed("hour_bucket", "_hb"), ["_hb", "iot_device_id"], "left_semi"
    )
    return hourly_rollup(src, hour=F.col("_hb"))


def refresh_touched(existing: DataFrame, fact: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert the rollup for every (hour, device) the batch touched."""
    return upsert(existing, refresh_hours(fact, touched_hours(batch)), HOURLY_KEYS)


# --- distinct devices ---------------------------------------------------------

#: Registers of a sketch as a power of two, and the relative standard error that this gives.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def device_sketches(fact: DataFrame) -> DataFrame:
    """Sketch of the distinct devices of each hour and country; unions of
    sketches stand for unions of rows, so any span of hours and any choice of
    countries is answered from these."""
    return fact.groupBy(hour_bucket("event_time").alias("hour_bucket"), "country_code").agg(
        F.hll_sketch_agg("iot_device_id", SKETCH_BITS).alias("devices"), F.count(F.lit(1)).alias("n_events")
    )


def refresh_sketches(existing: DataFrame, fact: DataFrame, hours: DataFrame) -> DataFrame:
    """New sketch table state: those of the given hours made anew, whole, from the facts."""
    touched = hours.select("hour_bucket").distinct()
    rows = fact.withColumn("hour_bucket", hour_bucket("event_time")).join(touched, "hour_bucket", "left_semi")
    return existing.join(touched, "hour_bucket", "left_anti").unionByName(device_sketches(rows.drop("hour_bucket")))
