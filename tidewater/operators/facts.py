"""Fact load: resolve surrogate keys against the current dimensions,
denormalise device and country, add the calendar key and a row key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.functions.keys import content_row_key, random_row_key
from tidewater.functions.timefn import date_key
from tidewater.schemas import FACT, MEASUREMENT_FIELDS, WEATHER_FIELDS

FACT_COLUMNS = FACT.fieldNames()


def row_key(kind: str) -> Column:
    """``"uuid"``: random per row; ``"content"``: md5 of (device, event_time),
    reproducible so a replayed batch keeps its ids."""
    if kind == "uuid":
        return random_row_key()
    if kind == "content":
        return content_row_key("iot_device_id", "event_time")
    raise ValueError(f"unknown row key kind {kind!r}")


def current_rows(dim: DataFrame, *cols: str) -> DataFrame:
    return dim.filter(F.col("is_current") == F.lit(True)).select(*cols)


def fact_rows(resolved: DataFrame, row_key_kind: str = "uuid") -> DataFrame:
    """Project readings that already carry device_sk / country_sk /
    country_code into the fact layout."""
    return resolved.select(
        row_key(row_key_kind).alias("fact_sk"),
        date_key("event_time").alias("date_key"),
        "device_sk",
        "country_sk",
        "iot_device_id",
        "country_code",
        "event_time",
        "ingestion_time",
        *MEASUREMENT_FIELDS,
        *WEATHER_FIELDS,
    ).select(*[F.col(f.name).cast(f.dataType) for f in FACT.fields])


def load_fact(
    batch: DataFrame,
    dim_device: DataFrame,
    dim_country: DataFrame,
    row_key_kind: str = "uuid",
) -> DataFrame:
    """Fact rows for a (deduplicated) batch.

    The left join keeps readings whose device has no current row (keys NULL).
    Both current dimensions, one row per device each, are joined first, so the
    readings meet them in a single join, in which adaptive execution can split
    a hot device.  A device with two current rows is an error, not two facts.
    """
    dev = current_rows(dim_device, "iot_device_id", "device_sk")
    cty = current_rows(dim_country, "iot_device_id", "country_sk", "country_code")
    both = dev.join(cty, "iot_device_id", "full")
    one = F.assert_true(F.count(F.lit(1)) == 1, F.lit("a device has two current versions"))
    # Grouped by a struct, the keys don't count as dealt by device: an exchange
    # then stands right below the join, where skewed partitions can be split.
    keys = both.groupBy(F.struct("iot_device_id").alias("_k")).agg(
        *[F.first(c).alias(c) for c in ("device_sk", "country_sk", "country_code")], one.alias("_one")
    )
    keys = keys.select("_k.iot_device_id", "device_sk", "country_sk", "country_code", "_one")
    resolved = batch.join(keys, "iot_device_id", "left")
    return fact_rows(resolved.where(F.col("_one").isNull()), row_key_kind)


def load_fact_asof(
    batch: DataFrame,
    dim_device: DataFrame,
    dim_country: DataFrame,
    row_key_kind: str = "uuid",
    slot: str = "day",
    days: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Fact rows whose keys are those of the versions valid at event time.

    ``effective_start <= event_time < effective_end``, also for readings that
    come late; a reading before its device's first version keeps NULL keys.

    An as-of join without a range condition: versions and readings are laid
    out by time, and each reading takes the last version before it.  A device's
    time is cut into slots (``slot``: a unit of ``date_trunc``), and a version
    is copied into each slot that it overlaps and that has readings, so a
    device with a large part of all readings is many independent groups and a
    version pairs with no reading one by one.  ``days``: the first and the last
    day that readings may be of, if they are known; else a job finds them.
    """
    key, at = "iot_device_id", F.date_trunc(slot, F.col("event_time"))
    readings = batch.withColumn("_slot", at)
    slots = readings.select(key, "_slot").distinct()
    bounds = batch.agg(F.min("event_time"), F.max("event_time")).first() if days is None else (
        days[0], dt.datetime.combine(days[1], dt.time.max))
    if bounds[0] is None:
        return fact_rows(batch.withColumns({c: F.lit(None).cast("string") for c in ("device_sk", "country_sk", "country_code")}), row_key_kind)
    low, high = (F.date_trunc(slot, F.lit(b).cast("timestamp")) for b in bounds)

    def versions(dim: DataFrame, name: str, *columns: str) -> DataFrame:
        return dim.select(key, "effective_start", "effective_end", F.struct("effective_start", *columns).alias(name))

    # of both dimensions at once: rows at the time a version begins to hold in each slot
    both = versions(dim_device, "_device", "device_sk").unionByName(
        versions(dim_country, "_country", "country_sk", "country_code"), allowMissingColumns=True
    )
    first = F.greatest(F.date_trunc(slot, "effective_start"), low)
    last = F.least(F.coalesce(F.col("effective_end"), high), high)
    each = both.filter(last >= first).withColumn("_slot", F.explode(F.sequence(first, last, F.expr(f"INTERVAL 1 {slot}"))))
    here = each.join(slots, [key, "_slot"], "left_semi")
    placed = here.select(key, "_slot", F.greatest("effective_start", "_slot").alias("event_time"), "_device", "_country")
    rows = readings.withColumn("_reading", F.lit(True)).unionByName(placed, allowMissingColumns=True)
    # at one instant versions come before readings; of several the latest to start
    begins = F.greatest(F.col("_device.effective_start"), F.col("_country.effective_start"))
    order = Window.partitionBy(key, "_slot").orderBy("event_time", F.col("_reading").asc_nulls_first(), begins)
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = rows.withColumns({c: F.last(c, ignorenulls=True).over(before) for c in ("_device", "_country")})
    resolved = held.filter("_reading").withColumns({
        "device_sk": F.col("_device.device_sk"),
        "country_sk": F.col("_country.country_sk"),
        "country_code": F.col("_country.country_code"),
    })
    return fact_rows(resolved, row_key_kind)


def not_yet_loaded(new_facts: DataFrame, fact_table: DataFrame, touched: Column | None = None) -> DataFrame:
    """Drop rows (facts, or the readings that they are made of) whose (event_time, device) is already in the fact table.

    Guards against appending a re-delivered or retried batch twice; pass
    ``touched`` (a filter on the fact's day column) to scan only the days the
    batch covers.
    """
    existing = fact_table if touched is None else fact_table.filter(touched)
    return new_facts.join(existing.select("event_time", "iot_device_id"), ["event_time", "iot_device_id"], "left_anti")
