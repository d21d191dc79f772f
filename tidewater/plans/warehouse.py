"""The warehouse as a whole: bulk replay.

``replay`` computes all tables for a whole history of batches at once (one
windowed pass per dimension instead of one merge per batch) -- used for
backfills and as the reference for the incremental path, which is
``tidewater.streaming.pipeline.WarehouseJob``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.functions.geo import country_of
from tidewater.functions.keys import surrogate_key
from tidewater.operators import calendar, facts, scd2
from tidewater.operators.dedup import drop_duplicate_keys, latest_per_key, split_null_keys
from tidewater.schemas import DEDUP_KEYS

BATCH_COL = "_batch_ts"


@dataclass(frozen=True)
class Warehouse:
    staging: DataFrame
    dim_date: DataFrame
    dim_device: DataFrame
    dim_country: DataFrame
    fact: DataFrame
    #: Readings without event time or device, which no table takes.
    quarantine: DataFrame | None = None


DEDUP_ORDER = ("ingestion_time", "temp", "pressure", "humidity")


def _dedup_order() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in DEDUP_ORDER]


def dedup_batch(batch: DataFrame) -> DataFrame:
    """Within-batch de-duplication on (event_time, device); the earliest
    ingestion survives, remaining ties broken by the measured values."""
    return drop_duplicate_keys(batch, DEDUP_KEYS, _dedup_order())


# ---------------------------------------------------------------------------
# bulk replay


def weekly_batch(time_col: str = "event_time") -> Column:
    """Batch instant of a reading when the stream is cut into weekly batches:
    the end of its ISO week (Monday 00:00 of the next week)."""
    return F.date_trunc("week", F.col(time_col)) + F.expr("INTERVAL 7 DAYS")


def per_batch_states(readings: DataFrame, batch: Column) -> DataFrame:
    """Latest reading per (device, batch) with its device and country state.

    Ties on the event time are broken in de-duplication order, so the result
    is the same whether or not ``readings`` were de-duplicated first -- the
    state pass can then skip the de-duplication shuffle.
    """
    r = readings.withColumn(BATCH_COL, batch)
    latest = latest_per_key(r, ["iot_device_id", BATCH_COL], "event_time", tie_break=_dedup_order())
    return latest.select(
        "iot_device_id", BATCH_COL, *scd2.DEVICE.tracked,
        country_of("latitude", "longitude").alias("_c"),
    ).select("iot_device_id", BATCH_COL, *scd2.DEVICE.tracked, "_c.*")


def batch_versions(states: DataFrame) -> DataFrame:
    """(device, batch) -> device_sk, country_sk, country_code of the versions
    current after that batch: both dimensions in one window pass over the
    states (one shuffle by device; states are one row per device and batch)."""
    key = "iot_device_id"
    w = Window.partitionBy(key).orderBy(BATCH_COL)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.lag(F.col(BATCH_COL)).over(w).isNull()

    def changed(tracked):
        return first | scd2.any_changed([F.col(c) for c in tracked], [F.lag(F.col(c)).over(w) for c in tracked])

    flagged = states.select(
        key, BATCH_COL, "country_code",
        changed(scd2.DEVICE.tracked).alias("_dev_changed"),
        changed(scd2.COUNTRY.tracked).alias("_cty_changed"),
    )
    batch_ts = F.col(BATCH_COL).cast("timestamp")
    dev_start = F.last(F.when(F.col("_dev_changed"), batch_ts), ignorenulls=True).over(upto)
    # a struct is never NULL, so ignorenulls skips exactly the unchanged rows
    cty_open = F.last(F.when(F.col("_cty_changed"), F.struct(batch_ts.alias("s"), F.col("country_code").alias("c"))),
                      ignorenulls=True).over(upto)
    v = flagged.select(key, BATCH_COL, dev_start.alias("_dev_start"), cty_open.alias("_cty"))
    return v.select(
        key, BATCH_COL,
        surrogate_key(key, F.col("_dev_start").cast("string")).alias("device_sk"),
        surrogate_key(key, F.col("_cty.c"), F.col("_cty.s").cast("string")).alias("country_sk"),
        F.col("_cty.c").alias("country_code"),
    )


def replay(readings: DataFrame, batch: Column | None = None, row_key_kind: str = "content",
           deduplicate: bool = False) -> Warehouse:
    """All tables for a stream replayed as consecutive batches.

    ``batch`` maps a reading to the instant its batch is merged (default:
    weekly).  With ``deduplicate`` the readings are raw and de-duplicated
    here (earliest ingestion wins); otherwise they must be de-duplicated
    already.  Rows with a NULL key are returned as ``quarantine``.  Staging is the de-duplicated readings.

    Plan shape: per-(device, batch) states come from a partial top-1 before
    their shuffle (a hot device is cut to one row per task), the version
    table -- one row per device and batch -- from one window pass over them,
    and the readings meet it in a single equi-join: broadcast by AQE when its
    measured size allows, otherwise sort-merge with skew splitting.
    """
    batch = weekly_batch() if batch is None else batch
    raw, null_keys = split_null_keys(readings, DEDUP_KEYS)
    clean = dedup_batch(raw) if deduplicate else raw
    states = per_batch_states(raw, batch)
    dim_device = scd2.scd2_history(states.select("iot_device_id", BATCH_COL, *scd2.DEVICE.tracked), scd2.DEVICE, BATCH_COL)
    dim_country = scd2.scd2_history(states.select("iot_device_id", BATCH_COL, *scd2.COUNTRY.tracked), scd2.COUNTRY, BATCH_COL)
    resolved = clean.withColumn(BATCH_COL, batch).join(batch_versions(states), ["iot_device_id", BATCH_COL], "inner")
    fact = facts.fact_rows(resolved, row_key_kind)
    dim_date = calendar.calendar_rows(clean)
    return Warehouse(staging=clean, dim_date=dim_date, dim_device=dim_device, dim_country=dim_country, fact=fact,
                     quarantine=null_keys)
