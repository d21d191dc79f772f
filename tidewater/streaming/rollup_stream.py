"""Streaming forms of the hourly rollup and of cross-batch de-duplication.

Both keep the readings in a table store and merge each micro-batch with the
stored days it covers, so nothing depends on a watermark: a reading that
arrives late, in any order, is kept, and one delivered twice is not.

* :func:`start_dedup` appends the readings whose key is not stored yet;
* :func:`start_hourly_upsert` does so too, then recomputes the (hour, device)
  pairs that the batch touched from the stored readings and replaces them.

* :func:`start_window_rollup` keeps the rollup with event-time window state
  instead: a watermark closes an hour, and only then its row is written.  Rows
  that come after their hour is closed are dropped by the window state, and
  none of them is lost: they are in the stored readings, and
  :func:`repair_hours` recomputes each hour whose stored readings are not those
  that its row was made of.

Of the first two a micro-batch costs a read of the days that it has readings of, and only of
these; a day between two of them is not touched.  Every step is idempotent.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.geo import country_of
from tidewater.functions.timefn import hour_bucket
from tidewater.operators import rollup
from tidewater.operators.dedup import batch_days, split_null_keys
from tidewater.operators.merge import rows_to_insert, upsert
from tidewater.plans.warehouse import dedup_batch
from tidewater.schemas import DEDUP_KEYS, HOURLY, HOURLY_AVG_SOURCES, HOURLY_KEYS
from tidewater.sources.tables import TableStore
from tidewater.streaming.staging import stream_name


def store_new(store: TableStore, batch: DataFrame, batch_id: int, source: str) -> list[dt.date]:
    """Append the batch's readings that are not stored yet to staging_events.

    Returns the days of its readings.  Readings without a key are set aside, in
    a folder named by stream and batch id.
    """
    good, bad = split_null_keys(batch, DEDUP_KEYS)
    days, n_bad = batch_days(batch, DEDUP_KEYS)
    if n_bad:
        bad.write.mode("overwrite").parquet(f"{store.root}/quarantine/source={source}/batch_id={batch_id}")
    if days:
        stored = store.read_days("staging_events", days)
        store.append("staging_events", rows_to_insert(stored, dedup_batch(good), DEDUP_KEYS))
    return days


def refresh_touched_hours(store: TableStore, batch: DataFrame, days: list[dt.date]) -> None:
    """Replace the rollup rows of the hours that ``batch`` touched, which lie
    in ``days``; other days are neither read nor written."""
    readings = store.read_days("staging_events", days)
    placed = readings.withColumn("country_code", country_of("latitude", "longitude").getField("country_code"))
    fresh = rollup.refresh_hours(placed, rollup.touched_hours(split_null_keys(batch, DEDUP_KEYS)[0]))
    existing = store.read_days("fact_hourly_agg", days)
    store.overwrite_days("fact_hourly_agg", upsert(existing, fresh, HOURLY_KEYS))


# --- event-time windows ------------------------------------------------------

NOTES = "window_notes"


def start_window_rollup(store: TableStore, checkpoint: str, delay: str = "2 hours", max_files: int | None = None,
                        available_now: bool = True, processing_time: str = "1 minute") -> StreamingQuery:
    """Roll the stored readings of ``store`` up to hours as a stream of its own.

    Reads the files that :func:`start_dedup` (with ``note_hours``) appends to
    staging_events, so a reading is counted once.  An hour's state is kept until
    the newest event time less ``delay`` passes its end.
    """
    store.ensure_all()
    files = store.spark.readStream.schema(store.stored_schema("staging_events"))
    if max_files:
        files = files.option("maxFilesPerTrigger", str(max_files))
    placed = files.parquet(store.path("staging_events")).withColumn(
        "country_code", country_of("latitude", "longitude").getField("country_code")
    )
    hour = F.window("event_time", "1 hour").alias("_hour")
    sums = [F.avg(F.col(c).cast("double")).alias(f"avg_{c}") for c in HOURLY_AVG_SOURCES]
    closed = (
        placed.withWatermark("event_time", delay)
        .groupBy(hour, "iot_device_id")
        .agg(F.max_by("country_code", "event_time").alias("country_code"), *sums, F.count(F.lit(1)).alias("n"))
        .select(F.col("_hour.start").alias("hour_bucket"), "iot_device_id", "country_code", *[f"avg_{c}" for c in HOURLY_AVG_SOURCES], "n")
    )

    def step(batch: DataFrame, batch_id: int) -> None:
        days = [r[0] for r in batch.select(F.to_date("hour_bucket")).distinct().collect()]
        if not days:
            return
        # noted first: if the rollup isn't written, a replay does both again
        _note(store, "closed", batch.select(*HOURLY_KEYS, "n"), batch_id)
        existing = store.read_days("fact_hourly_agg", days)
        store.overwrite_days("fact_hourly_agg", upsert(existing, batch, HOURLY_KEYS))

    return _start(closed, step, checkpoint, available_now, processing_time, "append")


def _note(store: TableStore, kind: str, hours: DataFrame, batch_id: int) -> None:
    path = f"{store.root}/{NOTES}/{kind}/source={stream_name(store.spark)}/batch_id={batch_id}"
    hours.write.mode("overwrite").parquet(path)


def repair_hours(store: TableStore) -> int:
    """Recompute the hours whose row doesn't stand for all stored readings;
    returns how many there were.

    Looks at the hours that readings were stored of, or that were closed, since
    the last call.  Of these it counts the stored readings; an hour that was
    closed with as many is left as it is.  Hours that are open yet have no row
    from the window state: they get one of the readings so far.
    """
    spark, base = store.spark, f"{store.root}/{NOTES}"
    notes = {k: [n for s in store.folders(f"{base}/{k}") for n in store.folders(s)] for k in ("closed", "touched")}
    if not notes["closed"] and not notes["touched"]:
        return 0
    schema = T.StructType([*(HOURLY[k] for k in HOURLY_KEYS), T.StructField("n", T.LongType())])
    read = lambda kind: spark.read.schema(schema).parquet(*notes[kind]) if notes[kind] else store.no_rows(schema)
    made_of = read("closed").groupBy(*HOURLY_KEYS).agg(F.max("n").alias("made_of"))
    looked_at = made_of.join(read("touched").select(*HOURLY_KEYS).distinct(), HOURLY_KEYS, "full").persist()
    try:
        days = sorted(r[0] for r in looked_at.select(F.to_date("hour_bucket")).distinct().collect())
        readings = store.read_days("staging_events", days)
        stored = readings.groupBy(hour_bucket("event_time").alias("hour_bucket"), "iot_device_id").agg(F.count(F.lit(1)).alias("n"))
        wrong = looked_at.join(stored, HOURLY_KEYS).filter(~F.col("n").eqNullSafe(F.col("made_of"))).select(*HOURLY_KEYS).persist()
        days = sorted(r[0] for r in wrong.select(F.to_date("hour_bucket")).distinct().collect())
        n = wrong.count() if days else 0
        if n:
            placed = store.read_days("staging_events", days).withColumn(
                "country_code", country_of("latitude", "longitude").getField("country_code")
            )
            existing = store.read_days("fact_hourly_agg", days)
            store.overwrite_days("fact_hourly_agg", upsert(existing, rollup.refresh_hours(placed, wrong), HOURLY_KEYS))
        wrong.unpersist()
    finally:
        looked_at.unpersist()
    for note in [*notes["closed"], *notes["touched"]]:
        store.delete_path(note)
    return n


def _start(readings: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str,
           available_now: bool, processing_time: str, mode: str = "append") -> StreamingQuery:
    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            step(batch, batch_id)
        finally:
            batch.unpersist()

    writer = readings.writeStream.foreachBatch(apply).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def start_hourly_upsert(readings: DataFrame, store: TableStore, checkpoint: str,
                        available_now: bool = True, processing_time: str = "1 minute") -> StreamingQuery:
    """Keep ``fact_hourly_agg`` of ``store`` equal to the rollup of all readings so far."""
    store.ensure_all()

    def step(batch: DataFrame, batch_id: int) -> None:
        days = store_new(store, batch, batch_id, stream_name(store.spark))
        if days:
            refresh_touched_hours(store, batch, days)
    return _start(readings, step, checkpoint, available_now, processing_time)


def start_dedup(readings: DataFrame, store: TableStore, checkpoint: str,
                available_now: bool = True, processing_time: str = "1 minute",
                note_hours: bool = False) -> StreamingQuery:
    """Keep ``staging_events`` of ``store`` at one row per reading, the first to arrive.

    ``note_hours`` notes the hours of what is stored for :func:`repair_hours`.
    """
    store.ensure_all()

    def step(batch: DataFrame, batch_id: int) -> None:
        days = store_new(store, batch, batch_id, stream_name(store.spark))
        if note_hours and days:
            _note(store, "touched", rollup.touched_hours(split_null_keys(batch, DEDUP_KEYS)[0]), batch_id)
    return _start(readings, step, checkpoint, available_now, processing_time)
