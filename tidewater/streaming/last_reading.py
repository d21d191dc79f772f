"""Each device's last reading of a metric that isn't NULL, kept as a stream.

The state of a device is one (time, value), whatever its history; it is keyed
state of the stream, so a restart from the checkpoint goes on with it.  A
reading changes it only if it is newer, in whatever order readings come; of two
at one time the larger value counts.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewater.functions.measures import metric_value
from tidewater.sources.tables import TableStore

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Times are microseconds since the epoch, which have no zone to be read in.
STATE, OUTPUT = "at long, value double", "iot_device_id int, at long, value double"


class LastReading(StatefulProcessor):
    """Emits a device's (time, value) when a micro-batch changes it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", STATE)

    def handleInputRows(self, key, rows, timer_values) -> Iterator[Row]:
        held = self.last.get() if self.last.exists() else None
        before = None if held is None else (held[0], held[1])
        newest = max(((r["at"], r["value"]) for r in rows), default=None)
        if newest is not None and (before is None or newest > before):
            self.last.update(newest)
            yield Row(iot_device_id=key[0], at=newest[0], value=newest[1])

    def close(self) -> None:
        pass


def start_last_not_null(readings: DataFrame, metric: str | Column, store: TableStore, checkpoint: str,
                        available_now: bool = True, processing_time: str = "1 minute") -> StreamingQuery:
    """Keep ``device_last`` of ``store`` at each device's last reading of a metric.

    Before the state a micro-batch is cut to a device's readings that have the
    metric; what it changes replaces the device's row, in its bucket only.
    """
    store.ensure_all()
    spark = store.spark
    value = metric_value(metric) if isinstance(metric, str) else metric
    at = F.unix_micros(F.col("event_time").cast("timestamp"))
    rows = readings.select("iot_device_id", at.alias("at"), value.cast("double").alias("value")).dropna()
    changed = rows.groupBy("iot_device_id").transformWithState(LastReading(), OUTPUT, "Update", "None")

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("event_time", F.timestamp_micros("at")).drop("at").persist()
        try:
            buckets = [r[0] for r in batch.select(store.bucket_of("iot_device_id")).distinct().collect()]
            if buckets:
                kept = store.read_buckets("device_last", buckets).join(batch, "iot_device_id", "left_anti")
                store.overwrite_days("device_last", kept.unionByName(batch))
        finally:
            batch.unpersist()

    writer = changed.writeStream.outputMode("update").foreachBatch(replace).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # the stream takes the setting when it starts
    try:
        return writer.start()
    finally:
        spark.conf.set(PROVIDER, before)
