"""Raw landing: broker records -> JSON lines in the raw zone.

The payload is kept intact as text; the only additions are the raw zone's
directory partitions (ingestion day, device) taken from the payload.  The
file sink records committed files in its metadata log, so together with the
checkpoint a restarted query neither loses nor duplicates output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewater.schemas import KAFKA_RECORD
from tidewater.sources.envelope import decode_payload, landing_columns

# Directory levels of the raw zone.  Day only by default: a device level
# multiplies directories (and small files per micro-batch) by the device
# count, which costs ~50x in write time already at 150 devices and does not
# scale to millions.  The staging job never prunes on it (it tracks new files).
PARTITION_COLUMNS = ("ingestion_date",)
DEVICE_PARTITION_COLUMNS = ("ingestion_date", "iot_device_id")

# The payloads repeat their field names in every line.  Readers tell the codec by the
# file's ending; a file holds one task's lines of one day, so it needs no splitting.
RAW_CODEC = "gzip"


def kafka_source(spark: SparkSession, bootstrap: str, topic: str, starting_offsets: str = "earliest",
                 fail_on_data_loss: bool = False) -> DataFrame:
    """Broker topic as a stream (needs the Kafka connector on the classpath)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
    )


def record_file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stand-in broker: a directory of parquet files with the record schema."""
    reader = spark.readStream.schema(KAFKA_RECORD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def publish_records(records: DataFrame, bootstrap: str | None = None, topic: str | None = None,
                    path: str | None = None) -> None:
    """Write (key, value, partition) records to the broker, or as parquet
    files to ``path`` when no broker is given."""
    if bootstrap and topic:
        records.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save()
    elif path:
        records.write.mode("append").parquet(path)
    else:
        raise ValueError("give a broker (bootstrap, topic) or a path")


def raw_lines(records: DataFrame, partition_columns=PARTITION_COLUMNS) -> DataFrame:
    return landing_columns(decode_payload(records)).select("raw_json", *partition_columns)


def start_landing(records: DataFrame, raw_path: str, checkpoint: str, available_now: bool = False,
                  processing_time: str = "0 seconds", partition_columns=PARTITION_COLUMNS) -> StreamingQuery:
    """Land records as (compressed) JSON lines under ``ingestion_date=<day>`` directories
    (``DEVICE_PARTITION_COLUMNS`` adds a device level).  Each task writes one
    file per day it holds, so a micro-batch writes tasks x days files."""
    lines = raw_lines(records, partition_columns)
    writer = (
        lines.writeStream.format("json")
        .option("compression", RAW_CODEC)
        .option("path", raw_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_columns)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
