"""Raw zone -> flattened readings, handed to a per-batch callback.

The raw zone is read as a file stream with its fixed one-column schema.
Spark appends the directory partition columns it discovers; ``flatten``
selects only what it parses from ``raw_json``, so they never leak through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewater.schemas import RAW_FILE
from tidewater.sources.envelope import flatten


def stream_name(spark: SparkSession) -> str | None:
    """Inside ``foreachBatch``: the id of the running stream, which a restart
    from its checkpoint keeps and a new checkpoint changes; else None."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def raw_source(spark: SparkSession, raw_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("json").schema(RAW_FILE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(raw_path)


def start_staging(spark: SparkSession, raw_path: str, checkpoint: str,
                  on_batch: Callable[[DataFrame, int], None], available_now: bool = True,
                  processing_time: str = "1 minute", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Flatten each micro-batch and call ``on_batch(batch_df, batch_id)``.

    ``foreachBatch`` is at-least-once: a batch may be replayed after a
    failure, so ``on_batch`` must be idempotent (the warehouse job is).
    """
    flat = flatten(raw_source(spark, raw_path, max_files_per_trigger))
    writer = flat.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
