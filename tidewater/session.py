"""Spark session factory and shared-storage helpers.

Everything the library computes is expressed against a ``SparkSession`` the
caller owns; this module only builds one with the settings the pipeline
relies on (UTC session zone, ANSI on, AQE with skew handling) and resolves
the shared checkpoint folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Split size and file compression the warehouse tables are declared with.
SPLIT_BYTES = 128 * 1024 * 1024
PARQUET_CODEC = "snappy"


def build_session(
    master: str | None = None,
    app_name: str = "tidewater",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session configured for the pipeline.

    On a cluster ``master`` is left to ``spark-submit``; tests pass
    ``local[*]``.  ``spark.checkpoint.dir`` is never overridden here: the
    cluster names a shared folder and :func:`checkpoint_dir` reads it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(SPLIT_BYTES),
        "spark.sql.parquet.compression.codec": PARQUET_CODEC,
        # the default type of timestamps has no minima and maxima in file footers
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # a long-running job checkpoints dimensions every micro-batch; drop
        # checkpoint files once their DataFrame is garbage collected
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    ``fallback`` is used only when the session has none (tests); the folder
    is then registered with the SparkContext so ``DataFrame.checkpoint``
    works.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never node-local)."""
    base = checkpoint_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_local_fallback(spark: SparkSession) -> None:
    """Make checkpoints usable: the folder named by ``spark.checkpoint.dir``,
    or, only where every task runs in this process, one of our own."""
    if spark.conf.get("spark.checkpoint.dir", None):
        checkpoint_dir(spark)
        return
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="run-", dir="/tmp"))
