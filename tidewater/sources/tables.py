"""Warehouse tables on parquet: create, read, append, overwrite touched days.

Tables live under one root (``<root>/<name>``), are created from the schema
registry (``schemas.TABLES``), compressed with snappy, and -- for the
time-partitioned ones -- partitioned by a derived ``<col>_date`` column so a
filter on the day prunes directories and a rewrite touches only the days a
batch covers (dynamic partition overwrite).  Dimensions are dealt into buckets
by the hash of their key, current and closed versions apart.

A write never deletes rows before their replacement is complete.  A whole
table is written to a sibling folder, which takes the table's place by rename
(``overwrite``); days are staged by Spark's dynamic partition overwrite and
moved in when the job commits (``overwrite_days``).  Either may therefore be
computed from the table it replaces.  A run that stops between the two renames
is completed by the next access (``recover``).  One job writes a table at a
time.

Rows are redistributed by day before a partitioned write, so a day gets few
files however many tasks computed it; adaptive execution splits large days.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewater.schemas import TABLES
from tidewater.session import PARQUET_CODEC

SORT_ORDER = {
    "staging_events": ("event_time", "iot_device_id"),
    "fact_measurements": ("event_time", "iot_device_id"),
    "fact_hourly_agg": ("hour_bucket", "iot_device_id"),
}


#: Tables whose rows are dealt by the hash of a key, so that a merge rewrites only
#: the buckets it touches.  Dimensions keep their closed versions apart from the
#: current ones: those are appended to, these are few and replaced.
BUCKET_KEY = {"dim_iot_device": "iot_device_id", "dim_country": "iot_device_id", "dim_states": "iot_device_id", "device_last": "iot_device_id"}
VERSIONED = ("dim_iot_device", "dim_country")


def day_column(name: str) -> str | None:
    part = TABLES[name][1]
    return None if part is None else f"{part}_date"


def partition_fields(name: str) -> list[T.StructField]:
    """The folder levels of a table, outermost first."""
    if day_column(name):
        return [T.StructField(day_column(name), T.DateType(), True)]
    fields = [T.StructField("version", T.StringType(), True)] if name in VERSIONED else []
    return fields + ([T.StructField("bucket", T.IntegerType(), True)] if name in BUCKET_KEY else [])


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        """``buckets`` is a property of the stored tables: the same for every
        store over the same root."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    # -- layout ---------------------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self):
        jvm = self.spark._jvm
        hconf = self.spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(self.root)
        return p.getFileSystem(hconf), jvm.org.apache.hadoop.fs.Path

    def exists(self, name: str) -> bool:
        self.recover(name)
        fs, Path = self._fs()
        return bool(fs.exists(Path(self.path(name))))

    def recover(self, name: str) -> None:
        """Finish a replacement that stopped between its two renames, and a
        packing of files that stopped before its end."""
        fs, Path = self._fs()
        for folder in self.folders(self.path(name)):
            if folder.rsplit("/", 1)[1].startswith("_packing-") and fs.exists(Path(f"{folder}/old")):
                self._finish_packing(name, folder)
        table, new, old = Path(self.path(name)), Path(self.path(name) + ".new"), Path(self.path(name) + ".old")
        if fs.exists(table):
            return
        if fs.exists(Path(self.path(name) + ".new/_SUCCESS")):
            self._rename(new, table)
        elif fs.exists(old):
            self._rename(old, table)

    def _rename(self, source, target) -> None:
        """Rename a folder to a name that is free.  Some file systems report
        a failure only by their result, and one that finds the name taken may
        move the folder into the other."""
        fs, _ = self._fs()
        if fs.exists(target):
            raise FileExistsError(f"{target} is in the way of {source}")
        if not fs.rename(source, target):
            raise OSError(f"{source} can't be renamed to {target}")

    def folders(self, path: str) -> list[str]:
        """Paths of the folders directly below ``path``; none if it doesn't exist."""
        fs, Path = self._fs()
        if not fs.exists(Path(path)):
            return []
        return sorted(str(f.getPath()) for f in fs.listStatus(Path(path)) if f.isDirectory())

    def has_path(self, path: str) -> bool:
        fs, Path = self._fs()
        return bool(fs.exists(Path(path)))

    def delete_path(self, path: str) -> None:
        fs, Path = self._fs()
        fs.delete(Path(path), True)

    def delete_if_empty(self, path: str) -> None:
        """Remove a folder that holds nothing; one that is filled meanwhile stays."""
        fs, Path = self._fs()
        if fs.exists(Path(path)) and not len(fs.listStatus(Path(path))):
            try:
                fs.delete(Path(path), False)
            except Py4JJavaError:
                if not len(fs.listStatus(Path(path))):
                    raise

    def make_folder(self, path: str) -> None:
        fs, Path = self._fs()
        if not fs.mkdirs(Path(path)):
            raise OSError(f"{path} can't be made")

    def days(self, name: str) -> list[str]:
        """The days that have files, newest first, from the folder listing alone."""
        col = day_column(name)
        fs, Path = self._fs()
        if col is None or not self.exists(name):
            return []
        names = [str(f.getPath().getName()) for f in fs.listStatus(Path(self.path(name))) if f.isDirectory()]
        return sorted((n.split("=", 1)[1] for n in names if n.startswith(f"{col}=") and "HIVE_DEFAULT" not in n), reverse=True)

    def size_bytes(self, name: str, day_filter: list[str] | None = None) -> int:
        """Bytes on storage of a table (or of some of its day partitions)."""
        fs, Path = self._fs()
        if not day_filter:
            return int(fs.getContentSummary(Path(self.path(name))).getLength())
        col = day_column(name)
        total = 0
        for d in day_filter:
            p = Path(f"{self.path(name)}/{col}={d}")
            if fs.exists(p):
                total += int(fs.getContentSummary(p).getLength())
        return total

    def file_count(self, name: str) -> int:
        fs, Path = self._fs()
        return int(fs.getContentSummary(Path(self.path(name))).getFileCount())

    def data_files(self, name: str) -> int:
        """Number of data files right in a table's folder, from the listing."""
        fs, Path = self._fs()
        names = [str(f.getPath().getName()) for f in fs.listStatus(Path(self.path(name))) if f.isFile()]
        return sum(n[0] not in "._" for n in names)

    # -- DDL -------------------------------------------------------------------

    def ensure(self, name: str) -> None:
        """CREATE TABLE IF NOT EXISTS.  The schema is declared, never read
        from files, so an empty directory is a valid empty table."""
        if self.exists(name):
            return
        fs, Path = self._fs()
        fs.mkdirs(Path(self.path(name)))

    def ensure_all(self) -> None:
        for name in TABLES:
            self.ensure(name)

    # -- read ------------------------------------------------------------------

    def read(self, name: str) -> DataFrame:
        """The table with exactly its declared columns (the day partition
        column stays available for pruning through ``read_with_day``)."""
        return self.read_with_day(name).select(*TABLES[name][0].fieldNames())

    def read_with_day(self, name: str) -> DataFrame:
        self.recover(name)
        schema = TABLES[name][0]
        df = self._files(name, self.path(name))
        cols = [F.col(f.name).cast(f.dataType) for f in schema.fields]
        col = day_column(name)
        if col:
            cols.append(F.col(col).cast("date").alias(col))
        return df.select(*cols)

    def stored_schema(self, name: str) -> T.StructType:
        """The declared columns and those of the folder levels."""
        return T.StructType(TABLES[name][0].fields + partition_fields(name))

    def _files(self, name: str, *paths: str) -> DataFrame:
        return self.spark.read.schema(self.stored_schema(name)).option("basePath", self.path(name)).parquet(*paths)

    def _read_folders(self, name: str, folders: Iterable[str]) -> DataFrame:
        """Exactly these partition folders, declared columns.  Only they are
        listed, so neither the history nor what lies between two folders that
        a batch touches costs anything."""
        self.recover(name)
        paths = [p for p in (f"{self.path(name)}/{f}" for f in folders) if self.has_path(p)]
        schema = TABLES[name][0]
        if not paths:
            return self.no_rows(schema)
        return self._files(name, *paths).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])

    def no_rows(self, schema: T.StructType) -> DataFrame:
        """No rows of a schema, seen as such by the optimizer: a join with them
        goes from the plan, and the other side isn't dealt for it."""
        return self.spark.range(1).filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])

    def read_days(self, name: str, days: Iterable[dt.date]) -> DataFrame:
        """Exactly these day partitions."""
        col = day_column(name)
        if col is None:
            raise ValueError(f"{name} is not day-partitioned")
        return self._read_folders(name, [f"{col}={d.isoformat()}" for d in sorted(set(days))])

    def bucket_of(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def read_buckets(self, name: str, buckets: Iterable[int], version: str | None = None) -> DataFrame:
        """Exactly these buckets, of a dimension the ``current`` or the ``closed`` versions."""
        if name not in BUCKET_KEY or (version is None) == (name in VERSIONED):
            raise ValueError(f"{name} has no such buckets")
        above = f"version={version}/" if version else ""
        return self._read_folders(name, [f"{above}bucket={b}" for b in sorted(set(buckets))])

    def read_current(self, name: str) -> DataFrame:
        """The current versions of a dimension; its history isn't listed."""
        return self._read_folders(name, ["version=current"])

    # -- write -----------------------------------------------------------------

    def _prepare(self, df: DataFrame, name: str, deal: bool, derived: Mapping[str, Column] | None = None) -> DataFrame:
        schema, part = TABLES[name]
        derived = derived or {}
        out = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields if f.name not in derived])
        if part:
            out = out.withColumn(day_column(name), F.to_date(F.col(part)))
        if name in VERSIONED:
            out = out.withColumn("version", F.when(F.col("is_current"), F.lit("current")).otherwise(F.lit("closed")))
        if name in BUCKET_KEY:
            out = out.withColumn("bucket", self.bucket_of(BUCKET_KEY[name]))
        parts = [f.name for f in partition_fields(name)]
        if parts and deal:
            out = out.hint("rebalance", *parts)
        if derived:
            out = out.withColumns({c: value.cast(schema[c].dataType) for c, value in derived.items()})
            out = out.select(*schema.fieldNames(), *parts)
        order = SORT_ORDER.get(name, ())
        if parts or order:
            out = out.sortWithinPartitions(*parts, *order)
        return out

    def _write(self, df: DataFrame, name: str, mode: str, path: str, overwrite: str = "static", deal: bool = True,
               derived: Mapping[str, Column] | None = None) -> None:
        writer = self._prepare(df, name, deal, derived).write.mode(mode).option("compression", PARQUET_CODEC)
        # said for each write, so that the session's mode doesn't matter
        writer = writer.option("partitionOverwriteMode", overwrite)
        parts = [f.name for f in partition_fields(name)]
        if parts:
            writer = writer.partitionBy(*parts)
        writer.parquet(path)

    def append(self, name: str, df: DataFrame, derived: Mapping[str, Column] | None = None) -> None:
        """``derived``: columns made of the others only when the rows have been
        dealt to their files, so that they aren't shuffled."""
        self.ensure(name)
        self._write(df, name, "append", self.path(name), derived=derived)

    def overwrite(self, name: str, df: DataFrame, derived: Mapping[str, Column] | None = None) -> None:
        """Replace the whole table; ``df`` may read it.  The old files stay
        beside it until the next replacement.  ``derived`` as in ``append``."""
        self.recover(name)
        fs, Path = self._fs()
        table, new, old = Path(self.path(name)), Path(self.path(name) + ".new"), Path(self.path(name) + ".old")
        self._write(df, name, "overwrite", self.path(name) + ".new", derived=derived)
        if fs.exists(table):
            fs.delete(old, True)
            self._rename(table, old)
        self._rename(new, table)

    def overwrite_days(self, name: str, df: DataFrame, deal: bool = True) -> None:
        """Replace only the day partitions (or buckets) present in ``df``,
        which may read the table; others keep their files."""
        if not partition_fields(name):
            raise ValueError(f"{name} has no partitions")
        self.ensure(name)
        self._write(df, name, "overwrite", self.path(name), "dynamic", deal)

    # -- zone map ----------------------------------------------------------------

    def note_zones(self, readings: DataFrame) -> None:
        """Note when the readings of each day were ingested.  Called with the
        rows of a write, or more, before it: a zone may be too wide, never too
        narrow."""
        day = F.to_date("event_time").alias("day")
        first, last = F.min("ingestion_time").alias("first_ingestion"), F.max("ingestion_time").alias("last_ingestion")
        self.append("fact_zones", readings.groupBy(day).agg(first, last).filter("last_ingestion IS NOT NULL"))

    def merge_zones(self) -> None:
        """One row a day in the zone map."""
        zones = self.read("fact_zones")
        merged = zones.groupBy("day").agg(F.min("first_ingestion").alias("first_ingestion"), F.max("last_ingestion").alias("last_ingestion"))
        self.overwrite("fact_zones", merged)

    def days_ingested_since(self, start: Column, name: str = "fact_measurements") -> list[dt.date]:
        """Days that may hold readings ingested from ``start`` on; a day that
        isn't in the zone map may.  As many as the calendar has at most."""
        zones = self.read("fact_zones").groupBy("day").agg((F.max("last_ingestion") >= start).alias("may"))
        known = {r.day: r.may for r in zones.collect()}
        return [d for d in map(dt.date.fromisoformat, self.days(name)) if known.get(d, True)]

    # -- files -------------------------------------------------------------------

    def day_files(self, name: str, day: str) -> list[tuple[str, int]]:
        """(path, bytes) of the data files of a day, from the listing."""
        fs, Path = self._fs()
        folder = Path(f"{self.path(name)}/{day_column(name)}={day}")
        if not fs.exists(folder):
            return []
        files = [(str(f.getPath()), int(f.getLen())) for f in fs.listStatus(folder) if f.isFile()]
        return sorted(f for f in files if f[0].rsplit("/", 1)[1][0] not in "._")

    def read_files(self, name: str, paths: list[str]) -> DataFrame:
        """Some data files of a table, with the columns of the folder levels."""
        return self._files(name, *paths)

    def replace_files(self, name: str, old: list[str], df: DataFrame, **options: str) -> None:
        """Put the rows of ``df``, which are those of the files ``old`` (and has
        their folder columns), in the place of these files.

        The new files are written to a hidden folder of the table, then a list
        of the old ones: from then on a run that stops is completed by the next
        access, before that it has changed nothing.
        """
        fs, Path = self._fs()
        packing = f"{self.path(name)}/_packing-{uuid.uuid4().hex[:12]}"
        writer = df.write.option("compression", PARQUET_CODEC).options(**options)
        writer.partitionBy(*[f.name for f in partition_fields(name)]).parquet(f"{packing}/data")
        out = fs.create(Path(f"{packing}/old.tmp"))
        out.writeBytes("\n".join(old))
        out.close()
        self._rename(Path(f"{packing}/old.tmp"), Path(f"{packing}/old"))
        self._finish_packing(name, packing)

    def _finish_packing(self, name: str, packing: str) -> None:
        fs, Path = self._fs()
        if fs.exists(Path(f"{packing}/old")):
            listed = self.spark.sparkContext.wholeTextFiles(f"{packing}/old").collect()[0][1].split("\n")
            for folder in self.folders(f"{packing}/data"):
                target = f"{self.path(name)}/{folder.rsplit('/', 1)[1]}"
                for f in fs.listStatus(Path(folder)):
                    if not str(f.getPath().getName()).startswith((".", "_")):
                        self._rename(f.getPath(), Path(f"{target}/{f.getPath().getName()}"))
            for path in listed:
                fs.delete(Path(path), False)
        fs.delete(Path(packing), True)

    def create_tables(self, database: str) -> None:
        """CREATE TABLE IF NOT EXISTS for every table, over its files, in the session's catalog."""
        self.ensure_all()
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, (schema, _) in TABLES.items():
            parts = partition_fields(name)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields + parts)
            by = f"PARTITIONED BY ({', '.join(f.name for f in parts)})" if parts else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet {by} LOCATION '{self.path(name)}'"
            )
            if parts:
                self.spark.sql(f"MSCK REPAIR TABLE {database}.{name}")
            else:
                self.spark.catalog.refreshTable(f"{database}.{name}")

    def read_day(self, name: str, day: str) -> DataFrame:
        """One day, declared columns and the day column."""
        return self.read_with_day(name).filter(F.col(day_column(name)) == F.lit(day).cast("date"))

    def publish_views(self) -> None:
        """Expose every existing table as a temp view of the same name."""
        for name in TABLES:
            if self.exists(name):
                self.read(name).createOrReplaceTempView(name)
