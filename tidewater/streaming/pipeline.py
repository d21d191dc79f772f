"""The warehouse job: per-batch fan-out into the tables, then finishing.

Per micro-batch (``WarehouseJob.process``, the ``foreachBatch`` body):

1. persist the batch; one job finds its days and its broken rows;
2. rows with a NULL key go to ``<root>/quarantine``, in a folder named by
   stream and batch id that a replay replaces;
3. de-duplicate on (event_time, device); an empty batch stops here;
4. staging: insert rows not yet present (of the target only the day
   partitions that the batch has readings of are read);
5. dim_date: append dates not yet present;
6. dim_iot_device, dim_country: SCD2 merge with one literal batch instant;
   closed versions are appended, of the current ones the buckets that change
   are replaced;
7. fact: skip rows already loaded, resolve the keys of the others against
   the new current rows, append;
8. note the (hour, device) pairs the batch touched in ``<root>/pending_hours``.

Every step is idempotent, so a replayed batch (``foreachBatch`` is
at-least-once) changes nothing.  After the stream drains, ``finish``
recomputes every noted hour, however old, and compacts recent fact
partitions; the notes go when the rollup is written, so a run that stops
before that leaves them to the next one.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewater.operators import calendar, facts, rollup, scd2
from tidewater.operators.compaction import compact_recent
from tidewater.operators.dedup import batch_days, split_null_keys
from tidewater.operators.merge import rows_to_insert, upsert
from tidewater.plans.warehouse import dedup_batch
from tidewater.schemas import DEDUP_KEYS, HOURLY, HOURLY_KEYS, STAGING
from tidewater.sources.tables import TableStore
from tidewater.streaming.staging import start_staging, stream_name

_EPOCH = dt.datetime(1970, 1, 1)
_HOURS = T.StructType([HOURLY[k] for k in HOURLY_KEYS])


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


class WarehouseJob:
    def __init__(self, spark: SparkSession, store: TableStore, row_key_kind: str = "uuid",
                 clock: Callable[[], dt.datetime] = _utc_now, source: str | None = None,
                 effective_from: str = "batch", keys: str = "current"):
        """``keys="current"`` resolves facts to the versions current when they
        are loaded, ``"as_of"`` to those valid at event time.  ``source`` names the run whose batch ids are used; by default the
        id of the stream that calls, and outside a stream a name of its own.
        ``effective_from="batch"`` versions dimensions in arrival order (a
        version starts at the batch instant); ``"event_time"`` starts a version
        at its reading's time and ignores late states older than the current
        version (they are in staging and facts, but open no version);
        ``"spliced"`` starts it there too and puts late states in their place,
        so that any order of batches gives the same versions."""
        if effective_from not in ("batch", "event_time", "spliced"):
            raise ValueError(f"unknown effective_from {effective_from!r}")
        if keys not in ("current", "as_of"):
            raise ValueError(f"unknown keys {keys!r}")
        self.keys = keys
        self.effective_from = effective_from
        self.spark = spark
        self.store = store
        self.row_key_kind = row_key_kind
        self.clock = clock
        self.source = source
        self._own_name = f"run-{uuid.uuid4().hex[:12]}"
        self.batches = 0
        store.ensure_all()

    # -- per batch -------------------------------------------------------------

    def _name(self) -> str:
        return self.source or stream_name(self.spark) or self._own_name

    def _batch_folder(self, kind: str, batch_id: int) -> str:
        return f"{self.store.root}/{kind}/source={self._name()}/batch_id={batch_id}"

    def _instant(self, batch_id: int) -> dt.datetime:
        """The batch's instant, noted before the first write: a replay after a
        failure uses the same, so versions that it closes again are equal."""
        noted = self.store.folders(self._batch_folder("batch_instants", batch_id))
        if noted:
            return _EPOCH + dt.timedelta(microseconds=int(noted[0].rsplit("=", 1)[1]))
        instant = self.clock()
        micros = (instant - _EPOCH) // dt.timedelta(microseconds=1)
        self.store.make_folder(f"{self._batch_folder('batch_instants', batch_id)}/instant={micros}")
        return instant

    def _forget_instants(self, batch_id: int) -> None:
        """Notes of earlier batches, which can't be replayed any more."""
        for folder in self.store.folders(f"{self.store.root}/batch_instants/source={self._name()}"):
            if int(folder.rsplit("=", 1)[1]) < batch_id:
                self.store.delete_path(folder)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        batch_ts = self._instant(batch_id)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, bad = split_null_keys(batch, DEDUP_KEYS)
            # one job gives the emptiness test, the days of the good rows
            # (which prune target partitions) and whether there is anything
            # to set aside
            days, n_bad = batch_days(batch, DEDUP_KEYS)
            if n_bad:
                bad.write.mode("overwrite").parquet(self._batch_folder("quarantine", batch_id))
            if not days:
                return
            deduped = dedup_batch(good).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                self._merge(deduped, batch_ts, days)
                hours = rollup.touched_hours(deduped)
                hours.write.mode("overwrite").parquet(self._batch_folder("pending_hours", batch_id))
                self.batches += 1
            finally:
                deduped.unpersist()
        finally:
            batch.unpersist()
        self._forget_instants(batch_id)

    def quarantined(self) -> DataFrame:
        """All rows set aside so far."""
        path = f"{self.store.root}/quarantine"
        if not self.store.has_path(path):
            return self.spark.createDataFrame([], STAGING)
        return self.spark.read.schema(STAGING).option("recursiveFileLookup", "true").parquet(path)

    def _merge(self, deduped: DataFrame, batch_ts: dt.datetime, days: list[dt.date]) -> None:
        st = self.store

        def staging() -> None:
            target = st.read_days("staging_events", days)
            st.append("staging_events", rows_to_insert(target, deduped, DEDUP_KEYS))

        def dates() -> None:
            st.append("dim_date", calendar.new_dates(st.read("dim_date"), deduped))

        # one row per device, found once for the log and both dimensions
        latest = scd2.device_states(deduped, keep_time=True).persist()
        late, rebuilt = None, []

        def devices() -> None:
            self._merge_dimension("dim_iot_device", scd2.DEVICE, latest, batch_ts, late, rebuilt)

        def countries() -> None:
            self._merge_dimension("dim_country", scd2.COUNTRY, scd2.in_country(latest), batch_ts, late, rebuilt)

        def zones() -> None:
            st.note_zones(deduped)

        # The merges read only the persisted batch and their own table, so they
        # run as concurrent Spark jobs; the fact load needs both new dimensions
        # (and the zones noted) and runs after them.
        try:
            if self.effective_from == "spliced":
                late, rebuilt = self._log_states(latest)
            with ThreadPoolExecutor(max_workers=5) as pool:
                # the threads carry the stream's job group, so stopping it cancels them
                steps = (staging, dates, devices, countries, zones)
                for f in [pool.submit(inheritable_thread_target(self.spark)(step)) for step in steps]:
                    f.result()
        finally:
            latest.unpersist()
            if late is not None:
                late.unpersist()

        # before their keys are resolved: a batch that comes again isn't dealt by device at all
        new = facts.not_yet_loaded(deduped, st.read_days("fact_measurements", days))
        if self.keys == "as_of":
            # versions that hold in the batch's days; the bounds reach the scans
            first, after = F.lit(days[0]).cast("timestamp"), F.lit(days[-1] + dt.timedelta(days=1)).cast("timestamp")
            valid = (F.col("effective_start") < after) & (F.col("effective_end").isNull() | (F.col("effective_end") > first))
            dims = [st.read(name).filter(valid) for name in ("dim_iot_device", "dim_country")]
            new_facts = facts.load_fact_asof(new, *dims, self.row_key_kind, days=(days[0], days[-1]))
        else:
            dims = [st.read_current(name) for name in ("dim_iot_device", "dim_country")]
            new_facts = facts.load_fact(new, *dims, self.row_key_kind)
        st.append("fact_measurements", new_facts, {"fact_sk": facts.row_key(self.row_key_kind)})

    def _buckets(self, keys: DataFrame, key: str) -> list[int]:
        return [r[0] for r in keys.select(self.store.bucket_of(key)).distinct().collect()]

    def _log_states(self, latest: DataFrame) -> tuple[DataFrame | None, list[int]]:
        """Add the batch's states to the log; the devices of those that came
        late, persisted (None if there are none), and their buckets."""
        st, key = self.store, scd2.DEVICE.key
        states = scd2.logged_states(latest)
        log = st.read_buckets("dim_states", self._buckets(states, key))
        late = scd2.late_keys(log, states).persist()
        rebuilt = self._buckets(late, key)
        st.append("dim_states", states.join(log, [key, "state_time"], "left_anti"))
        if rebuilt:
            return late, rebuilt
        late.unpersist()
        return None, []

    def _merge_dimension(self, name: str, spec: scd2.Scd2Spec, states: DataFrame, batch_ts: dt.datetime,
                         late_keys: DataFrame | None, rebuilt: list[int]) -> None:
        """Merge one row per device into a dimension; only the buckets whose
        versions change are written.

        Closed versions are appended before the current ones are replaced.  A
        replay after a failure between the two closes the same versions again;
        those that are stored already are left out.  The versions of
        ``late_keys``, which lie in the buckets ``rebuilt``, are made anew from
        the log of states.
        """
        st = self.store
        by_time = self.effective_from != "batch"
        if late_keys is not None:
            states = states.join(late_keys, spec.key, "left_anti")
        stage = scd2.stage_versions(states, spec, batch_ts, "event_time" if by_time else "batch").persist()
        try:
            current = st.read_current(name)
            changing = stage.join(scd2.changing_keys(current, stage, spec), spec.key, "left_semi")
            if by_time:
                changing = scd2.newer_states(current, changing, spec)
            buckets = self._buckets(changing, spec.key)
            if not buckets and not rebuilt:
                return
            before = st.read_buckets(name, {*buckets, *rebuilt}, "current")
            if late_keys is not None:
                before = before.join(late_keys, spec.key, "left_anti")
            if buckets:
                batch_rows = stage.filter(st.bucket_of(spec.key).isin(sorted({*buckets, *rebuilt})))
                if by_time:
                    batch_rows = scd2.newer_states(before, batch_rows, spec)
                closed, after = scd2.scd2_changes(before, batch_rows, spec)
                stored = st.read_buckets(name, {*buckets, *rebuilt}, "closed")
                fresh = closed.join(stored.select(spec.sk_col), spec.sk_col, "left_anti")
            else:  # none of the batch's states opens a version: what holds is what held
                fresh, after = st.no_rows(before.schema), before
            if rebuilt:
                log = st.read_buckets("dim_states", rebuilt).join(late_keys, spec.key, "left_semi")
                history = scd2.scd2_history(scd2.tracked_states(log, spec), spec, "_state_time").persist()
                after = after.unionByName(history.filter(F.col(spec.current)))
                again = st.bucket_of(spec.key).isin(sorted(rebuilt))
                kept = st.read_buckets(name, rebuilt, "closed").join(late_keys, spec.key, "left_anti")
                whole = kept.unionByName(fresh.filter(again)).unionByName(history.filter(~F.col(spec.current)))
                if buckets:
                    st.append(name, fresh.filter(~again))
                st.overwrite_days(name, whole)
            else:
                st.append(name, fresh)
            st.overwrite_days(name, after)
            if rebuilt:
                history.unpersist()
        finally:
            stage.unpersist()

    # -- after the stream ------------------------------------------------------

    def refresh_rollup(self, as_of: dt.datetime | None = None, lookback: str = rollup.DEFAULT_LOOKBACK) -> None:
        """Recompute hours from ``trunc_hour(as_of - lookback)`` on and upsert
        them; only the fact days from that hour on are read and only the
        rollup days holding those hours are rewritten."""
        st = self.store
        as_of_col = F.lit(as_of or self.clock()).cast("timestamp")
        start = rollup.window_start(as_of_col, lookback)
        recent = st.read_with_day("fact_measurements").filter(F.col("event_time_date") >= F.to_date(start))
        fresh = rollup.hourly_rollup(recent.drop("event_time_date"), start)
        self._upsert_hourly(fresh)

    def refresh_pending(self) -> None:
        """Recompute every (hour, device) that a batch wrote since the last
        time, however old.  Only the days that hold them are read and written;
        only the notes that were read are deleted."""
        st, path = self.store, f"{self.store.root}/pending_hours"
        notes = [note for source in st.folders(path) for note in st.folders(source)]
        if not notes:
            return
        hours = self.spark.read.schema(_HOURS).parquet(*notes).distinct().persist()
        try:
            days = sorted(r[0] for r in hours.select(F.to_date("hour_bucket")).distinct().collect())
            facts_of = st.read_days("fact_measurements", days)
            self._upsert_hourly(rollup.refresh_hours(facts_of, hours))
            sketches = st.read_days("fact_hourly_devices", days)
            st.overwrite_days("fact_hourly_devices", rollup.refresh_sketches(sketches, facts_of, hours))
        finally:
            hours.unpersist()
        for note in notes:
            st.delete_path(note)
        for folder in [*st.folders(path), path]:
            st.delete_if_empty(folder)

    def _upsert_hourly(self, fresh: DataFrame) -> None:
        st = self.store
        fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            days = [r[0] for r in fresh.select(F.to_date("hour_bucket")).distinct().collect()]
            if not days:
                return
            existing = st.read_days("fact_hourly_agg", days)
            st.overwrite_days("fact_hourly_agg", upsert(existing, fresh, HOURLY_KEYS))
        finally:
            fresh.unpersist()

    def finish(self, as_of: dt.datetime | None = None, compact_days: int = 2) -> None:
        self.refresh_pending()
        self.store.merge_zones()
        day = (as_of or self.clock()).date()
        compact_recent(self.store, "fact_measurements", day, compact_days)


def run(spark: SparkSession, raw_path: str, store: TableStore, checkpoint: str,
        as_of: dt.datetime | None = None, max_files_per_trigger: int | None = None, **job_args) -> WarehouseJob:
    """Drain the raw zone through the warehouse job, then finish (rollup and
    compaction).  The fact table exists before the stream starts, so a run
    with no new files still succeeds."""
    job = WarehouseJob(spark, store, **job_args)
    query = start_staging(spark, raw_path, checkpoint, job.process, available_now=True,
                          max_files_per_trigger=max_files_per_trigger)
    query.awaitTermination()
    job.finish(as_of)
    return job
