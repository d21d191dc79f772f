"""What a batch may touch, and what must survive any order of batches, failures and other writers."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import facts, rollup, scd2
from tidewater.operators.compaction import compact_recent
from tidewater.plans import panels, registry
from tidewater.schemas import STAGING
from tidewater.sources import telemetry
from tidewater.sources.tables import TableStore
from tidewater.streaming import rollup_stream
from tidewater.streaming.pipeline import WarehouseJob

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)


def readings_of(spark, rows):
    """Readings from (device, time, latitude, longitude[, temp])."""
    df = spark.createDataFrame(
        [(r[0], r[1], r[2], r[3], r[4] if len(r) > 4 else 1.0) for r in rows],
        "iot_device_id int, event_time timestamp, latitude double, longitude double, temp double",
    )
    df = df.withColumns({"ingestion_time": F.col("event_time") + F.expr("INTERVAL 1 SECOND"), "timezone": F.lit("UTC")})
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in STAGING.fields])


def files(store, name):
    """{data file: time it was written}, relative to the table."""
    base = store.path(name)
    return {os.path.relpath(p, base): os.stat(p).st_mtime_ns for p in glob.glob(f"{base}/**/*.parquet", recursive=True)}


def folders_changed(before, after):
    return {os.path.dirname(p) for p, _ in set(before.items()) ^ set(after.items())}


def job_on(spark, root, **args):
    return WarehouseJob(spark, TableStore(spark, root, buckets=4), row_key_kind="content", **args)


def test_untouched_days_and_buckets_keep_their_files(spark, tmp_dir):
    job = job_on(spark, tmp_dir)
    st = job.store
    job.process(readings_of(spark, [(d, T0 + dt.timedelta(days=k), 40.0, -100.0) for d in range(1, 9) for k in (0, 7, 14, 29)]), 0)
    job.finish(T0)
    tables = ("fact_hourly_agg", "fact_measurements", "staging_events", "dim_iot_device", "fact_hourly_devices")
    before = {t: files(st, t) for t in tables}
    # two days 29 apart, one device that moves
    job.process(readings_of(spark, [(3, T0 + dt.timedelta(hours=1), 40.0, -100.0), (3, T0 + dt.timedelta(days=29, hours=1), 48.0, 2.0)]), 1)
    job.finish(dt.datetime(2030, 1, 1))
    ends = {"2024-01-01", "2024-01-30"}
    for t, col in (("fact_hourly_agg", "hour_bucket_date"), ("fact_hourly_devices", "hour_bucket_date"),
                   ("fact_measurements", "event_time_date"), ("staging_events", "event_time_date")):
        assert folders_changed(before[t], files(st, t)) == {f"{col}={d}" for d in ends}, t
    bucket = st.spark.range(1).select(F.lit(3).alias("iot_device_id")).select(st.bucket_of("iot_device_id")).first()[0]
    changed = folders_changed(before["dim_iot_device"], files(st, "dim_iot_device"))
    assert changed == {f"version=current/bucket={bucket}", f"version=closed/bucket={bucket}"}
    want = rollup.hourly_rollup(st.read("fact_measurements")).select("hour_bucket", "iot_device_id", "avg_temp")
    got = st.read("fact_hourly_agg").select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_note_written_during_the_refresh_stays(spark, tmp_dir):
    job = job_on(spark, tmp_dir, source="a")
    job.process(readings_of(spark, [(1, T0, 40.0, -100.0)]), 0)
    upsert = job._upsert_hourly

    def meanwhile(fresh):
        upsert(fresh)
        other = job_on(spark, tmp_dir, source="b")
        other.process(readings_of(spark, [(2, T0 + dt.timedelta(days=3), 40.0, -100.0)]), 0)

    job._upsert_hourly = meanwhile
    job.refresh_pending()
    job._upsert_hourly = upsert
    assert job.store.folders(f"{tmp_dir}/pending_hours/source=b") and not job.store.folders(f"{tmp_dir}/pending_hours/source=a")
    job.refresh_pending()
    assert job.store.read("fact_hourly_agg").count() == 2 and not job.store.has_path(f"{tmp_dir}/pending_hours")


def test_quarantines_of_two_runs_are_both_kept(spark, tmp_dir):
    broken = readings_of(spark, [(None, T0, 1.0, 1.0), (1, None, 1.0, 1.0), (2, T0, 1.0, 1.0)])
    for _ in range(2):  # two runs without a name, both with batch 0
        job = job_on(spark, f"{tmp_dir}/t")
        job.process(broken, 0)
        job.process(broken, 0)  # a replay
    assert job.quarantined().count() == 4
    broken.write.parquet(f"{tmp_dir}/in")
    store = TableStore(spark, f"{tmp_dir}/s")
    for name in ("a", "b"):  # two streams over one store, and a restart of each
        for _ in range(2):
            stream = spark.readStream.schema(STAGING).parquet(f"{tmp_dir}/in")
            rollup_stream.start_dedup(stream, store, f"{tmp_dir}/ck-{name}").awaitTermination()
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/s/quarantine").count() == 4
    assert store.read("staging_events").count() == 1


def states_in_batches(seed):
    """Batches of readings: devices move back and forth, some stay; one reading per device and batch."""
    rng = random.Random(seed)
    places = [(40.0, -100.0), (48.0, 2.0), (35.7, 139.7)]
    return [
        [(d, T0 + dt.timedelta(hours=10 * b + d), *(places[0] if d == 1 else rng.choice(places))) for d in range(1, 5) if rng.random() < 0.8]
        for b in range(5)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_batches_gives_the_same_versions(spark, tmp_dir, seed):
    batches = states_in_batches(seed)
    log = spark.createDataFrame([r for b in batches for r in b], "iot_device_id int, state_time timestamp, latitude double, longitude double")
    log = log.withColumn("timezone", F.lit("UTC"))
    random.Random(seed).shuffle(batches)
    job = job_on(spark, f"{tmp_dir}/{seed}", effective_from="spliced", source="s")
    for i, batch in enumerate(batches):
        job.process(readings_of(spark, batch), i)
        if i == 2:
            job.process(readings_of(spark, batch), i)  # a replay
    for name, spec in (("dim_iot_device", scd2.DEVICE), ("dim_country", scd2.COUNTRY)):
        want = scd2.scd2_history(scd2.tracked_states(log, spec), spec, "_state_time")
        got = job.store.read(name)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_a_replay_after_a_failure_closes_versions_once(spark, tmp_dir):
    job = job_on(spark, tmp_dir, source="s")
    job.process(readings_of(spark, [(d, T0, 40.0, -100.0) for d in (1, 2, 3, 4, 5, 6)]), 0)
    moved = readings_of(spark, [(d, T0 + dt.timedelta(days=1), 48.0, 2.0) for d in (1, 2, 3)])
    replace = job.store.overwrite_days

    def fails(name, *args, **kwargs):
        if name == "dim_iot_device":
            raise RuntimeError("lost")
        return replace(name, *args, **kwargs)

    job.store.overwrite_days = fails
    with pytest.raises(RuntimeError, match="lost"):
        job.process(moved, 1)
    again = job_on(spark, tmp_dir, source="s")  # a new run of the same stream, later
    again.process(moved, 1)
    dim = again.store.read("dim_iot_device").collect()
    assert len(dim) == len({r.device_sk for r in dim}) == 9 and sum(r.is_current for r in dim) == 6
    ends = {r.iot_device_id: r.effective_end for r in dim if not r.is_current}
    starts = {r.iot_device_id: r.effective_start for r in dim if r.is_current}
    assert set(ends) == {1, 2, 3} and all(ends[d] == starts[d] for d in ends)


@pytest.mark.parametrize("slot", ["day", "hour", "month"])
def test_facts_get_the_versions_valid_at_event_time(spark, slot):
    rng = random.Random(5)
    at = lambda: T0 + dt.timedelta(minutes=rng.randrange(60 * 24 * 40))
    versions = {d: sorted({at() for _ in range(rng.randint(1, 6))}) for d in range(1, 6)}

    def dim(sk, *extra):
        rows = [(f"{sk}-{d}-{i}", d, s, starts[i + 1] if i + 1 < len(starts) else None, *[f"{e}{i}" for e in extra])
                for d, starts in versions.items() for i, s in enumerate(starts)]
        more = "".join(f", {e} string" for e in extra)
        return spark.createDataFrame(rows, f"{sk} string, iot_device_id int, effective_start timestamp, effective_end timestamp{more}")

    times = {(d, at()) for d in [1] * 120 + [2, 3, 4, 5, 9] * 8} | {(d, s) for d, v in versions.items() for s in v}
    batch = readings_of(spark, [(d, t, 0.0, 0.0) for d, t in times])
    got = facts.load_fact_asof(batch, dim("device_sk"), dim("country_sk", "country_code"), "content", slot).collect()
    assert len(got) == len(times)
    for r in got:
        before = [i for i, s in enumerate(versions.get(r.iot_device_id, [])) if s <= r.event_time]
        want = (f"device_sk-{r.iot_device_id}-{before[-1]}", f"country_sk-{r.iot_device_id}-{before[-1]}", f"country_code{before[-1]}") if before else (None, None, None)
        assert (r.device_sk, r.country_sk, r.country_code) == want
    empty = facts.load_fact_asof(batch.limit(0), dim("device_sk"), dim("country_sk", "country_code"), "content", slot)
    assert empty.count() == 0


def test_windows_and_repair_lose_no_reading(spark, tmp_dir):
    store = TableStore(spark, f"{tmp_dir}/t")
    batches = [
        [(1, T0 + dt.timedelta(hours=h, minutes=m), 40.0, -100.0, float(h)) for h in range(6) for m in (0, 20)],
        [(1, T0 + dt.timedelta(hours=30), 40.0, -100.0, 1.0)],  # closes the hours before
        [(1, T0 + dt.timedelta(hours=2, minutes=40), 48.0, 2.0, 50.0), (2, T0 + dt.timedelta(minutes=5), 40.0, -100.0, 9.0)],  # late
    ]
    late = []
    for i, batch in enumerate(batches):
        readings_of(spark, batch).write.mode("append").parquet(f"{tmp_dir}/in")
        source = spark.readStream.schema(STAGING).parquet(f"{tmp_dir}/in")
        rollup_stream.start_dedup(source, store, f"{tmp_dir}/ck", note_hours=True).awaitTermination()
        rollup_stream.start_window_rollup(store, f"{tmp_dir}/ck-w").awaitTermination()  # a restart each time
        late.append(rollup_stream.repair_hours(store))
        placed = store.read("staging_events").withColumn("country_code", rollup_stream.country_of("latitude", "longitude")["country_code"])
        want = rollup.hourly_rollup(placed)
        got = store.read("fact_hourly_agg").select(*want.columns)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert late[2] == 2  # the two late hours, and no other
    assert rollup_stream.repair_hours(store) == 0


def test_compaction_packs_small_files_only(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    day = telemetry.load_measurements(spark, SF).limit(200).withColumn("event_time", F.lit(T0).cast("timestamp") + F.make_dt_interval(mins=F.pmod("iot_device_id", F.lit(900)) + F.rand(3)))
    rows = facts.fact_rows(day.withColumns({c: F.lit("x") for c in ("device_sk", "country_sk", "country_code")}), "content").persist()
    store.append("fact_measurements", rows.repartition(1))
    (large, size), = store.day_files("fact_measurements", "2024-01-01")
    for _ in range(4):
        store.append("fact_measurements", rows.limit(10))
    count = lambda: store.read("fact_measurements").count()
    n = count()
    assert compact_recent(store, "fact_measurements", T0.date(), 0, target_bytes=size) >= 1
    left = [f for f, _ in store.day_files("fact_measurements", "2024-01-01")]
    assert large in left and len(left) <= 3 and count() == n == rows.count() + 40
    before = files(store, "fact_measurements")
    assert compact_recent(store, "fact_measurements", T0.date(), 0, target_bytes=size * 40) >= 1  # now all are small
    assert compact_recent(store, "fact_measurements", T0.date(), 0, target_bytes=size * 40) == 0
    after = files(store, "fact_measurements")
    assert before != after and len(after) == 1 and count() == n

    # a run that stops before its list is written has changed nothing, one that stops after is completed
    store.append("fact_measurements", rows.limit(10))
    store.append("fact_measurements", rows.limit(10))
    finish, store._finish_packing = store._finish_packing, lambda *a: None
    assert compact_recent(store, "fact_measurements", T0.date(), 0, target_bytes=size * 40) == 1
    store._finish_packing = finish
    assert glob.glob(f"{tmp_dir}/fact_measurements/_packing-*")
    assert count() == n + 20 and len(files(store, "fact_measurements")) == 1
    assert not glob.glob(f"{tmp_dir}/fact_measurements/_packing-*")


def test_clustered_files_let_device_panels_skip_row_groups(spark, tmp_dir):
    import pyarrow.parquet as pq

    store = TableStore(spark, tmp_dir)
    day = spark.range(40_000).select(
        F.lit(None).cast("string").alias("fact_sk"), (F.col("id") % 400).cast("int").alias("iot_device_id"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 2)).alias("event_time"), F.rand(1).alias("temp"))
    names = {f.name: f for f in registry.fact(spark, SF).schema.fields}
    full = day.select(*[(F.col(c) if c in day.columns else F.lit(None)).cast(f.dataType).alias(c) for c, f in names.items()])
    for part in range(2):
        store.append("fact_measurements", full.filter(F.pmod(F.xxhash64("iot_device_id", "event_time"), F.lit(2)) == part).repartition(1))

    def groups(path):
        """(all, those that may hold device 7) row groups."""
        meta = pq.ParquetFile(path).metadata
        k = meta.schema.to_arrow_schema().names.index("iot_device_id")
        stats = [meta.row_group(i).column(k).statistics for i in range(meta.num_row_groups)]
        return len(stats), sum(s.min <= 7 <= s.max for s in stats)

    by_time = [groups(p) for p, _ in store.day_files("fact_measurements", "2024-01-01")]
    assert all(hit == every for every, hit in by_time)  # sorted by time, every group has every device
    rows = lambda: store.read("fact_measurements").agg(F.count("*"), F.sum(F.hash("iot_device_id", "event_time", "temp"))).first()
    want = rows()
    assert compact_recent(store, "fact_measurements", T0.date(), 0, group_bytes=16 << 10) == 1
    (path, _), = store.day_files("fact_measurements", "2024-01-01")
    every, hit = groups(path)
    assert every >= 8 and hit <= every / 3
    assert rows() == want


def test_lag_panels_read_only_the_days_of_the_zone_map(spark):
    for name in ("panel_ingestion_lag", "panel_ingestion_lag_by_country"):
        df = registry.queries()[name](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
        assert scans
        for line in scans:
            pruned = line.split("PartitionFilters: [", 1)[1].split("]")[0]
            assert "event_time_date" in pruned and " IN (" in pruned or "event_time_date#" in pruned and "=" in pruned, line
    store = registry._served(spark, SF)
    newest = registry.newest_instant(store)
    days = store.days_ingested_since(F.lit(newest - dt.timedelta(minutes=10)).cast("timestamp"))
    assert 1 <= len(days) <= 2 and len(store.days("fact_measurements")) > 20
    f = store.read("fact_measurements")
    as_of = F.lit(newest).cast("timestamp")
    assert panels.ingestion_lag_stored(store, as_of).collect() == panels.ingestion_lag(f, as_of).collect()
    # a day that isn't in the map may hold anything
    other = TableStore(spark, store.root)
    other.read = lambda name: store.read(name).limit(0)
    assert len(other.days_ingested_since(as_of)) == len(store.days("fact_measurements"))


def test_sketches_unite_within_their_error(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 20_000).cast("int").alias("iot_device_id"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(hours=F.pmod(F.xxhash64("id"), F.lit(48)))).alias("event_time"),
        F.element_at(F.array(F.lit("US"), F.lit("JP")), (F.col("id") % 2 + 1).cast("int")).alias("country_code"))
    sketches = rollup.device_sketches(rows)
    as_of = F.lit(T0 + dt.timedelta(hours=47)).cast("timestamp")
    for hours, countries in ((47, None), (10, None), (47, ["JP"])):
        got = panels.active_devices_approx(sketches, as_of, hours, countries).first().value
        mine = rows.filter(F.col("event_time") >= F.lit(T0 + dt.timedelta(hours=47 - hours)))
        want = (mine if countries is None else mine.filter(F.col("country_code").isin(countries))).select("iot_device_id").distinct().count()
        assert abs(got - want) <= 4 * rollup.SKETCH_ERROR * want
    assert panels.active_devices_approx(sketches.limit(0), as_of).first().value == 0
    late = rows.filter(F.hour("event_time") == 5)
    again = rollup.refresh_sketches(sketches, rows.unionByName(late), rollup.touched_hours(late))
    assert again.agg(F.sum("n_events")).first()[0] == 60_000 + late.count()


def test_last_readings_survive_restarts_and_any_order(spark, tmp_dir):
    from tidewater.streaming.last_reading import start_last_not_null

    store = TableStore(spark, f"{tmp_dir}/t", buckets=3)
    at = lambda h: T0 + dt.timedelta(hours=h)
    steps = [
        ([(1, at(5), 0.0, 0.0, 5.0), (2, at(1), 0.0, 0.0, 1.0), (3, at(9), 0.0, 0.0, None)], {1: 5.0, 2: 1.0}),
        ([(1, at(3), 0.0, 0.0, 3.0), (2, at(2), 0.0, 0.0, 2.0), (2, at(8), 0.0, 0.0, None)], {1: 5.0, 2: 2.0}),
        ([(3, at(1), 0.0, 0.0, 7.0), (1, at(6), 0.0, 0.0, 6.0), (None, at(7), 0.0, 0.0, 1.0)], {1: 6.0, 2: 2.0, 3: 7.0}),
    ]
    for rows, want in steps:
        readings_of(spark, rows).write.mode("append").parquet(f"{tmp_dir}/in")
        stream = spark.readStream.schema(STAGING).parquet(f"{tmp_dir}/in")
        start_last_not_null(stream, "temp", store, f"{tmp_dir}/ck").awaitTermination()
        assert {r.iot_device_id: r.value for r in store.read("device_last").collect()} == want
