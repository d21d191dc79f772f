"""What the warehouse job and the served tables move no more than once."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from tidewater.operators import dedup, facts, rollup, scd2
from tidewater.operators.merge import rows_to_insert
from tidewater.plans import registry
from tidewater.plans.warehouse import dedup_batch, replay
from tidewater.schemas import DEDUP_KEYS, STAGING
from tidewater.sources import envelope, telemetry
from tidewater.sources.tables import TableStore
from tidewater.streaming.landing import publish_records, record_file_source, start_landing
from tidewater.streaming.pipeline import WarehouseJob

SF = "/root/testdata/sf0.001"


def test_raw_zone_is_compressed_and_read_back_whole(spark, tmp_dir):
    from tidewater.schemas import RAW_FILE

    readings = telemetry.load_measurements(spark, SF)
    publish_records(envelope.to_kafka_records(readings, 3), path=f"{tmp_dir}/broker")
    source = record_file_source(spark, f"{tmp_dir}/broker")
    start_landing(source, f"{tmp_dir}/raw", f"{tmp_dir}/ck", available_now=True).awaitTermination()
    files = glob.glob(f"{tmp_dir}/raw/ingestion_date=*/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    landed = envelope.flatten(spark.read.schema(RAW_FILE).json(f"{tmp_dir}/raw"))
    assert landed.count() == readings.count()
    assert landed.exceptAll(readings).isEmpty()


def test_replayed_batch_resolves_no_keys(spark, tmp_dir, monkeypatch):
    sizes, load = [], facts.load_fact

    def counted(batch, *args):
        sizes.append(batch.count())
        return load(batch, *args)

    monkeypatch.setattr(facts, "load_fact", counted)
    readings = telemetry.load_measurements(spark, SF)
    store = TableStore(spark, f"{tmp_dir}/tables")
    job = WarehouseJob(spark, store, row_key_kind="content", clock=lambda: dt.datetime(2100, 1, 1))
    older = readings.filter("day(event_time) < 20")
    job.process(older, 0)
    job.process(older, 0)
    job.process(readings, 1)  # of which the older ones are stored
    n, m = dedup_batch(readings).count(), dedup_batch(older).count()
    assert 0 < m < n and sizes == [m, 0, n - m]
    assert store.read("fact_measurements").count() == n
    assert store.read("fact_measurements").select("event_time", "iot_device_id").distinct().count() == n


def test_hours_are_rolled_up_where_the_join_dealt_them(spark):
    fact = replay(telemetry.load_measurements(spark, SF), deduplicate=True).fact.persist()
    hours = rollup.touched_hours(fact.filter("iot_device_id % 2 = 0"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = rollup.refresh_hours(fact, hours)
        plan = made._jdf.queryExecution().executedPlan().toString()
        # the facts, the hours and the distinct of the hours; the two levels of the rollup add none
        assert plan.count("Exchange hashpartitioning(_hb") + plan.count("Exchange hashpartitioning(hour_bucket") <= 2
        want = rollup.hourly_rollup(fact).filter("iot_device_id % 2 = 0")
        assert made.count() == want.count() > 0
        rounded = [F.round(f.name, 9).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in want.schema]
        assert made.select(*rounded).exceptAll(want.select(*rounded)).isEmpty()
        assert made.schema == want.schema
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        fact.unpersist()


def test_row_keys_are_made_after_the_rows_are_dealt(spark, tmp_dir):
    fact = replay(telemetry.load_measurements(spark, SF), deduplicate=True).fact
    store = TableStore(spark, f"{tmp_dir}/tables")
    derived = {"fact_sk": facts.row_key("content")}
    plan = store._prepare(fact, "fact_measurements", True, derived)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RebalancePartitions")
    assert "AS fact_sk" in above and "fact_sk" not in below
    store.overwrite("fact_measurements", fact, derived)
    kept = store.read("fact_measurements")
    assert kept.columns == fact.columns and kept.count() == fact.count()
    assert kept.exceptAll(fact).isEmpty()


def test_days_without_rows_deal_nothing(spark, tmp_dir):
    readings = telemetry.load_measurements(spark, SF)
    store = TableStore(spark, f"{tmp_dir}/tables")
    stored = store.read_days("staging_events", [dt.date(2024, 1, 1)])
    assert stored.schema == STAGING and stored.count() == 0
    new = rows_to_insert(stored, readings, DEDUP_KEYS)
    assert "Join" not in new._jdf.queryExecution().optimizedPlan().toString()
    assert new.count() == readings.count()


def test_more_files_make_no_more_micro_batches(spark, tmp_dir):
    readings = telemetry.load_measurements(spark, SF)
    for files in (1, 5, 40):
        path, rows = f"{tmp_dir}/in-{files}", []
        readings.repartition(files).write.parquet(path)
        stream = registry._file_stream(spark, path).writeStream.foreachBatch(lambda batch, _: rows.append(batch.count()))
        stream.option("checkpointLocation", f"{tmp_dir}/ck-{files}").trigger(availableNow=True).start().awaitTermination()
        assert sum(rows) == readings.count() and len(rows) == min(files, 5)


def test_states_of_a_batch_are_found_once(spark, tmp_dir, monkeypatch):
    found, latest = [], scd2.latest_per_key
    monkeypatch.setattr(scd2, "latest_per_key", lambda *args, **kwargs: found.append(1) or latest(*args, **kwargs))
    readings = telemetry.load_measurements(spark, SF)
    store = TableStore(spark, f"{tmp_dir}/tables")
    job = WarehouseJob(spark, store, row_key_kind="content", effective_from="spliced", keys="as_of")
    job.process(readings.filter("day(event_time) >= 20"), 0)
    job.process(readings.filter("day(event_time) < 20"), 1)
    assert len(found) == 2
    log = dedup_batch(readings).withColumn("state_time", F.col("event_time"))
    late = F.dayofmonth("event_time") < 20
    log = dedup.latest_per_key(log.withColumn("late", late), ["iot_device_id", "late"], "event_time")
    for name, spec in (("dim_iot_device", scd2.DEVICE), ("dim_country", scd2.COUNTRY)):
        want = scd2.scd2_history(scd2.tracked_states(log, spec), spec, "_state_time")
        got = store.read(name)
        assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()


def test_as_of_load_with_known_days_runs_no_job(spark, monkeypatch):
    readings = dedup_batch(telemetry.load_measurements(spark, SF)).persist()
    states = scd2.device_states(readings, keep_time=True)
    dims = [
        scd2.stage_versions(states, scd2.DEVICE, effective_from="event_time"),
        scd2.stage_versions(scd2.in_country(states), scd2.COUNTRY, effective_from="event_time"),
    ]
    want = facts.load_fact_asof(readings, *dims, "content")
    first, last = readings.agg(F.to_date(F.min("event_time")), F.to_date(F.max("event_time"))).first()
    monkeypatch.setattr(type(readings), "first", None)
    for slot in ("day", "hour", "month"):
        got = facts.load_fact_asof(readings, *dims, "content", slot, days=(first, last))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    readings.unpersist()
