import datetime as dt
import os

from pyspark.sql import functions as F

from tidewater.operators.compaction import compact_recent
from tidewater.sources import envelope, telemetry
from tidewater.sources.tables import TableStore
from tidewater.streaming.landing import publish_records, record_file_source, start_landing
from tidewater.streaming.pipeline import WarehouseJob, run
from tidewater.streaming.staging import start_staging

SF = "/root/testdata/sf0.001"


def _clock():
    t = [dt.datetime(2030, 1, 1)]

    def tick():
        t[0] = t[0] + dt.timedelta(minutes=1)
        return t[0]

    return tick


def _land(spark, readings, base):
    publish_records(envelope.to_kafka_records(readings, 3).repartition(2), path=f"{base}/broker")
    q = start_landing(record_file_source(spark, f"{base}/broker"), f"{base}/raw", f"{base}/ck-land", available_now=True)
    q.awaitTermination()


def test_empty_run_succeeds(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/raw")
    store = TableStore(spark, f"{tmp_dir}/tables")
    job = run(spark, f"{tmp_dir}/raw", store, f"{tmp_dir}/ck", as_of=dt.datetime(2024, 1, 31), clock=_clock())
    assert job.batches == 0
    assert store.read("fact_measurements").count() == 0
    assert store.read("fact_hourly_agg").count() == 0


def test_stream_load_restart_and_redelivery(spark, tmp_dir):
    readings = telemetry.load_measurements(spark, SF)
    n = readings.count()
    _land(spark, readings, tmp_dir)
    store = TableStore(spark, f"{tmp_dir}/tables")
    newest = readings.agg(F.max("event_time")).first()[0]
    clock = _clock()
    run(spark, f"{tmp_dir}/raw", store, f"{tmp_dir}/ck", as_of=newest, clock=clock, row_key_kind="content")
    fact = store.read("fact_measurements")
    assert fact.count() == n
    assert fact.filter(F.col("device_sk").isNull() | F.col("country_sk").isNull()).count() == 0
    assert store.read("staging_events").count() == n
    assert store.read("dim_iot_device").filter("is_current").count() == readings.select("iot_device_id").distinct().count()
    assert store.read("fact_hourly_agg").count() > 0
    snapshot = sorted(map(tuple, store.read("dim_iot_device").collect()))

    # restart from the checkpoint with nothing new: nothing changes
    run(spark, f"{tmp_dir}/raw", store, f"{tmp_dir}/ck", as_of=newest, clock=clock, row_key_kind="content")
    assert store.read("fact_measurements").count() == n
    assert sorted(map(tuple, store.read("dim_iot_device").collect())) == snapshot

    # the broker re-delivers everything: staging, dims and facts stay as they are
    publish_records(envelope.to_kafka_records(readings, 3), path=f"{tmp_dir}/broker")
    q = start_landing(record_file_source(spark, f"{tmp_dir}/broker"), f"{tmp_dir}/raw", f"{tmp_dir}/ck-land",
                      available_now=True)
    q.awaitTermination()
    run(spark, f"{tmp_dir}/raw", store, f"{tmp_dir}/ck", as_of=newest, clock=clock, row_key_kind="content")
    assert store.read("fact_measurements").count() == n
    assert store.read("staging_events").count() == n
    assert sorted(map(tuple, store.read("dim_iot_device").collect())) == snapshot


def test_quarantine_of_null_keys(spark, tmp_dir):
    store = TableStore(spark, f"{tmp_dir}/tables")
    job = WarehouseJob(spark, store, clock=_clock())
    raw = spark.createDataFrame([("{broken",), ('{"iot_device_id": 1, "data": {"dt": 1704448800}}',)], "raw_json string")
    for _ in range(2):  # a replayed batch adds nothing, neither to the tables nor to the quarantine
        job.process(envelope.flatten(raw), 0)
        assert job.quarantined().count() == 1
        assert store.read("fact_measurements").count() == 1
        assert store.read("staging_events").count() == 1
    job.process(envelope.flatten(raw.limit(1)), 1)  # broken rows only
    assert job.quarantined().count() == 2
    assert store.read("fact_measurements").count() == 1


def test_finish_covers_late_hours_and_clears_the_notes(spark, tmp_dir):
    from tidewater.operators import rollup

    readings = telemetry.load_measurements(spark, SF)
    store = TableStore(spark, f"{tmp_dir}/tables")
    job = WarehouseJob(spark, store, clock=_clock(), row_key_kind="content")
    job.process(readings.filter(F.dayofmonth("event_time") > 10), 0)
    job.finish(dt.datetime(2024, 1, 31))
    job.process(readings.filter(F.dayofmonth("event_time") <= 10), 1)  # ten days late
    job.finish(dt.datetime(2024, 1, 31))
    want = rollup.hourly_rollup(store.read("fact_measurements")).select("hour_bucket", "iot_device_id")
    got = store.read("fact_hourly_agg").select("hour_bucket", "iot_device_id")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert not store.has_path(f"{tmp_dir}/tables/pending_hours")


def _failing(df):
    return df.withColumn("date_key", F.when(F.rand() >= 0, F.raise_error(F.lit("lost"))).cast("int"))


def test_failed_write_keeps_the_old_rows(spark, tmp_dir):
    import pytest

    from tidewater.operators import calendar

    store = TableStore(spark, f"{tmp_dir}/tables")
    rows = calendar.calendar_rows(telemetry.load_measurements(spark, SF))
    store.overwrite("dim_date", rows)
    n = store.read("dim_date").count()
    with pytest.raises(Exception, match="lost"):
        store.overwrite("dim_date", _failing(store.read("dim_date")))
    assert store.read("dim_date").count() == n
    # a run that stopped between the two renames is completed on the next access
    fs, Path = store._fs()
    store.overwrite("dim_date", rows.limit(5))
    fs.rename(Path(store.path("dim_date")), Path(store.path("dim_date") + ".new"))
    assert store.read("dim_date").count() == 5
    fs.rename(Path(store.path("dim_date")), Path(store.path("dim_date") + ".gone"))
    assert store.read("dim_date").count() == n  # only the old files are left


def test_overwrite_replaces_everything_under_either_session_mode(spark, tmp_dir):
    from tidewater.plans.warehouse import replay

    fact = replay(telemetry.load_measurements(spark, SF)).fact.persist()
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for mode in ("static", "dynamic"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        try:
            store = TableStore(spark, f"{tmp_dir}/{mode}")
            store.overwrite("fact_measurements", fact)
            few = store.read("fact_measurements").filter(F.dayofmonth("event_time") == 3)
            n, total = few.count(), fact.count()
            store.overwrite_days("fact_measurements", few)  # reads the table it writes
            assert store.read("fact_measurements").count() == total
            few = store.read("fact_measurements").filter(F.dayofmonth("event_time") == 3)
            store.overwrite("fact_measurements", few)
            assert store.read("fact_measurements").count() == n < total
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_few_files_a_day(spark, tmp_dir):
    from tidewater.plans.warehouse import replay

    store = TableStore(spark, f"{tmp_dir}/tables")
    store.append("fact_measurements", replay(telemetry.load_measurements(spark, SF)).fact.repartition(8))
    assert store.file_count("fact_measurements") <= 2 * len(store.days("fact_measurements")) + 1


def test_catalog_tables(spark, tmp_dir):
    store = TableStore(spark, f"{tmp_dir}/tables")
    name = "t" + tmp_dir.rsplit("-", 1)[-1].lower()
    store.create_tables(name)
    store.append("staging_events", telemetry.load_measurements(spark, SF))
    store.create_tables(name)  # idempotent; finds the new days
    assert spark.table(f"{name}.staging_events").count() == store.read("staging_events").count()
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_compaction_reduces_files_keeps_rows(spark, tmp_dir):
    store = TableStore(spark, f"{tmp_dir}/tables")
    readings = telemetry.load_measurements(spark, SF)
    from tidewater.plans.warehouse import replay

    fact = replay(readings).fact
    for _ in range(3):
        store.append("fact_measurements", fact.filter(F.dayofmonth("event_time") >= 28).repartition(8))
    before_rows = store.read("fact_measurements").count()
    before_files = store.file_count("fact_measurements")
    newest = readings.agg(F.max("event_time")).first()[0]
    assert compact_recent(store, "fact_measurements", newest.date(), days=2) >= 1
    assert store.read("fact_measurements").count() == before_rows
    assert store.file_count("fact_measurements") < before_files
    # a compaction dated earlier leaves later days alone
    newest_day = f"{store.path('fact_measurements')}/event_time_date={store.days('fact_measurements')[0]}"
    names = sorted(os.listdir(newest_day))
    compact_recent(store, "fact_measurements", newest.date() - dt.timedelta(days=1), days=1)
    assert sorted(os.listdir(newest_day)) == names
    assert store.read("fact_measurements").count() == before_rows


def test_continuous_landing_trigger_and_views(spark, tmp_dir):
    readings = telemetry.load_measurements(spark, SF)
    publish_records(envelope.to_kafka_records(readings, 3), path=f"{tmp_dir}/broker")
    q = start_landing(record_file_source(spark, f"{tmp_dir}/broker", max_files_per_trigger=1), f"{tmp_dir}/raw",
                      f"{tmp_dir}/ck-land", processing_time="0 seconds")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    from tidewater.schemas import RAW_FILE

    landed = spark.read.schema(RAW_FILE).json(f"{tmp_dir}/raw")
    assert landed.count() == readings.count()
    assert envelope.flatten(landed).exceptAll(readings).count() == 0

    store = TableStore(spark, f"{tmp_dir}/tables")
    store.append("staging_events", readings)
    store.publish_views()
    assert spark.sql("SELECT count(*) AS n FROM staging_events").first().n == readings.count()


def test_many_micro_batches_keep_invariants(spark, tmp_dir):
    readings = telemetry.load_measurements(spark, SF)
    publish_records(envelope.to_kafka_records(readings, 3).repartition(6), path=f"{tmp_dir}/broker")
    q = start_landing(record_file_source(spark, f"{tmp_dir}/broker"), f"{tmp_dir}/raw", f"{tmp_dir}/ck-land",
                      available_now=True)
    q.awaitTermination()
    store = TableStore(spark, f"{tmp_dir}/tables")
    newest = readings.agg(F.max("event_time")).first()[0]
    job = run(spark, f"{tmp_dir}/raw", store, f"{tmp_dir}/ck", as_of=newest, clock=_clock(),
              max_files_per_trigger=60)
    assert job.batches > 1
    n = readings.select("event_time", "iot_device_id").distinct().count()
    fact = store.read("fact_measurements")
    assert fact.count() == n and fact.select("event_time", "iot_device_id").distinct().count() == n
    for name in ("dim_iot_device", "dim_country"):
        dim = store.read(name)
        assert dim.filter("is_current").groupBy("iot_device_id").count().filter("count > 1").count() == 0
        from pyspark.sql import Window

        w = Window.partitionBy("iot_device_id").orderBy("effective_start")
        gaps = dim.withColumn("nxt", F.lead("effective_start").over(w)).filter(
            F.col("nxt").isNotNull() & ~F.col("effective_end").eqNullSafe(F.col("nxt")))
        assert gaps.count() == 0
    # every fact row points at a version that existed when its batch was merged
    dev = store.read("dim_iot_device").select("device_sk")
    assert fact.join(dev, "device_sk", "left_anti").count() == 0


def test_event_time_versioning_in_the_job(spark, tmp_dir):
    readings = telemetry.load_measurements(spark, SF)
    store = TableStore(spark, f"{tmp_dir}/tables")
    job = WarehouseJob(spark, store, clock=_clock(), effective_from="event_time", row_key_kind="content")
    late = readings.filter(F.dayofmonth("event_time") <= 10)
    job.process(readings.filter(F.dayofmonth("event_time") > 10), 0)
    before = sorted(map(tuple, store.read("dim_iot_device").filter("is_current").collect()))
    job.process(late, 1)  # an older batch arriving late changes no current state
    after = sorted(map(tuple, store.read("dim_iot_device").filter("is_current").collect()))
    newer_devices = {r[1] for r in before}
    assert [r for r in after if r[1] in newer_devices] == before
    assert store.read("fact_measurements").count() == readings.count()


def test_device_level_raw_zone_and_random_row_keys(spark, tmp_dir):
    from tidewater.streaming.landing import DEVICE_PARTITION_COLUMNS

    readings = telemetry.load_measurements(spark, SF).filter(F.dayofmonth("event_time") == 5)
    publish_records(envelope.to_kafka_records(readings, 3), path=f"{tmp_dir}/broker")
    q = start_landing(record_file_source(spark, f"{tmp_dir}/broker"), f"{tmp_dir}/raw", f"{tmp_dir}/ck-land",
                      available_now=True, partition_columns=DEVICE_PARTITION_COLUMNS)
    q.awaitTermination()
    day = next(d for d in os.listdir(f"{tmp_dir}/raw") if d.startswith("ingestion_date="))
    assert any(d.startswith("iot_device_id=") for d in os.listdir(f"{tmp_dir}/raw/{day}"))
    store = TableStore(spark, f"{tmp_dir}/tables")
    run(spark, f"{tmp_dir}/raw", store, f"{tmp_dir}/ck", as_of=dt.datetime(2024, 1, 31), clock=_clock())
    fact = store.read("fact_measurements")
    assert fact.count() == readings.select("event_time", "iot_device_id").distinct().count()
    assert fact.select("fact_sk").distinct().count() == fact.count()  # random keys by default


def test_utc_text_in_any_session_zone(spark):
    from tidewater.functions import timefn

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = spark.range(1).select(timefn.format_iso_utc(F.timestamp_seconds(F.lit(1704448800)))).first()[0]
            assert got == "2024-01-05T10:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_broker_source_options():
    """The connector is absent here: the calls that make the source are recorded instead."""
    from tidewater.streaming.landing import kafka_source

    class Reader:
        def __init__(self):
            self.options, self.kind = {}, None

        def format(self, kind):
            self.kind = kind
            return self

        def option(self, key, value):
            self.options[key] = value
            return self

        def load(self):
            return self

    class Session:
        readStream = Reader()

    source = kafka_source(Session(), "broker:9092", "iot-sensor-data")
    assert source.kind == "kafka"
    assert source.options["kafka.bootstrap.servers"] == "broker:9092" and source.options["subscribe"] == "iot-sensor-data"
    assert source.options["startingOffsets"] == "earliest" and str(source.options["failOnDataLoss"]).lower() == "false"
