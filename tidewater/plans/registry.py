"""Named queries over the shared test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the given tables (through ``sources.telemetry``), so its work grows with
them.  ``tidewater.checks.oracle_sql`` holds the DuckDB mirror of every entry.

Averages that are not rounded by the query itself are rounded to
``CHECK_DIGITS`` decimals here (and in the mirror) so that comparisons do not
depend on floating-point summation order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewater.functions import geo, measures, timefn
from tidewater.functions.keys import surrogate_key
from tidewater.operators import calendar, facts, merge, rollup, scd2
from tidewater.operators.dedup import latest_per_key
from tidewater.plans import panels
from tidewater.plans.warehouse import Warehouse, dedup_batch, replay, weekly_batch
from tidewater.sources import envelope, telemetry

CHECK_DIGITS = 9
SELECTED_DEVICES = (3, 7, 12, 31)
SELECTED_COUNTRIES = ("US", "JP", "DE", "BR", "AU", "IN")

Query = Callable[[SparkSession, str], DataFrame]


def _r(c: Column | str, digits: int = CHECK_DIGITS) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def _round_doubles(df: DataFrame, digits: int = CHECK_DIGITS) -> DataFrame:
    return df.select(*[
        _r(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.schema.fields
    ])


# --- shared inputs -------------------------------------------------------------


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.load_measurements(spark, sf_dir)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """De-duplicated readings (the staging table of a full load)."""
    return dedup_batch(raw_readings(spark, sf_dir))


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return replay(raw_readings(spark, sf_dir), deduplicate=True)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).fact


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.hourly_rollup(fact(spark, sf_dir))


def newest_instant(store, name: str = "fact_measurements"):
    """The newest event time, read from the newest day only (found in the
    folder listing); a Python value, so that panels prune with a literal."""
    for day in store.days(name):
        newest = store.read_day(name, day).agg(F.max("event_time")).first()[0]
        if newest is not None:
            return newest
    return None


def _literal(instant) -> Column:
    return F.lit(instant).cast("timestamp")


# --- ingestion and staging -----------------------------------------------------


def q_flatten_envelope(spark, sf_dir):
    """Readings -> gateway JSON -> flatten back."""
    raw = envelope.to_raw_json(raw_readings(spark, sf_dir))
    return envelope.flatten(raw)


def q_raw_landing(spark, sf_dir):
    """Kafka records -> text payload -> raw-zone partition columns."""
    rec = envelope.to_kafka_records(raw_readings(spark, sf_dir), partitions=6)
    landed = envelope.landing_columns(envelope.decode_payload(rec))
    return landed.select(
        F.col("key").cast("string").alias("key"),
        "partition",
        "ingestion_date",
        F.col("iot_device_id").alias("device_text"),
        F.get_json_object("raw_json", "$.data.dt").cast("long").alias("dt"),
    )


def q_dedup_keys(spark, sf_dir):
    """The stream delivered twice (retry 60 s later) -> one row per key."""
    once = raw_readings(spark, sf_dir)
    again = once.withColumn("ingestion_time", F.col("ingestion_time") + F.expr("INTERVAL 60 SECONDS"))
    return _round_doubles(dedup_batch(once.unionByName(again)))


def q_latest_per_device(spark, sf_dir):
    latest = latest_per_key(readings(spark, sf_dir), ["iot_device_id"], "event_time")
    return latest.select("iot_device_id", "event_time", "latitude", "longitude", "timezone")


def q_insert_if_absent(spark, sf_dir):
    """Two overlapping loads merged insert-only on (event_time, device)."""
    r = readings(spark, sf_dir)
    week = F.weekofyear("event_time")
    first = r.filter(week <= 3)
    second = r.filter(week >= 2)
    return _round_doubles(merge.insert_if_absent(first, second, ["event_time", "iot_device_id"]))


def q_dim_date(spark, sf_dir):
    """Calendar from the first half of the stream, then upserted with all."""
    r = readings(spark, sf_dir)
    first_half = calendar.calendar_rows(r.filter(F.dayofmonth("event_time") <= 15))
    return calendar.upsert_dates(first_half, r)


# --- lookups -------------------------------------------------------------------


def _jittered(spark, sf_dir):
    ev = telemetry.read_table(spark, sf_dir, "events")
    station = telemetry.station_of(F.col("user_id"), F.col("ts"))
    lat = telemetry.station_coordinate(station, "lat") + (F.pmod(F.col("event_id"), F.lit(21)) - 10) * 0.5
    lon = telemetry.station_coordinate(station, "lon") + (F.pmod(F.col("event_id"), F.lit(17)) - 8) * 0.5
    return ev.select("event_id", lat.alias("latitude"), lon.alias("longitude"))


def q_country_lookup(spark, sf_dir):
    """Ordered first-match box lookup around every reading's station."""
    pts = _jittered(spark, sf_dir)
    return pts.select("event_id", "latitude", "longitude", geo.country_of("latitude", "longitude").alias("c")).select(
        "event_id", "latitude", "longitude", "c.*"
    )


def q_country_lookup_join(spark, sf_dir):
    """The same lookup as a range join against the box table (J8, join form)."""
    from tidewater.operators.range_lookup import lookup_boxes

    pts = _jittered(spark, sf_dir)
    return lookup_boxes(pts, geo.boxes_frame(spark), "latitude", "longitude").select(
        "event_id", "latitude", "longitude", "country_code", "country_name", "city"
    )


def q_timezone_lookup(spark, sf_dir):
    """Half-open longitude bands over longitudes spread across the globe."""
    ev = telemetry.read_table(spark, sf_dir, "events")
    lon = F.pmod(F.col("value") * 7, F.lit(360.0)) - 180
    return ev.select("event_id", lon.alias("longitude")).withColumn("timezone", geo.timezone_of("longitude"))


# --- dimensions and facts ------------------------------------------------------


def q_scd2_device(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_device


def q_scd2_country(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_country


def _incremental(spark, sf_dir) -> Warehouse:
    """Feed the stream to the warehouse job as weekly micro-batches.

    Exactly what the streaming job does per ``foreachBatch`` call, with the
    batch instant as its clock: tables are appended to (dimensions replaced)
    in a table store under the shared checkpoint folder, so the cost per
    batch does not grow with the history already loaded.  The batch instants
    come from the data's first and last week (two scalars).
    """
    import datetime as dt

    from tidewater.sources.tables import TableStore
    from tidewater.streaming.pipeline import WarehouseJob

    week = dt.timedelta(days=7)
    r = raw_readings(spark, sf_dir)
    lo, hi = r.select(F.min(weekly_batch()), F.max(weekly_batch())).first()
    store = TableStore(spark, _scratch(spark, "incremental"))
    now = {"t": lo}
    job = WarehouseJob(spark, store, row_key_kind="content", clock=lambda: now["t"])
    batch_id = 0
    while lo is not None and now["t"] <= hi:
        # bounds on the event table's own time column reach its scan
        part = telemetry.read_table(spark, sf_dir, "events").filter(
            (F.col("ts") >= F.lit(now["t"] - week)) & (F.col("ts") < F.lit(now["t"]))
        )
        job.process(telemetry.measurements(part), batch_id)
        now["t"] = now["t"] + week
        batch_id += 1
    return Warehouse(
        staging=store.read("staging_events"),
        dim_date=store.read("dim_date"),
        dim_device=store.read("dim_iot_device"),
        dim_country=store.read("dim_country"),
        fact=store.read("fact_measurements"),
    )


def _incremental_run(spark, sf_dir) -> Warehouse:
    return _memo(spark, sf_dir, "incremental", lambda: _incremental(spark, sf_dir))


def q_scd2_device_incremental(spark, sf_dir):
    return _incremental_run(spark, sf_dir).dim_device


def q_scd2_country_incremental(spark, sf_dir):
    return _incremental_run(spark, sf_dir).dim_country


def _spliced(spark, sf_dir):
    """The weekly batches in an order that isn't that of time, with dimensions
    whose versions follow event time (D2-D4, X4)."""
    from tidewater.sources.tables import TableStore
    from tidewater.streaming.pipeline import WarehouseJob

    def build():
        store = TableStore(spark, _scratch(spark, "spliced"))
        r = raw_readings(spark, sf_dir)
        lo, hi = r.select(F.min(weekly_batch()), F.max(weekly_batch())).first()
        job = WarehouseJob(spark, store, row_key_kind="content", effective_from="spliced", keys="as_of")
        weeks = [] if lo is None else [lo + dt.timedelta(days=7 * i) for i in range((hi - lo).days // 7 + 1)]
        for batch_id, week in enumerate([*weeks[1::2][::-1], *weeks[0::2]]):
            part = telemetry.read_table(spark, sf_dir, "events").filter(
                (F.col("ts") >= F.lit(week - dt.timedelta(days=7))) & (F.col("ts") < F.lit(week))
            )
            job.process(telemetry.measurements(part), batch_id)
        return store

    return _memo(spark, sf_dir, "spliced", build)


def q_scd2_device_spliced(spark, sf_dir):
    return _spliced(spark, sf_dir).read("dim_iot_device")


def q_scd2_country_spliced(spark, sf_dir):
    return _spliced(spark, sf_dir).read("dim_country")


def q_fact_load_asof(spark, sf_dir):
    """Readings with the versions valid at their event time."""
    store = _spliced(spark, sf_dir)
    dims = [store.read(name) for name in ("dim_iot_device", "dim_country")]
    return _round_doubles(facts.load_fact_asof(store.read("staging_events"), *dims, "content"))


def q_fact_load(spark, sf_dir):
    return _round_doubles(fact(spark, sf_dir))


def q_fact_load_incremental(spark, sf_dir):
    return _round_doubles(_incremental_run(spark, sf_dir).fact)


def q_rollup_hourly(spark, sf_dir):
    return _round_doubles(hourly(spark, sf_dir))


def q_upsert_hourly(spark, sf_dir):
    """A rollup computed 3 hours before the newest event, refreshed over the
    trailing 2-hour window of the stored fact table (J7, T9, T10): older
    partial hours keep their stale values, recent hours are recomputed."""
    store = _served(spark, sf_dir)
    f = store.read_with_day("fact_measurements")
    as_of = _literal(newest_instant(store))
    stale = rollup.hourly_rollup(f.filter(F.col("event_time") < as_of - F.expr("INTERVAL 3 HOURS")))
    recent = f.filter(F.col("event_time_date") >= F.to_date(rollup.window_start(as_of)))
    return _round_doubles(rollup.refresh_hourly(stale, recent.drop("event_time_date"), as_of))


def q_rollup_touched(spark, sf_dir):
    """Rollup of all but the last week, then every (hour, device) touched by a
    late batch -- the last week, and the first one sent again -- recomputed
    however old it is (X6): the full rollup."""
    store = _served(spark, sf_dir)
    f = store.read("fact_measurements")
    newest = _literal(newest_instant(store))
    oldest = _literal(store.read_day("fact_measurements", store.days("fact_measurements")[-1]).agg(F.min("event_time")).first()[0])
    split = newest - F.expr("INTERVAL 7 DAYS")
    early = rollup.hourly_rollup(f.filter(F.col("event_time") < split))
    late_batch = f.filter((F.col("event_time") >= split) | (F.col("event_time") < oldest + F.expr("INTERVAL 7 DAYS")))
    return _round_doubles(rollup.refresh_touched(early, f, late_batch))


def q_rollup_by_country(spark, sf_dir):
    """Three-key form: one row per (hour, device, country) (A1 as grouped by 1, 2, 3)."""
    return _round_doubles(rollup.hourly_rollup_by_country(_served(spark, sf_dir).read("fact_measurements")))


# --- serving panels --------------------------------------------------------------


def _served(spark, sf_dir):
    """The warehouse written once per session as day-partitioned parquet
    tables in the shared checkpoint folder -- what serving queries read in
    production -- instead of being recomputed by every query."""
    from tidewater.sources.tables import TableStore

    def build():
        store = TableStore(spark, _scratch(spark, "served"))
        wh = warehouse(spark, sf_dir)
        store.overwrite("fact_measurements", wh.fact, {"fact_sk": facts.row_key("content")})
        store.overwrite("dim_iot_device", wh.dim_device)
        store.overwrite("dim_country", wh.dim_country)
        store.overwrite("fact_hourly_agg", rollup.hourly_rollup(store.read("fact_measurements")))
        store.overwrite("fact_hourly_devices", rollup.device_sketches(store.read("fact_measurements")))
        store.note_zones(store.read("fact_measurements"))
        return store

    return _memo(spark, sf_dir, "served", build)


def _panel_fact(spark, sf_dir):
    store = _served(spark, sf_dir)
    return store.read_with_day("fact_measurements"), _literal(newest_instant(store))


def _panel_hourly(spark, sf_dir):
    store = _served(spark, sf_dir)
    return store.read_with_day("fact_hourly_agg"), _literal(newest_instant(store))


def q_device_series(metric, spark, sf_dir, devices=None):
    f, as_of = _panel_fact(spark, sf_dir)
    return _round_doubles(panels.device_series(f, metric, as_of, devices))


def q_hourly_device_series(column, spark, sf_dir, devices=None):
    h, as_of = _panel_hourly(spark, sf_dir)
    return _round_doubles(panels.hourly_device_series(h, column, as_of, devices))


def q_active_devices(spark, sf_dir):
    f, as_of = _panel_fact(spark, sf_dir)
    return panels.active_devices(f, as_of)


def q_events_ingested(spark, sf_dir):
    f, as_of = _panel_fact(spark, sf_dir)
    return panels.events_ingested(f, as_of)


def q_latest_event_time(spark, sf_dir):
    return panels.latest_event_time_stored(_served(spark, sf_dir))


def q_active_devices_approx(spark, sf_dir):
    """Distinct devices of the last day from the hourly sketches (A4 opt-in; Q12, Q20)."""
    store = _served(spark, sf_dir)
    return panels.active_devices_approx(store.read_with_day("fact_hourly_devices"), _literal(newest_instant(store)))


def q_devices_reporting_approx(spark, sf_dir):
    store = _served(spark, sf_dir)
    sketches = store.read_with_day("fact_hourly_devices")
    return panels.active_devices_approx(sketches, _literal(newest_instant(store)), 48, SELECTED_COUNTRIES)


def q_ingestion_lag(spark, sf_dir):
    store = _served(spark, sf_dir)
    return panels.ingestion_lag_stored(store, _literal(newest_instant(store)))


def q_device_summary(spark, sf_dir):
    f, as_of = _panel_fact(spark, sf_dir)
    return panels.device_summary(f, as_of)


def q_device_picker(spark, sf_dir):
    return panels.device_picker(_served(spark, sf_dir).read("dim_iot_device"))


def q_active_countries(spark, sf_dir):
    f, as_of = _panel_fact(spark, sf_dir)
    return panels.active_countries(f, as_of)


def q_events_by_country(spark, sf_dir):
    f, as_of = _panel_fact(spark, sf_dir)
    return panels.events_ingested(f, as_of, SELECTED_COUNTRIES)


def q_devices_reporting(spark, sf_dir):
    f, as_of = _panel_fact(spark, sf_dir)
    return panels.active_devices(f, as_of, SELECTED_COUNTRIES)


def q_latest_event_time_by_country(spark, sf_dir):
    return panels.latest_event_time_stored(_served(spark, sf_dir), SELECTED_COUNTRIES)


def q_ingestion_lag_by_country(spark, sf_dir):
    store = _served(spark, sf_dir)
    return panels.ingestion_lag_stored(store, _literal(newest_instant(store)), SELECTED_COUNTRIES)


def q_metric_by_minute(metric, spark, sf_dir, countries=None):
    f, as_of = _panel_fact(spark, sf_dir)
    return _round_doubles(panels.metric_by_minute(f, metric, as_of, countries))


def q_hourly_metric_by_country(metric, spark, sf_dir, countries=None):
    h, as_of = _panel_hourly(spark, sf_dir)
    return _round_doubles(panels.hourly_metric_by_country(h, metric, as_of, countries))


def q_device_series_long(spark, sf_dir):
    """Several metrics per device in one pass, long format (P14 with unpivot)."""
    f, as_of = _panel_fact(spark, sf_dir)
    return _round_doubles(panels.device_series_long(f, ["temp", "humidity", "rain_1h", "wind_gust"], as_of))


def q_hourly_metric_by_country_avg(spark, sf_dir):
    """Q24's aggregated variant: one value per (hour, country)."""
    h, as_of = _panel_hourly(spark, sf_dir)
    return _round_doubles(panels.hourly_metric_by_country_avg(h, "temp", as_of))


def q_country_overview(spark, sf_dir):
    f, as_of = _panel_fact(spark, sf_dir)
    return panels.country_overview(f, as_of)


def q_country_overview_selected(spark, sf_dir):
    f, as_of = _panel_fact(spark, sf_dir)
    return panels.country_overview(f, as_of, SELECTED_COUNTRIES)


def q_country_picker(spark, sf_dir):
    return panels.country_picker(_served(spark, sf_dir).read("dim_country"))


# --- reducers, status, measurement rules ----------------------------------------------


def q_series_reducers(spark, sf_dir):
    """mean / last / max of every device's temperature series, whole history (A10)."""
    f = _served(spark, sf_dir).read("fact_measurements")
    series = f.select(F.col("event_time").alias("time"), F.col("iot_device_id").cast("string").alias("metric"),
                      F.col("temp").alias("value"))
    return _round_doubles(panels.series_reducers(series))


def q_last_not_null(spark, sf_dir):
    """Latest non-NULL wind gust per device, whole history."""
    f = _served(spark, sf_dir).read("fact_measurements")
    series = f.select(F.col("event_time").alias("time"), F.col("iot_device_id").cast("string").alias("metric"),
                      F.col("wind_gust").alias("value"))
    return _round_doubles(panels.last_not_null(series))


def q_status_thresholds(spark, sf_dir):
    """Stat panels with their red/yellow/green status."""
    f, as_of = _panel_fact(spark, sf_dir)
    parts = [
        panels.with_status(panels.active_devices(f, as_of), "active_devices").withColumn("panel", F.lit("active_devices")),
        panels.with_status(panels.active_countries(f, as_of), "active_countries").withColumn("panel", F.lit("active_countries")),
        panels.with_status(panels.active_devices(f, as_of, SELECTED_COUNTRIES), "devices_reporting")
        .withColumn("panel", F.lit("devices_reporting")),
        panels.with_status(panels.ingestion_lag(f, as_of), "ingestion_lag_seconds")
        .withColumn("panel", F.lit("ingestion_lag_seconds")),
    ]
    out = parts[0].select("panel", F.col("value").cast("long").alias("value"), "status")
    for p in parts[1:]:
        out = out.unionByName(p.select("panel", F.col("value").cast("long").alias("value"), "status"))
    return out


def _spiky(spark, sf_dir) -> DataFrame:
    """Raw sensor values before clamping: scaled so that some fall outside
    the physical bounds."""
    ev = telemetry.read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    eid = F.col("event_id")
    v = F.col("value")
    return ev.select(
        "event_id",
        (v / 5 - 20).alias("temp"),
        (v / 5 - 25).alias("feels_like"),
        (v / 5 - 70).alias("dew_point"),
        (F.lit(800.0) + F.pmod(eid, F.lit(400)) + 0.5).alias("pressure"),
        (k * 1.5 - 20.5).alias("humidity"),
        (v / 25).alias("uvi"),
        (k * 1.25 - 5.5).alias("clouds"),
        (F.pmod(eid * 37, F.lit(12000)) + 0.5).alias("visibility"),
        (v / 20 - 2).alias("wind_speed"),
        (v / 15 - 3).alias("wind_gust"),
        (eid * 1.7).alias("wind_deg"),
    )


def q_clamp_bounds(spark, sf_dir):
    """Physical bounds per metric; whole-number metrics rounded half-even."""
    raw = _spiky(spark, sf_dir)
    return _round_doubles(raw.select("event_id", *[measures.clamp_metric(m, m).alias(m) for m in measures.BOUNDS]))


def q_normalise_metrics(spark, sf_dir):
    """Direction wrapped to [0, 360) and dew point capped by temperature."""
    raw = _spiky(spark, sf_dir)
    temp = measures.clamp_metric("temp", "temp")
    dew = measures.clamp_metric("dew_point", "dew_point")
    return _round_doubles(raw.select(
        "event_id",
        measures.wrap_degrees("wind_deg").alias("wind_deg"),
        measures.cap_dew_point(dew, temp).alias("dew_point"),
    ))


def q_event_time_format(spark, sf_dir):
    """ISO-8601 UTC text of event and ingestion times, date keys, weekday."""
    r = raw_readings(spark, sf_dir)
    return r.select(
        "iot_device_id",
        timefn.format_iso_utc("event_time").alias("event_iso"),
        timefn.ts_to_epoch("event_time").alias("event_epoch"),
        timefn.date_key("event_time").alias("date_key"),
        timefn.iso_day_of_week("event_time").alias("iso_dow"),
        timefn.seconds_between("event_time", "ingestion_time").alias("lag_seconds"),
        surrogate_key("iot_device_id", "event_time").alias("row_key"),
    )


# --- streams, persistence, compaction ------------------------------------------------

_RUNS: dict[tuple, object] = {}


def _memo(spark: SparkSession, sf_dir: str, kind: str, build):
    """Share one expensive run (a stream, a replay loop) between the queries
    reading its outputs within one session."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _RUNS:
        _RUNS[key] = build()
    return _RUNS[key]


def _scratch(spark: SparkSession, name: str) -> str:
    from tidewater.session import ensure_local_fallback, scratch_path

    ensure_local_fallback(spark)
    return scratch_path(spark, name)


def _landed(spark, sf_dir) -> str:
    """Publish the readings as broker records (parquet stand-in), land them
    in the raw zone with the streaming landing job; returns the raw path."""
    from tidewater.streaming.landing import publish_records, record_file_source, start_landing

    def build():
        base = _scratch(spark, "landing")
        records = envelope.to_kafka_records(raw_readings(spark, sf_dir), partitions=6)
        publish_records(records, path=f"{base}/broker")
        q = start_landing(record_file_source(spark, f"{base}/broker"), f"{base}/raw", f"{base}/ckpt-landing",
                          available_now=True)
        q.awaitTermination()
        return f"{base}/raw"

    return _memo(spark, sf_dir, "landed", build)


def q_stream_landing(spark, sf_dir):
    """Broker -> raw zone (stream) -> flatten."""
    from tidewater.schemas import RAW_FILE

    raw = spark.read.schema(RAW_FILE).json(_landed(spark, sf_dir))
    return _round_doubles(envelope.flatten(raw))


def _stream_warehouse(spark, sf_dir):
    from tidewater.sources.tables import TableStore
    from tidewater.streaming.pipeline import run

    def build():
        import datetime as dt

        raw = _landed(spark, sf_dir)
        base = _scratch(spark, "warehouse")
        store = TableStore(spark, f"{base}/tables")
        newest = raw_readings(spark, sf_dir).agg(F.max("event_time")).first()[0]
        run(spark, raw, store, f"{base}/ckpt-staging", as_of=newest, row_key_kind="content",
            clock=lambda: dt.datetime(2100, 1, 1))
        return store

    return _memo(spark, sf_dir, "stream_warehouse", build)


def q_stream_warehouse_fact(spark, sf_dir):
    """Raw zone -> staging stream -> foreachBatch fan-out -> fact."""
    return _round_doubles(_stream_warehouse(spark, sf_dir).read("fact_measurements"))


def q_stream_warehouse_hourly(spark, sf_dir):
    """Hourly rollup of every hour the stream touched, refreshed after it drains."""
    return _round_doubles(_stream_warehouse(spark, sf_dir).read("fact_hourly_agg"))


def q_stream_warehouse_dims(spark, sf_dir):
    """Current device and country rows after the streamed load."""
    st = _stream_warehouse(spark, sf_dir)
    dev = st.read("dim_iot_device").filter("is_current").select("iot_device_id", "latitude", "longitude", "timezone")
    cty = st.read("dim_country").filter("is_current").select("iot_device_id", "country_code", "country_name", "city")
    return dev.join(cty, "iot_device_id")


def q_compaction(spark, sf_dir):
    """Fact written in several appends, last two days compacted."""
    from tidewater.operators.compaction import compact_recent
    from tidewater.sources.tables import TableStore

    def build():
        store = TableStore(spark, _scratch(spark, "compaction"))
        f = fact(spark, sf_dir).persist()
        for part in range(4):  # small files: each append leaves one a day at least
            store.append("fact_measurements", f.filter(F.pmod(F.xxhash64("fact_sk"), F.lit(4)) == part))
        f.unpersist()
        compact_recent(store, "fact_measurements", newest_instant(store).date(), days=2)
        return store

    store = _memo(spark, sf_dir, "compaction", build)
    return _round_doubles(store.read("fact_measurements"))


def q_catalog_tables(spark, sf_dir):
    """Readings by country and day from a catalog table over the stored files."""

    def build():
        store = _served(spark, sf_dir)
        database = "telemetry_" + store.root.rsplit("-", 1)[1]
        for _ in range(2):  # IF NOT EXISTS: the second call changes nothing
            store.create_tables(database)
        return database

    database = _memo(spark, sf_dir, "catalog", build)
    by_day = spark.table(f"{database}.fact_measurements").groupBy("country_code", F.col("event_time_date").alias("day"))
    return by_day.agg(F.count(F.lit(1)).alias("events"), F.count_distinct("iot_device_id").alias("devices"))


def q_published_views(spark, sf_dir):
    """Current devices with their readings, from views published over the stored tables."""
    _served(spark, sf_dir).publish_views()
    return spark.sql("""
        SELECT d.iot_device_id, d.timezone, count(*) AS events
        FROM dim_iot_device d JOIN fact_measurements f ON f.iot_device_id = d.iot_device_id
        WHERE d.is_current GROUP BY 1, 2
    """)


def q_random_row_keys(spark, sf_dir):
    """Facts keyed by a random UUID: as many keys as readings, all well formed."""
    keyed = replay(raw_readings(spark, sf_dir), deduplicate=True, row_key_kind="uuid").fact
    form = F.col("fact_sk").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return keyed.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("fact_sk").alias("n_keys"), F.count_if(form).alias("n_formed")
    )


def _readings_files(spark, sf_dir, copies: int) -> str:
    """The readings as several files without order in time; ``copies`` deliveries one after the other."""

    def build():
        path = _scratch(spark, f"readings-x{copies}")
        r = raw_readings(spark, sf_dir)
        rows = max(1, r.count() // 5)  # at least five files a delivery
        for i in range(copies):
            shifted = r.withColumn("ingestion_time", F.col("ingestion_time") + F.expr(f"INTERVAL {60 * i} SECONDS"))
            mixed = shifted.sortWithinPartitions(F.xxhash64("iot_device_id", "event_time"))
            mixed.write.mode("append").option("maxRecordsPerFile", rows).parquet(path)
        return path

    return _memo(spark, sf_dir, f"readings-x{copies}", build)


def _file_stream(spark, path: str, copies: int = 1) -> DataFrame:
    """About five micro-batches a delivery.

    A batch without order in time is merged with all stored days.  Large input
    comes in more files (one a task at least), so with a file a batch the reads
    of the stored days would grow faster than the input.
    """
    from tidewater.schemas import STAGING
    from tidewater.sources.tables import TableStore

    folder, name = path.rsplit("/", 1)
    files = TableStore(spark, folder).data_files(name)
    per_batch = max(1, round(files / (5 * copies)))
    return spark.readStream.schema(STAGING).option("maxFilesPerTrigger", per_batch).parquet(path)


def q_stream_rollup(spark, sf_dir):
    """Hourly rollup kept up to date over several micro-batches without order in time."""
    from tidewater.sources.tables import TableStore
    from tidewater.streaming.rollup_stream import start_hourly_upsert

    def build():
        src = _readings_files(spark, sf_dir, 1)
        store = TableStore(spark, _scratch(spark, "stream-rollup"))
        start_hourly_upsert(_file_stream(spark, src), store, _scratch(spark, "ckpt-rollup")).awaitTermination()
        return store

    return _round_doubles(_memo(spark, sf_dir, "stream_rollup", build).read("fact_hourly_agg"))


def _deduplicated(spark, sf_dir):
    """Every reading delivered twice, in several micro-batches, stored once; the hours noted."""
    from tidewater.sources.tables import TableStore
    from tidewater.streaming.rollup_stream import start_dedup

    def build():
        src = _readings_files(spark, sf_dir, 2)
        store = TableStore(spark, _scratch(spark, "stream-dedup"))
        start_dedup(_file_stream(spark, src, 2), store, _scratch(spark, "ckpt-dedup"), note_hours=True).awaitTermination()
        return store

    return _memo(spark, sf_dir, "stream_dedup", build)


def q_stream_dedup(spark, sf_dir):
    """Every reading delivered twice, in several micro-batches: one row each, the first to arrive."""
    return _round_doubles(_deduplicated(spark, sf_dir).read("staging_events"))


def q_stream_rollup_window(spark, sf_dir):
    """Hourly rollup by event-time windows with a watermark, over micro-batches without
    order in time; what came after its hour was closed is repaired (T9, T10)."""
    from tidewater.streaming.rollup_stream import repair_hours, start_window_rollup

    def build():
        store = _deduplicated(spark, sf_dir)
        files = max(1, store.file_count("staging_events") // 6)
        start_window_rollup(store, _scratch(spark, "ckpt-windows"), max_files=files).awaitTermination()
        repair_hours(store)
        return store

    return _round_doubles(_memo(spark, sf_dir, "stream_rollup_window", build).read("fact_hourly_agg"))


def q_stream_last_not_null(spark, sf_dir):
    """Latest non-NULL wind gust per device as keyed stream state, over unordered
    micro-batches with a restart in between (A11)."""
    from tidewater.sources.tables import TableStore
    from tidewater.streaming.last_reading import start_last_not_null

    def build():
        src = _readings_files(spark, sf_dir, 1)
        store, checkpoint = TableStore(spark, _scratch(spark, "last")), _scratch(spark, "ckpt-last")
        early = spark.readStream.schema(_file_stream(spark, src).schema).option("maxFilesPerTrigger", 2)
        start_last_not_null(early.parquet(src), F.col("wind_gust"), store, checkpoint).awaitTermination()
        # started again from its checkpoint: nothing is new, the state and the table stay
        start_last_not_null(early.parquet(src), F.col("wind_gust"), store, checkpoint).awaitTermination()
        return store

    last = _memo(spark, sf_dir, "stream_last", build).read("device_last")
    return last.select(F.col("iot_device_id").cast("string").alias("metric"), _r("value").alias("value"))


def _broken(r: DataFrame) -> DataFrame:
    """The readings with the device or the time of some lost."""
    k = F.pmod(F.unix_timestamp("event_time") + F.col("iot_device_id"), F.lit(10))
    return r.withColumns({
        "event_time": F.when(k != 3, F.col("event_time")),
        "iot_device_id": F.when(k != 7, F.col("iot_device_id")),
    })


def _quarantine_job(spark, sf_dir):
    from tidewater.sources.tables import TableStore
    from tidewater.streaming.pipeline import WarehouseJob

    def build():
        import datetime as dt

        store = TableStore(spark, _scratch(spark, "broken"))
        job = WarehouseJob(spark, store, row_key_kind="content", clock=lambda: dt.datetime(2100, 1, 1))
        for _ in range(2):  # the batch and its replay
            job.process(_broken(raw_readings(spark, sf_dir)), 0)
        return job

    return _memo(spark, sf_dir, "broken", build)


def q_quarantine(spark, sf_dir):
    """Readings without device or time, set aside once though the batch is replayed."""
    return _round_doubles(_quarantine_job(spark, sf_dir).quarantined())


def q_quarantine_staging(spark, sf_dir):
    """What the same batch left in staging."""
    return _round_doubles(_quarantine_job(spark, sf_dir).store.read("staging_events"))


#: Runs that several queries read; each is made once a session.
BUILDS = {
    "served": _served,
    "incremental": _incremental_run,
    "spliced": _spliced,
    "landed": _landed,
    "stream_warehouse": _stream_warehouse,
    "quarantine": _quarantine_job,
    "stream_dedup": _deduplicated,
}

# --- registry ----------------------------------------------------------------------

SERIES_METRICS = ("temp", "humidity", "pressure", "wind_speed", "uvi", "rain_1h", "wind_gust")
HOURLY_SERIES = ("avg_temp", "avg_humidity", "avg_wind_speed", "avg_pressure")


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "rollup_hourly": q_rollup_hourly,
        "flatten_envelope": q_flatten_envelope,
        "raw_landing": q_raw_landing,
        "dedup_keys": q_dedup_keys,
        "latest_per_device": q_latest_per_device,
        "insert_if_absent": q_insert_if_absent,
        "dim_date": q_dim_date,
        "country_lookup": q_country_lookup,
        "country_lookup_join": q_country_lookup_join,
        "timezone_lookup": q_timezone_lookup,
        "scd2_device": q_scd2_device,
        "scd2_country": q_scd2_country,
        "scd2_device_incremental": q_scd2_device_incremental,
        "scd2_country_incremental": q_scd2_country_incremental,
        "scd2_device_spliced": q_scd2_device_spliced,
        "scd2_country_spliced": q_scd2_country_spliced,
        "fact_load": q_fact_load,
        "fact_load_asof": q_fact_load_asof,
        "fact_load_incremental": q_fact_load_incremental,
        "upsert_hourly": q_upsert_hourly,
        "rollup_touched": q_rollup_touched,
        "rollup_by_country": q_rollup_by_country,
    }
    for m in SERIES_METRICS:
        q[f"panel_series_{m}"] = partial(q_device_series, m)
        q[f"panel_series_{m}_devices"] = partial(q_device_series, m, devices=SELECTED_DEVICES)
        q[f"panel_metric_by_minute_{m}"] = partial(q_metric_by_minute, m)
        q[f"panel_hourly_metric_by_country_{m}"] = partial(q_hourly_metric_by_country, m)
    for c in HOURLY_SERIES:
        q[f"panel_hourly_{c}"] = partial(q_hourly_device_series, c)
        q[f"panel_hourly_{c}_devices"] = partial(q_hourly_device_series, c, devices=SELECTED_DEVICES)
    for form, f in (("metric_by_minute", q_metric_by_minute), ("hourly_metric_by_country", q_hourly_metric_by_country)):
        q[f"panel_{form}_unknown"] = partial(f, "no_such_metric")
        q[f"panel_{form}_selected"] = partial(f, "temp", countries=SELECTED_COUNTRIES)
    q.update({
        "panel_active_devices": q_active_devices,
        "panel_events_ingested": q_events_ingested,
        "panel_latest_event_time": q_latest_event_time,
        "panel_ingestion_lag": q_ingestion_lag,
        "panel_device_summary": q_device_summary,
        "panel_device_picker": q_device_picker,
        "panel_active_countries": q_active_countries,
        "panel_events_by_country": q_events_by_country,
        "panel_devices_reporting": q_devices_reporting,
        "panel_latest_event_time_by_country": q_latest_event_time_by_country,
        "panel_ingestion_lag_by_country": q_ingestion_lag_by_country,
        "panel_device_series_long": q_device_series_long,
        "panel_hourly_metric_by_country_avg": q_hourly_metric_by_country_avg,
        "panel_country_overview": q_country_overview,
        "panel_country_overview_selected": q_country_overview_selected,
        "panel_country_picker": q_country_picker,
        "series_reducers": q_series_reducers,
        "last_not_null": q_last_not_null,
        "status_thresholds": q_status_thresholds,
        "clamp_bounds": q_clamp_bounds,
        "normalise_metrics": q_normalise_metrics,
        "event_time_format": q_event_time_format,
        "stream_landing": q_stream_landing,
        "stream_warehouse_fact": q_stream_warehouse_fact,
        "stream_warehouse_hourly": q_stream_warehouse_hourly,
        "stream_warehouse_dims": q_stream_warehouse_dims,
        "compaction": q_compaction,
        "catalog_tables": q_catalog_tables,
        "published_views": q_published_views,
        "random_row_keys": q_random_row_keys,
        "stream_rollup": q_stream_rollup,
        "stream_rollup_window": q_stream_rollup_window,
        "stream_last_not_null": q_stream_last_not_null,
        "panel_active_devices_approx": q_active_devices_approx,
        "panel_devices_reporting_approx": q_devices_reporting_approx,
        "stream_dedup": q_stream_dedup,
        "quarantine": q_quarantine,
        "quarantine_staging": q_quarantine_staging,
    })
    return q
