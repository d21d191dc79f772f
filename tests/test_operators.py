import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions import measures, timefn
from tidewater.operators import calendar, merge, rollup
from tidewater.operators.dedup import drop_duplicate_keys, latest_per_key, split_null_keys
from tidewater.schemas import FACT, HOURLY


def test_calendar_attributes(spark):
    days = [dt.datetime(2024, 1, d, 12) for d in (1, 6, 7)]  # Mon, Sat, Sun
    df = spark.createDataFrame([(d,) for d in days] + [(days[0],)], "event_time timestamp")
    rows = {r.date_key: r for r in calendar.calendar_rows(df).collect()}
    assert sorted(rows) == [20240101, 20240106, 20240107]
    mon, sat, sun = rows[20240101], rows[20240106], rows[20240107]
    assert (mon.day_of_week, mon.day_name, mon.is_weekend) == (1, "Monday", False)
    assert (sat.day_of_week, sat.is_weekend) == (6, True)
    assert (sun.day_of_week, sun.day_name, sun.is_weekend) == (7, "Sunday", True)
    assert (mon.month_name, mon.quarter, mon.week_of_year) == ("January", 1, 1)


def test_dates_insert_only(spark):
    a = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "event_time timestamp")
    b = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 2),)], "event_time timestamp")
    dim = calendar.upsert_dates(calendar.calendar_rows(a), b)
    dim2 = calendar.upsert_dates(dim, b)
    assert dim.count() == 2 and dim2.count() == 2


def test_insert_if_absent_and_upsert(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    ins = merge.insert_if_absent(t, s, ["k"])
    assert sorted(map(tuple, ins.collect())) == [(1, "a"), (2, "b"), (3, "C")]
    assert sorted(map(tuple, merge.insert_if_absent(ins, s, ["k"]).collect())) == sorted(map(tuple, ins.collect()))
    up = merge.upsert(t, s, ["k"])
    assert sorted(map(tuple, up.collect())) == [(1, "a"), (2, "B"), (3, "C")]


def test_null_keys_are_quarantined(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    good, bad = split_null_keys(df, ["k"])
    assert good.count() == 1 and bad.count() == 1


def test_dedup_deterministic_survivor(spark):
    df = spark.createDataFrame([(1, 5, "late"), (1, 3, "early"), (2, 1, "only")], "k int, ing int, v string")
    got = sorted(map(tuple, drop_duplicate_keys(df, ["k"], [F.col("ing")]).collect()))
    assert got == [(1, 3, "early"), (2, 1, "only")]
    latest = sorted(map(tuple, latest_per_key(df, ["k"], "ing").collect()))
    assert latest == [(1, 5, "late"), (2, 1, "only")]


def _fact_rows(spark, rows):
    cols = ["iot_device_id", "country_code", "event_time", "temp", "humidity"]
    base = spark.createDataFrame(rows, "iot_device_id int, country_code string, event_time timestamp, temp double, humidity int")
    for f in FACT.fields:
        if f.name not in cols:
            base = base.withColumn(f.name, F.lit(None).cast(f.dataType))
    return base.select(*FACT.fieldNames())


def test_rollup_one_row_per_device_hour_with_latest_country(spark):
    h = dt.datetime(2024, 1, 1, 10)
    f = _fact_rows(spark, [
        (1, "US", h + dt.timedelta(minutes=5), 10.0, 50),
        (1, "CA", h + dt.timedelta(minutes=40), 20.0, None),
        (2, "US", h + dt.timedelta(minutes=1), None, None),
    ])
    out = {r.iot_device_id: r for r in rollup.hourly_rollup(f).collect()}
    assert out[1].country_code == "CA" and out[1].avg_temp == 15.0 and out[1].avg_humidity == 50.0
    assert out[2].avg_temp is None
    assert rollup.hourly_rollup(f).schema == HOURLY


def test_refresh_overwrites_partial_hours_only(spark):
    h = dt.datetime(2024, 1, 1, 10)
    early = _fact_rows(spark, [(1, "US", h, 10.0, 1), (1, "US", h - dt.timedelta(hours=5), 1.0, 1)])
    stale = rollup.hourly_rollup(early)
    full = early.unionByName(_fact_rows(spark, [(1, "US", h + dt.timedelta(minutes=30), 30.0, 1),
                                                (1, "US", h - dt.timedelta(hours=5, minutes=-10), 3.0, 1)]))
    as_of = F.lit(h + dt.timedelta(minutes=59)).cast("timestamp")
    out = {r.hour_bucket: r.avg_temp for r in rollup.refresh_hourly(stale, full, as_of).collect()}
    assert out[h] == 20.0                              # inside the window: recomputed
    assert out[h - dt.timedelta(hours=5)] == 1.0       # older than the window: kept as stored


def test_clamp_and_normalise(spark):
    df = spark.createDataFrame([(70.0, 2.5, -10.0, 725.6, 5.0, 3.0), (None, 3.5, None, None, None, None)],
                               "temp double, hum double, ws double, deg double, dp double, t double")
    r = df.select(
        measures.clamp_metric("temp", "temp").alias("temp"),
        measures.clamp_metric("humidity", "hum").alias("hum"),
        measures.clamp_metric("wind_speed", "ws").alias("ws"),
        measures.wrap_degrees("deg").alias("deg"),
        measures.cap_dew_point("dp", "t").alias("dp"),
    ).collect()
    assert (r[0].temp, r[0].hum, r[0].ws, r[0].deg, r[0].dp) == (60.0, 2, 0.0, 6, 3.0)
    assert r[1].temp is None and r[1].hum == 4 and r[1].ws is None and r[1].deg is None


def test_status_steps(spark):
    df = spark.createDataFrame([(10,), (30,), (55,), (None,)], "v int")
    assert [r.s for r in df.select(measures.status("v", 30, 55, True).alias("s")).collect()] == ["red", "yellow", "green", None]
    lag = spark.createDataFrame([(0,), (120,), (300,)], "v int")
    assert [r.s for r in lag.select(measures.status("v", 120, 300, False).alias("s")).collect()] == ["green", "yellow", "red"]


def test_time_helpers(spark):
    df = spark.createDataFrame([(1704448800,)], "e long")
    r = df.select(timefn.epoch_to_ts("e").alias("t")).select(
        "t", timefn.format_iso_utc("t").alias("iso"), timefn.date_key("t").alias("k"),
        timefn.parse_iso(F.lit("2024-01-05T10:00:00Z")).alias("p"), timefn.parse_iso(F.lit("nope")).alias("bad"),
    ).first()
    assert r.iso == "2024-01-05T10:00:00Z" and r.k == 20240105 and r.p == r.t and r.bad is None


def test_rows_without_match_is_not_exists(spark):
    s = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    t = spark.createDataFrame([(1, True), (2, False)], "k int, is_current boolean")
    got = merge.rows_without_match(s, t, ["k"], F.col("is_current"))
    assert sorted(r.k for r in got.collect()) == [2, 3]
