"""Monitoring queries over the warehouse tables.

Every function takes DataFrames (``spark.table(...)`` or parquet reads) and
an explicit ``as_of`` instant (default: ``current_timestamp()``), and returns
a DataFrame.  Parameters are Python values resolved while planning, never
text spliced into SQL:

* ``devices`` / ``countries``: list of values, ``None`` = all.  Devices are
  compared as integers so the filter is pushed to the parquet scan.
* ``metric``: one of ``SELECTABLE_METRICS``; the choice is made in Python,
  so only the chosen column is read.  An unknown name yields NULL values.

Time-series results are ``(time, metric, value)`` ordered by time, then
series name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.functions.measures import (
    SELECTABLE_METRICS,
    STATUS_STEPS,
    hourly_metric_value,
    metric_value,
    status,
)
from tidewater.functions.timefn import minute_bucket, seconds_between

SERIES_WINDOW = "1 HOUR"
HOURLY_WINDOW = "24 HOURS"
ACTIVE_WINDOW = "5 MINUTES"
LAG_WINDOW = "10 MINUTES"


def _as_of(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def since(as_of: Column | None, window: str) -> Column:
    return _as_of(as_of) - F.expr(f"INTERVAL {window}")


def _in(col: str, values: Sequence | None) -> Column:
    return F.lit(True) if values is None else F.col(col).isin(list(values))


def _recent(df: DataFrame, as_of, window: str, time_col: str = "event_time") -> DataFrame:
    """Rows newer than ``as_of - window``.  When the table carries its day
    partition column (``<time_col>_date``, see ``TableStore.read_with_day``)
    the same bound is applied to it, so whole day directories are pruned."""
    start = since(as_of, window)
    out = df.filter(F.col(time_col) >= start)
    day = f"{time_col}_date"
    if day in df.columns:
        out = out.filter(F.col(day) >= F.to_date(start))
    return out


def _series(df: DataFrame, time: Column, name: Column, value: Column) -> DataFrame:
    return df.select(time.alias("time"), name.alias("metric"), value.alias("value")).orderBy("time", "metric")


# --- per-device series (fact, last hour) --------------------------------------


def device_series(fact: DataFrame, metric: str, as_of: Column | None = None, devices: Sequence[int] | None = None) -> DataFrame:
    """Raw readings of one metric per device over the last hour."""
    src = _recent(fact, as_of, SERIES_WINDOW).filter(_in("iot_device_id", devices))
    return _series(src, F.col("event_time"), F.col("iot_device_id").cast("string"), metric_value(metric))


def device_series_long(fact: DataFrame, metrics: Sequence[str], as_of: Column | None = None,
                       devices: Sequence[int] | None = None) -> DataFrame:
    """Several metrics in one pass, long format (time, device, metric_name, value)."""
    src = _recent(fact, as_of, SERIES_WINDOW).filter(_in("iot_device_id", devices))
    wide = src.select(F.col("event_time").alias("time"), F.col("iot_device_id").cast("string").alias("device"),
                      *[metric_value(m).alias(m) for m in metrics])
    return wide.unpivot(["time", "device"], list(metrics), "metric_name", "value")


# --- per-device hourly series (rollup, last 24 h) -----------------------------


def hourly_device_series(hourly: DataFrame, column: str, as_of: Column | None = None,
                         devices: Sequence[int] | None = None) -> DataFrame:
    src = _recent(hourly, as_of, HOURLY_WINDOW, "hour_bucket").filter(_in("iot_device_id", devices))
    return _series(src, F.col("hour_bucket"), F.col("iot_device_id").cast("string"), F.col(column))


# --- stat panels --------------------------------------------------------------


def active_devices(fact: DataFrame, as_of: Column | None = None, countries: Sequence[str] | None = None) -> DataFrame:
    src = _recent(fact, as_of, ACTIVE_WINDOW).filter(_in("country_code", countries))
    return src.agg(F.count_distinct("iot_device_id").alias("value"))


def active_countries(fact: DataFrame, as_of: Column | None = None) -> DataFrame:
    return _recent(fact, as_of, ACTIVE_WINDOW).agg(F.count_distinct("country_code").alias("value"))


def events_ingested(fact: DataFrame, as_of: Column | None = None, countries: Sequence[str] | None = None) -> DataFrame:
    src = _recent(fact, as_of, SERIES_WINDOW).filter(_in("country_code", countries))
    return src.agg(F.count(F.lit(1)).alias("value"))


def latest_event_time(fact: DataFrame, countries: Sequence[str] | None = None) -> DataFrame:
    return fact.filter(_in("country_code", countries)).agg(F.max("event_time").alias("value"))


def latest_event_time_stored(store, countries: Sequence[str] | None = None, name: str = "fact_measurements") -> DataFrame:
    """The same over a stored, day-partitioned table: the newest day that has
    a matching row holds the newest time.  Days are tried from the newest on,
    one, then two, four ... at once, so usually one is read and a country
    without rows costs some ten jobs that read each day once."""
    days, at, width = [dt.date.fromisoformat(d) for d in store.days(name)], 0, 1
    while at < len(days):
        found = latest_event_time(store.read_with_day(name).filter(F.col("event_time_date").isin(days[at : at + width])), countries)
        if at + width >= len(days) or found.first()[0] is not None:
            return found
        at, width = at + width, 2 * width
    return latest_event_time(store.read(name), countries)


def ingestion_lag(fact: DataFrame, as_of: Column | None = None, countries: Sequence[str] | None = None) -> DataFrame:
    """Seconds between the newest event time and the newest ingestion time
    among rows ingested in the last 10 minutes."""
    src = _recent(fact, as_of, LAG_WINDOW, "ingestion_time").filter(_in("country_code", countries))
    return src.agg(seconds_between(F.max("event_time"), F.max("ingestion_time")).alias("value"))


def ingestion_lag_stored(store, as_of: Column | None = None, countries: Sequence[str] | None = None) -> DataFrame:
    """The same over a stored table: the zone map tells which days may hold
    rows ingested in the window, and only these are read."""
    days = store.days_ingested_since(since(as_of, LAG_WINDOW))
    recent = store.read_with_day("fact_measurements").filter(F.col("event_time_date").isin(days))
    return ingestion_lag(recent, as_of, countries)


def active_devices_approx(sketches: DataFrame, as_of: Column | None = None, hours: int = 24,
                          countries: Sequence[str] | None = None) -> DataFrame:
    """Distinct devices of the last ``hours`` full hours and the current one,
    from the hourly sketches: a row per hour and country is read, however many
    readings there are.  The relative standard error is that of the sketches
    (``rollup.SKETCH_ERROR``)."""
    start = F.date_trunc("hour", _as_of(as_of)) - F.make_dt_interval(hours=F.lit(hours))
    src = sketches.filter(F.col("hour_bucket") >= start).filter(_in("country_code", countries))
    if "hour_bucket_date" in sketches.columns:
        src = src.filter(F.col("hour_bucket_date") >= F.to_date(start))
    return src.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("devices")), F.lit(0).cast("long")).alias("value"))


# --- tables -------------------------------------------------------------------


def device_summary(fact: DataFrame, as_of: Column | None = None) -> DataFrame:
    src = _recent(fact, as_of, SERIES_WINDOW)
    return (
        src.groupBy("iot_device_id", "country_code")
        .agg(
            F.round(F.avg("temp"), 2).alias("avg_temp"),
            F.round(F.avg("humidity"), 2).alias("avg_humidity"),
            F.round(F.avg("wind_speed"), 2).alias("avg_wind_speed"),
            F.count(F.lit(1)).alias("record_count"),
        )
        .orderBy("iot_device_id", "country_code")
    )


def country_overview(fact: DataFrame, as_of: Column | None = None, countries: Sequence[str] | None = None) -> DataFrame:
    src = _recent(fact, as_of, SERIES_WINDOW).filter(_in("country_code", countries))
    return (
        src.groupBy("country_code")
        .agg(
            F.count_distinct("iot_device_id").alias("device_count"),
            F.round(F.avg("temp"), 2).alias("avg_temp"),
            F.round(F.avg(F.col("humidity").cast("double")), 2).alias("avg_humidity"),
            F.round(F.avg(F.col("pressure").cast("double")), 2).alias("avg_pressure"),
            F.round(F.avg("wind_speed"), 2).alias("avg_wind_speed"),
            F.round(F.avg("uvi"), 2).alias("avg_uvi"),
            F.round(F.avg(F.coalesce(F.col("rain_1h"), F.lit(0.0))), 2).alias("avg_rain_1h"),
            F.count(F.lit(1)).alias("event_count"),
        )
        .orderBy("country_code")
    )


# --- country series -----------------------------------------------------------


def metric_by_minute(fact: DataFrame, metric: str, as_of: Column | None = None,
                     countries: Sequence[str] | None = None) -> DataFrame:
    """Average of the selected metric per minute and country, last hour."""
    src = _recent(fact, as_of, SERIES_WINDOW).filter(_in("country_code", countries))
    agg = src.groupBy(minute_bucket("event_time").alias("time"), F.col("country_code").alias("metric")).agg(
        F.avg(metric_value(metric)).alias("value")
    )
    return agg.orderBy("time", "metric")


def hourly_metric_by_country(hourly: DataFrame, metric: str, as_of: Column | None = None,
                             countries: Sequence[str] | None = None) -> DataFrame:
    """Selected hourly metric, one row per device-hour labelled by country
    (rows are not combined per country; wind_gust shows the hourly wind speed)."""
    src = _recent(hourly, as_of, HOURLY_WINDOW, "hour_bucket").filter(_in("country_code", countries))
    return _series(src, F.col("hour_bucket"), F.col("country_code"), hourly_metric_value(metric))


def hourly_metric_by_country_avg(hourly: DataFrame, metric: str, as_of: Column | None = None,
                                 countries: Sequence[str] | None = None) -> DataFrame:
    """Aggregated variant: one value per (hour, country)."""
    src = _recent(hourly, as_of, HOURLY_WINDOW, "hour_bucket").filter(_in("country_code", countries))
    return (
        src.groupBy(F.col("hour_bucket").alias("time"), F.col("country_code").alias("metric"))
        .agg(F.avg(hourly_metric_value(metric)).alias("value"))
        .orderBy("time", "metric")
    )


# --- pickers ------------------------------------------------------------------


def device_picker(dim_device: DataFrame) -> DataFrame:
    return (
        dim_device.filter(F.col("is_current") == F.lit(True))
        .select("iot_device_id").distinct().orderBy("iot_device_id")
    )


def country_picker(dim_country: DataFrame) -> DataFrame:
    return (
        dim_country.filter(F.col("is_current") == F.lit(True))
        .select("country_code").distinct().orderBy("country_code")
    )


def validate_metric(metric: str) -> str:
    if metric not in SELECTABLE_METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose one of {SELECTABLE_METRICS}")
    return metric


# --- reducers and status ------------------------------------------------------


def series_reducers(series: DataFrame) -> DataFrame:
    """Per-series mean / last / max of a (time, metric, value) frame."""
    return series.groupBy("metric").agg(
        F.avg("value").alias("mean"),
        F.max_by("value", "time").alias("last"),
        F.max("value").alias("max"),
    )


def last_not_null(series: DataFrame) -> DataFrame:
    """Per-series value of the latest row whose value is not NULL."""
    return series.filter(F.col("value").isNotNull()).groupBy("metric").agg(F.max_by("value", "time").alias("value"))


def with_status(stat: DataFrame, panel: str, value_col: str = "value") -> DataFrame:
    """Append the red/yellow/green status of a stat panel's value."""
    lower, upper, higher_is_better = STATUS_STEPS[panel]
    return stat.withColumn("status", status(value_col, lower, upper, higher_is_better))
