"""Telemetry stream derived from the shared ``events`` table.

The pipeline's input is a stream of gateway readings (one per device and
second).  The test warehouse provides ``events(event_id, ts, user_id,
event_type, value, props)``; this module maps every event row to one reading
with plain column expressions, so everything downstream grows with the events
table and runs on whole tables.

Mapping (one rule per column, mirrored in SQL by ``checks.oracle_sql``):

* device = ``user_id``; event time = ``ts`` truncated to the second (the
  gateway sends epoch seconds); ingestion = event time + ``event_id % 300`` s.
* station = ``(user_id + w) % 60 + 1`` where ``w`` is the ISO week of ``ts``
  for devices with ``user_id % 3 = 0`` (mobile sensors) and 0 otherwise
  (fixed sensors); coordinates come from the station table, the timezone from
  the longitude band.
* temp = ``value / 10 - 5``; humidity = ``props.k``; the other metrics are
  simple functions of ``value`` and ``event_id``; rain only for purchases,
  gusts missing for views and clicks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewater.functions.geo import timezone_of
from tidewater.schemas import STAGING

# --- fixed values (gateway station list: id, lat, lon) -----------------------
STATIONS: tuple[tuple[int, float, float], ...] = (
    (1, 40.71, -74.01), (2, 34.05, -118.24), (3, 41.85, -87.65), (4, 29.76, -95.37),
    (5, 33.45, -112.07), (6, 39.95, -75.17), (7, 29.42, -98.49), (8, 32.72, -117.15),
    (9, 32.79, -96.8), (10, 37.34, -121.89), (11, 51.51, -0.13), (12, 48.85, 2.35),
    (13, 52.52, 13.41), (14, 40.42, -3.7), (15, 41.9, 12.5), (16, 52.37, 4.9),
    (17, 48.21, 16.37), (18, 52.23, 21.01), (19, 59.33, 18.07), (20, 59.91, 10.75),
    (21, 35.68, 139.69), (22, 39.91, 116.39), (23, 31.23, 121.47), (24, 37.57, 126.98),
    (25, 19.08, 72.88), (26, 28.66, 77.23), (27, 12.97, 77.59), (28, -6.21, 106.85),
    (29, 13.75, 100.52), (30, 1.35, 103.82), (31, 3.14, 101.69), (32, 10.78, 106.63),
    (33, 22.32, 114.17), (34, 25.05, 121.53), (35, 34.69, 135.5), (36, -33.87, 151.21),
    (37, -37.81, 144.96), (38, -27.47, 153.02), (39, -31.95, 115.86), (40, -36.87, 174.77),
    (41, 30.06, 31.25), (42, 6.45, 3.4), (43, -1.29, 36.82), (44, -26.2, 28.04),
    (45, 33.59, -7.62), (46, 25.2, 55.27), (47, 24.69, 46.72), (48, 35.69, 51.42),
    (49, 41.01, 28.95), (50, 55.75, 37.62), (51, -23.55, -46.63), (52, -34.61, -58.38),
    (53, -22.91, -43.17), (54, -12.05, -77.04), (55, 4.71, -74.07), (56, -33.46, -70.65),
    (57, 19.43, -99.13), (58, 43.7, -79.42), (59, 49.25, -123.12), (60, 45.5, -73.57),
)
# --- end of fixed values ------------------------------------------------------

N_STATIONS = len(STATIONS)
INGESTION_SPREAD_SECONDS = 300
MOBILE_EVERY = 3

# Weather condition by event type (id, main, description), names as in the public condition catalogue.
CONDITIONS = {
    "purchase": (500, "Rain", "light rain"),
    "view": (800, "Clear", "clear sky"),
    "click": (801, "Clouds", "few clouds"),
    "error": (741, "Fog", "fog"),
    "signup": (701, "Mist", "mist"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def station_of(user_id: Column, ts: Column) -> Column:
    week = F.when(F.pmod(user_id, F.lit(MOBILE_EVERY)) == 0, F.weekofyear(ts)).otherwise(F.lit(0))
    return (F.pmod(user_id + week, F.lit(N_STATIONS)) + 1).cast("int")


def station_coordinate(station: Column, which: str) -> Column:
    pos = 1 if which == "lat" else 2
    values = F.array(*[F.lit(float(s[pos])) for s in STATIONS])
    return F.element_at(values, station)


def _condition(event_type: Column, pos: int) -> Column:
    expr = None
    for etype, cond in CONDITIONS.items():
        lit = F.lit(cond[pos])
        expr = F.when(event_type == etype, lit) if expr is None else expr.when(event_type == etype, lit)
    return expr


def measurements(events: DataFrame) -> DataFrame:
    """Map ``events`` rows to staging-shaped readings (the 23 staging columns)."""
    ts = F.col("ts")
    event_time = F.date_trunc("second", ts).cast("timestamp")
    value = F.col("value")
    station = station_of(F.col("user_id"), ts)
    temp = value / 10 - 5
    out = events.select(
        event_time.alias("event_time"),
        F.timestamp_add("SECOND", F.pmod(F.col("event_id"), F.lit(INGESTION_SPREAD_SECONDS)), event_time)
        .alias("ingestion_time"),
        F.col("user_id").cast("int").alias("iot_device_id"),
        station_coordinate(station, "lat").alias("latitude"),
        station_coordinate(station, "lon").alias("longitude"),
        timezone_of(station_coordinate(station, "lon")).alias("timezone"),
        (F.date_trunc("day", event_time) + F.expr("INTERVAL 6 HOURS")).alias("sunrise"),
        (F.date_trunc("day", event_time) + F.expr("INTERVAL 18 HOURS")).alias("sunset"),
        temp.alias("temp"),
        (temp - 1.5).alias("feels_like"),
        (F.lit(1000) + F.pmod(F.col("event_id"), F.lit(60))).cast("int").alias("pressure"),
        F.get_json_object("props", "$.k").cast("int").alias("humidity"),
        (temp - 5).alias("dew_point"),
        (value / 50).alias("uvi"),
        F.pmod(F.col("event_id"), F.lit(101)).cast("int").alias("clouds"),
        (F.lit(10000) - F.pmod(F.col("event_id"), F.lit(100)) * 10).cast("int").alias("visibility"),
        (value / 20).alias("wind_speed"),
        F.pmod(F.col("event_id") * 7, F.lit(360)).cast("int").alias("wind_deg"),
        F.when(F.col("event_type").isin("view", "click"), F.lit(None).cast("double"))
        .otherwise(value / 15).alias("wind_gust"),
        _condition(F.col("event_type"), 0).cast("int").alias("weather_id"),
        _condition(F.col("event_type"), 1).alias("weather_main"),
        _condition(F.col("event_type"), 2).alias("weather_description"),
        F.when(F.col("event_type") == "purchase", value / 100).alias("rain_1h"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in STAGING.fields])


def load_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measurements(read_table(spark, sf_dir, "events"))
