"""Declared schemas of every stream record and warehouse table.

Schemas are fixed, never inferred: the JSON reader gets the event schema and
every table is created from the StructType here.
"""

from __future__ import annotations

from pyspark.sql import types as T

_str, _int, _long, _dbl = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_ts, _date, _bool = T.TimestampType(), T.DateType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Nested event carried in ``raw_json`` (device gateway envelope).
WEATHER = _struct(("id", _int), ("main", _str), ("description", _str), ("icon", _str))
EVENT = _struct(
    ("iot_device_id", _int),
    ("ingestion_time", _str),
    (
        "data",
        _struct(
            ("dt", _long),
            ("sunrise", _long),
            ("sunset", _long),
            ("temp", _dbl),
            ("feels_like", _dbl),
            ("pressure", _int),
            ("humidity", _int),
            ("dew_point", _dbl),
            ("uvi", _dbl),
            ("clouds", _int),
            ("visibility", _int),
            ("wind_speed", _dbl),
            ("wind_deg", _int),
            ("wind_gust", _dbl),
            ("weather", T.ArrayType(WEATHER)),
            ("rain", _struct(("1h", _dbl))),
        ),
    ),
    ("location", _struct(("lat", _dbl), ("lon", _dbl), ("timezone", _str))),
)

# One line of the raw zone: the payload kept intact as text.
RAW_FILE = _struct(("raw_json", _str))

# Kafka record as the broker source exposes it (subset used here).
KAFKA_RECORD = _struct(
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
    ("topic", _str),
    ("partition", _int),
    ("offset", _long),
    ("timestamp", _ts),
)

# Measurements that are averaged, clamped and served.
MEASUREMENT_FIELDS = [
    "sunrise", "sunset", "temp", "feels_like", "pressure", "humidity", "dew_point",
    "uvi", "clouds", "visibility", "wind_speed", "wind_deg", "wind_gust", "rain_1h",
]
WEATHER_FIELDS = ["weather_id", "weather_main", "weather_description"]

STAGING = _struct(
    ("event_time", _ts),
    ("ingestion_time", _ts),
    ("iot_device_id", _int),
    ("latitude", _dbl),
    ("longitude", _dbl),
    ("timezone", _str),
    ("sunrise", _ts),
    ("sunset", _ts),
    ("temp", _dbl),
    ("feels_like", _dbl),
    ("pressure", _int),
    ("humidity", _int),
    ("dew_point", _dbl),
    ("uvi", _dbl),
    ("clouds", _int),
    ("visibility", _int),
    ("wind_speed", _dbl),
    ("wind_deg", _int),
    ("wind_gust", _dbl),
    ("weather_id", _int),
    ("weather_main", _str),
    ("weather_description", _str),
    ("rain_1h", _dbl),
)

DIM_DATE = _struct(
    ("date_key", _int),
    ("full_date", _date),
    ("year", _int),
    ("quarter", _int),
    ("month", _int),
    ("month_name", _str),
    ("week_of_year", _int),
    ("day_of_month", _int),
    ("day_of_week", _int),
    ("day_name", _str),
    ("is_weekend", _bool),
)

DIM_DEVICE = _struct(
    ("device_sk", _str),
    ("iot_device_id", _int),
    ("latitude", _dbl),
    ("longitude", _dbl),
    ("timezone", _str),
    ("effective_start", _ts),
    ("effective_end", _ts),
    ("is_current", _bool),
)

DIM_COUNTRY = _struct(
    ("country_sk", _str),
    ("iot_device_id", _int),
    ("country_code", _str),
    ("country_name", _str),
    ("city", _str),
    ("effective_start", _ts),
    ("effective_end", _ts),
    ("is_current", _bool),
)

FACT = _struct(
    ("fact_sk", _str),
    ("date_key", _int),
    ("device_sk", _str),
    ("country_sk", _str),
    ("iot_device_id", _int),
    ("country_code", _str),
    ("event_time", _ts),
    ("ingestion_time", _ts),
    ("sunrise", _ts),
    ("sunset", _ts),
    ("temp", _dbl),
    ("feels_like", _dbl),
    ("pressure", _int),
    ("humidity", _int),
    ("dew_point", _dbl),
    ("uvi", _dbl),
    ("clouds", _int),
    ("visibility", _int),
    ("wind_speed", _dbl),
    ("wind_deg", _int),
    ("wind_gust", _dbl),
    ("rain_1h", _dbl),
    ("weather_id", _int),
    ("weather_main", _str),
    ("weather_description", _str),
)

HOURLY_AVG_SOURCES = [
    "temp", "feels_like", "humidity", "pressure", "wind_speed", "uvi", "clouds",
    "visibility", "rain_1h",
]
HOURLY = _struct(
    ("hour_bucket", _ts),
    ("iot_device_id", _int),
    ("country_code", _str),
    *[(f"avg_{c}", _dbl) for c in HOURLY_AVG_SOURCES],
)

# States that devices reported, one row per device and micro-batch: kept for dimensions
# whose versions follow event time, so that a late state can be put in its place.
DIM_STATES = _struct(
    ("iot_device_id", _int),
    ("state_time", _ts),
    ("latitude", _dbl),
    ("longitude", _dbl),
    ("timezone", _str),
)

# Last reading of a metric that each device has (keyed stream state, published).
DEVICE_LAST = _struct(("iot_device_id", _int), ("event_time", _ts), ("value", _dbl))

# When the readings of a day were ingested: a row per write, so that lag queries prune days.
FACT_ZONES = _struct(("day", T.DateType()), ("first_ingestion", _ts), ("last_ingestion", _ts))

# Distinct-count sketches of the devices that reported, by hour and country.
HOURLY_DEVICES = _struct(
    ("hour_bucket", _ts), ("country_code", _str), ("devices", T.BinaryType()), ("n_events", T.LongType())
)

# Table registry: name -> (schema, day-partition source column or None).
TABLES: dict[str, tuple[T.StructType, str | None]] = {
    "staging_events": (STAGING, "event_time"),
    "dim_date": (DIM_DATE, None),
    "dim_iot_device": (DIM_DEVICE, None),
    "dim_country": (DIM_COUNTRY, None),
    "dim_states": (DIM_STATES, None),
    "fact_measurements": (FACT, "event_time"),
    "fact_hourly_agg": (HOURLY, "hour_bucket"),
    "fact_hourly_devices": (HOURLY_DEVICES, "hour_bucket"),
    "fact_zones": (FACT_ZONES, None),
    "device_last": (DEVICE_LAST, None),
}

# Natural keys.
DEDUP_KEYS = ["event_time", "iot_device_id"]
HOURLY_KEYS = ["hour_bucket", "iot_device_id"]
