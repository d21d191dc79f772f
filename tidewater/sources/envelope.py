"""Gateway payloads: JSON envelope in both directions, and the Kafka record shape.

* :func:`flatten` parses ``raw_json`` with the declared event schema and
  projects the 23 staging columns from a declarative field map.  Parsing is
  permissive: a malformed document yields an all-NULL row, a mistyped field
  only that field NULL, an empty ``weather`` array NULL weather columns, and
  unparseable ingestion text a NULL time.
* :func:`to_raw_json` is the inverse (the gateway's serialisation), used to
  publish readings and for round-trip checks.
* :func:`to_kafka_records` / :func:`decode_payload` / :func:`landing_columns`
  are the broker hop: key = device id text, value = JSON bytes, explicit
  partition ``(id - 1) mod n``; and the raw zone's partition columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.functions.timefn import epoch_to_ts, format_iso_utc, parse_iso, parse_iso_date, ts_to_epoch
from tidewater.schemas import EVENT, STAGING


@dataclass(frozen=True)
class Field:
    name: str
    source: str  # dotted path inside the event; "[0]" takes the first array element
    kind: str  # "epoch" | "iso" | "int" | "double" | "string"


# Declarative projection: staging column <- event path, conversion.
STAGING_FIELDS: tuple[Field, ...] = (
    Field("event_time", "data.dt", "epoch"),
    Field("ingestion_time", "ingestion_time", "iso"),
    Field("iot_device_id", "iot_device_id", "int"),
    Field("latitude", "location.lat", "double"),
    Field("longitude", "location.lon", "double"),
    Field("timezone", "location.timezone", "string"),
    Field("sunrise", "data.sunrise", "epoch"),
    Field("sunset", "data.sunset", "epoch"),
    Field("temp", "data.temp", "double"),
    Field("feels_like", "data.feels_like", "double"),
    Field("pressure", "data.pressure", "int"),
    Field("humidity", "data.humidity", "int"),
    Field("dew_point", "data.dew_point", "double"),
    Field("uvi", "data.uvi", "double"),
    Field("clouds", "data.clouds", "int"),
    Field("visibility", "data.visibility", "int"),
    Field("wind_speed", "data.wind_speed", "double"),
    Field("wind_deg", "data.wind_deg", "int"),
    Field("wind_gust", "data.wind_gust", "double"),
    Field("weather_id", "data.weather[0].id", "int"),
    Field("weather_main", "data.weather[0].main", "string"),
    Field("weather_description", "data.weather[0].description", "string"),
    Field("rain_1h", "data.rain.1h", "double"),
)


def resolve_path(root: Column, path: str) -> Column:
    """Walk a dotted path; ``name[0]`` takes the first element NULL-safely
    (``get`` returns NULL on an empty array instead of failing under ANSI)."""
    col = root
    for part in path.split("."):
        if part.endswith("[0]"):
            col = F.get(col.getField(part[:-3]), F.lit(0))
        else:
            col = col.getField(part)
    return col


def convert(col: Column, kind: str) -> Column:
    if kind == "epoch":
        return epoch_to_ts(col)
    if kind == "iso":
        return parse_iso(col)
    return col


def flatten(raw: DataFrame, column: str = "raw_json", fields=STAGING_FIELDS) -> DataFrame:
    """Parse the JSON text column and return the flat staging columns only
    (partition columns a file source appends are not carried)."""
    parsed = raw.select(F.from_json(F.col(column), EVENT).alias("p"))
    p = F.col("p")
    out = parsed.select(*[convert(resolve_path(p, f.source), f.kind).alias(f.name) for f in fields])
    return out.select(*[F.col(f.name).cast(f.dataType) for f in STAGING.fields])


def event_struct(readings: DataFrame) -> Column:
    """Nested event from staging-shaped readings (inverse of ``flatten``).

    ``rain`` is present only when ``rain_1h`` is set; ``weather`` is empty when
    no condition is known.
    """
    weather = F.when(
        F.col("weather_id").isNotNull() | F.col("weather_main").isNotNull(),
        F.array(F.struct(
            F.col("weather_id").alias("id"),
            F.col("weather_main").alias("main"),
            F.col("weather_description").alias("description"),
            F.lit(None).cast("string").alias("icon"),
        )),
    ).otherwise(F.array().cast("array<struct<id:int,main:string,description:string,icon:string>>"))
    data = F.struct(
        ts_to_epoch("event_time").alias("dt"),
        ts_to_epoch("sunrise").alias("sunrise"),
        ts_to_epoch("sunset").alias("sunset"),
        *[F.col(c) for c in ("temp", "feels_like", "pressure", "humidity", "dew_point", "uvi", "clouds",
                             "visibility", "wind_speed", "wind_deg", "wind_gust")],
        weather.alias("weather"),
        F.when(F.col("rain_1h").isNotNull(), F.struct(F.col("rain_1h").alias("1h"))).alias("rain"),
    )
    return F.struct(
        F.col("iot_device_id"),
        format_iso_utc("ingestion_time").alias("ingestion_time"),
        data.alias("data"),
        F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
                 F.col("timezone").alias("timezone")).alias("location"),
    )


def to_raw_json(readings: DataFrame) -> DataFrame:
    """One ``raw_json`` text line per reading (NULL fields are omitted)."""
    return readings.select(F.to_json(event_struct(readings)).alias("raw_json"))


def to_kafka_records(readings: DataFrame, partitions: int) -> DataFrame:
    """Broker records: key, value (bytes) and the explicit partition."""
    device = F.col("iot_device_id")
    return readings.select(
        device.cast("string").cast("binary").alias("key"),
        F.to_json(event_struct(readings)).cast("binary").alias("value"),
        F.pmod(device - 1, F.lit(partitions)).cast("int").alias("partition"),
    )


def decode_payload(records: DataFrame) -> DataFrame:
    """Keep the payload intact as text (plus the record metadata present)."""
    keep = [c for c in records.columns if c != "value"]
    return records.select(*keep, F.col("value").cast("string").alias("raw_json"))


def landing_columns(raw: DataFrame) -> DataFrame:
    """Raw-zone partition columns taken from the payload text."""
    return raw.withColumn(
        "ingestion_date", parse_iso_date(F.get_json_object("raw_json", "$.ingestion_time"))
    ).withColumn("iot_device_id", F.get_json_object("raw_json", "$.iot_device_id"))
