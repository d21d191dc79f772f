import json

from pyspark.sql import functions as F

from tidewater.schemas import STAGING
from tidewater.sources import envelope, telemetry

FULL = {
    "iot_device_id": 7,
    "ingestion_time": "2024-01-05T10:00:03Z",
    "data": {
        "dt": 1704448800, "sunrise": 1704430000, "sunset": 1704470000, "temp": 12.5, "feels_like": 11.0,
        "pressure": 1012, "humidity": 80, "dew_point": 9.1, "uvi": 1.2, "clouds": 40, "visibility": 10000,
        "wind_speed": 3.4, "wind_deg": 270, "wind_gust": 5.0,
        "weather": [{"id": 500, "main": "Rain", "description": "light rain", "icon": "10d"}],
        "rain": {"1h": 0.8},
    },
    "location": {"lat": 29.42, "lon": -98.49, "timezone": "America/Chicago"},
}


def _flat(spark, docs):
    raw = spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "raw_json string")
    return envelope.flatten(raw).collect()


def test_full_event(spark):
    (r,) = _flat(spark, [FULL])
    assert r.iot_device_id == 7 and r.temp == 12.5 and r.pressure == 1012
    assert r.event_time.isoformat() == "2024-01-05T10:00:00"
    assert r.ingestion_time.isoformat() == "2024-01-05T10:00:03"
    assert (r.weather_id, r.weather_main, r.weather_description) == (500, "Rain", "light rain")
    assert r.rain_1h == 0.8 and r.timezone == "America/Chicago"


def test_optional_and_broken_parts(spark):
    no_rain = json.loads(json.dumps(FULL))
    del no_rain["data"]["rain"]
    no_weather = json.loads(json.dumps(FULL))
    no_weather["data"]["weather"] = []
    frac = json.loads(json.dumps(FULL))
    frac["data"]["humidity"] = 80.5
    bad_time = json.loads(json.dumps(FULL))
    bad_time["ingestion_time"] = "not a time"
    no_loc = json.loads(json.dumps(FULL))
    del no_loc["location"]
    rows = _flat(spark, [no_rain, no_weather, frac, bad_time, no_loc, "{broken json"])
    assert rows[0].rain_1h is None and rows[0].temp == 12.5
    assert rows[1].weather_id is None and rows[1].weather_main is None and rows[1].temp == 12.5
    assert rows[2].humidity is None and rows[2].temp == 12.5
    assert rows[3].ingestion_time is None and rows[3].event_time is not None
    assert rows[4].latitude is None and rows[4].timezone is None and rows[4].temp == 12.5
    assert all(v is None for v in rows[5])


def test_schema_is_declared(spark):
    raw = spark.createDataFrame([(json.dumps(FULL),)], "raw_json string")
    assert envelope.flatten(raw).schema == STAGING


def test_round_trip_through_envelope(spark):
    readings = telemetry.load_measurements(spark, "/root/testdata/sf0.001")
    back = envelope.flatten(envelope.to_raw_json(readings))
    assert back.exceptAll(readings).count() == 0 and readings.exceptAll(back).count() == 0


def test_kafka_record_shape(spark):
    readings = telemetry.load_measurements(spark, "/root/testdata/sf0.001")
    rec = envelope.to_kafka_records(readings, partitions=4)
    r = rec.filter(F.col("partition") != F.pmod(F.col("key").cast("string").cast("int") - 1, F.lit(4))).count()
    assert r == 0
    landed = envelope.landing_columns(envelope.decode_payload(rec)).limit(5).collect()
    assert all(x.ingestion_date is not None and x.iot_device_id is not None for x in landed)
