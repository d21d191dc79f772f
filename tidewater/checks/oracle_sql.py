"""DuckDB SQL mirror of every registered query (``plans.registry``).

Plain SQL over the driver's views (``events`` ...).  Box, band, bound and
station literals and the rounding digits are generated from the library's own
fixed-value tables -- those tables are the specification, which the SQL does
not check; it checks the Spark logic around them.

Conventions: rounding goes through the double's decimal text so that it is
HALF_UP on the decimal value (Spark's semantics) rather than on the binary
double; averages
that the query does not round itself are rounded to ``CHECK_DIGITS``.
"""

from __future__ import annotations

from tidewater.functions.geo import COUNTRY_BOXES, TIMEZONE_BANDS
from tidewater.functions.measures import BOUNDS, INT_METRICS
from tidewater.plans.registry import CHECK_DIGITS, HOURLY_SERIES, SELECTED_COUNTRIES, SELECTED_DEVICES, SERIES_METRICS
from tidewater.sources.telemetry import CONDITIONS, INGESTION_SPREAD_SECONDS, MOBILE_EVERY, N_STATIONS, STATIONS


def rnd(expr: str, digits: int = CHECK_DIGITS) -> str:
    """HALF_UP rounding of the double's shortest decimal text -- what Spark's
    ``round`` does -- rather than of its binary value."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def country_case(lat: str, lon: str, field: str) -> str:
    idx = {"code": 0, "name": 1, "city": 2}[field]
    fallback = ("XX", "Unknown", "Unknown")[idx]
    whens = " ".join(
        f"WHEN {lat} BETWEEN {_d(b.lat_min)} AND {_d(b.lat_max)} AND {lon} BETWEEN {_d(b.lon_min)} AND {_d(b.lon_max)} "
        f"THEN '{(b.code, b.name, b.city)[idx]}'"
        for b in COUNTRY_BOXES
    )
    return f"CASE {whens} ELSE '{fallback}' END"


def timezone_case(lon: str) -> str:
    whens = " ".join(f"WHEN {lon} >= {lo} AND {lon} < {hi} THEN '{tz}'" for lo, hi, tz in TIMEZONE_BANDS)
    return f"CASE {whens} ELSE 'UTC' END"


_LATS = ", ".join(repr(s[1]) for s in STATIONS)
_LONS = ", ".join(repr(s[2]) for s in STATIONS)
_STATION = f"CAST((user_id + CASE WHEN user_id % {MOBILE_EVERY} = 0 THEN weekofyear(ts) ELSE 0 END) % {N_STATIONS} + 1 AS INTEGER)"
_LAT = f"CAST(list_extract([{_LATS}], station) AS DOUBLE)"
_LON = f"CAST(list_extract([{_LONS}], station) AS DOUBLE)"


def _cond(pos: int, cast: str | None = None) -> str:
    whens = " ".join(
        f"WHEN event_type = '{k}' THEN {v[pos] if isinstance(v[pos], int) else repr(v[pos])}" for k, v in CONDITIONS.items()
    )
    body = f"CASE {whens} END"
    return f"CAST({body} AS {cast})" if cast else body


MEASUREMENTS = f"""
SELECT
  CAST(date_trunc('second', ts) AS TIMESTAMP) AS event_time,
  CAST(date_trunc('second', ts) AS TIMESTAMP) + to_seconds(event_id % {INGESTION_SPREAD_SECONDS}) AS ingestion_time,
  CAST(user_id AS INTEGER) AS iot_device_id,
  {_LAT} AS latitude,
  {_LON} AS longitude,
  {timezone_case(_LON)} AS timezone,
  CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 6 HOUR AS sunrise,
  CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 18 HOUR AS sunset,
  value / 10 - 5 AS temp,
  (value / 10 - 5) - 1.5 AS feels_like,
  CAST(1000 + event_id % 60 AS INTEGER) AS pressure,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity,
  (value / 10 - 5) - 5 AS dew_point,
  value / 50 AS uvi,
  CAST(event_id % 101 AS INTEGER) AS clouds,
  CAST(10000 - (event_id % 100) * 10 AS INTEGER) AS visibility,
  value / 20 AS wind_speed,
  CAST((event_id * 7) % 360 AS INTEGER) AS wind_deg,
  CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE value / 15 END AS wind_gust,
  {_cond(0, "INTEGER")} AS weather_id,
  {_cond(1)} AS weather_main,
  {_cond(2)} AS weather_description,
  CASE WHEN event_type = 'purchase' THEN value / 100 END AS rain_1h
FROM (SELECT *, {_STATION} AS station FROM events) e
"""

STAGING_COLS = (
    "event_time, ingestion_time, iot_device_id, latitude, longitude, timezone, sunrise, sunset, temp, feels_like, "
    "pressure, humidity, dew_point, uvi, clouds, visibility, wind_speed, wind_deg, wind_gust, weather_id, "
    "weather_main, weather_description, rain_1h"
)
MEAS = ("sunrise", "sunset", "temp", "feels_like", "pressure", "humidity", "dew_point", "uvi", "clouds",
        "visibility", "wind_speed", "wind_deg", "wind_gust", "rain_1h")
DOUBLE_STAGING = ("latitude", "longitude", "temp", "feels_like", "dew_point", "uvi", "wind_speed", "wind_gust", "rain_1h")


def _dedup(src: str) -> str:
    return f"""
SELECT {STAGING_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY event_time, iot_device_id
    ORDER BY ingestion_time ASC NULLS LAST, temp ASC NULLS LAST, pressure ASC NULLS LAST, humidity ASC NULLS LAST) AS _rn
  FROM {src}) WHERE _rn = 1"""


def _changed(cols: tuple[str, ...]) -> str:
    parts = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER w" for c in cols)
    return f"(lag(batch_ts) OVER w IS NULL OR {parts})"


def _sk(*parts: str) -> str:
    return f"md5(concat_ws('||', {', '.join(parts)}))"


_VER_START = "max(CASE WHEN changed THEN batch_ts END) OVER (PARTITION BY iot_device_id ORDER BY batch_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_NEXT = "lead(batch_ts) OVER (PARTITION BY iot_device_id ORDER BY batch_ts)"

WAREHOUSE_CTES = f"""
m AS ({MEASUREMENTS}),
r AS ({_dedup('m')}),
b AS (SELECT *, date_trunc('week', event_time) + INTERVAL 7 DAY AS batch_ts FROM r),
st AS (
  SELECT iot_device_id, batch_ts, latitude, longitude, timezone,
    {country_case('latitude', 'longitude', 'code')} AS country_code,
    {country_case('latitude', 'longitude', 'name')} AS country_name,
    {country_case('latitude', 'longitude', 'city')} AS city
  FROM (SELECT *, row_number() OVER (PARTITION BY iot_device_id, batch_ts ORDER BY event_time DESC NULLS LAST) AS _rn FROM b)
  WHERE _rn = 1
),
dv AS (SELECT *, {_changed(('latitude', 'longitude', 'timezone'))} AS changed FROM st
       WINDOW w AS (PARTITION BY iot_device_id ORDER BY batch_ts)),
cv AS (SELECT *, {_changed(('country_code', 'country_name', 'city'))} AS changed FROM st
       WINDOW w AS (PARTITION BY iot_device_id ORDER BY batch_ts)),
dim_device AS (
  SELECT {_sk('CAST(iot_device_id AS VARCHAR)', 'CAST(batch_ts AS VARCHAR)')} AS device_sk,
    iot_device_id, latitude, longitude, timezone,
    batch_ts AS effective_start, {_NEXT} AS effective_end, {_NEXT} IS NULL AS is_current
  FROM dv WHERE changed
),
dim_country AS (
  SELECT {_sk('CAST(iot_device_id AS VARCHAR)', 'country_code', 'CAST(batch_ts AS VARCHAR)')} AS country_sk,
    iot_device_id, country_code, country_name, city,
    batch_ts AS effective_start, {_NEXT} AS effective_end, {_NEXT} IS NULL AS is_current
  FROM cv WHERE changed
),
dver AS (SELECT iot_device_id, batch_ts, {_sk('CAST(iot_device_id AS VARCHAR)', f'CAST({_VER_START} AS VARCHAR)')} AS device_sk FROM dv),
cver AS (SELECT iot_device_id, batch_ts, country_code,
  {_sk('CAST(iot_device_id AS VARCHAR)', 'country_code', f'CAST({_VER_START} AS VARCHAR)')} AS country_sk FROM cv),
f AS (
  SELECT {_sk('CAST(b.iot_device_id AS VARCHAR)', 'CAST(b.event_time AS VARCHAR)')} AS fact_sk,
    CAST(year(b.event_time) * 10000 + month(b.event_time) * 100 + day(b.event_time) AS INTEGER) AS date_key,
    dver.device_sk, cver.country_sk, b.iot_device_id, cver.country_code, b.event_time, b.ingestion_time,
    {", ".join(f"b.{c}" for c in MEAS)}, b.weather_id, b.weather_main, b.weather_description
  FROM b
  LEFT JOIN dver ON dver.iot_device_id = b.iot_device_id AND dver.batch_ts = b.batch_ts
  LEFT JOIN cver ON cver.iot_device_id = b.iot_device_id AND cver.batch_ts = b.batch_ts
),
h AS (
  SELECT date_trunc('hour', event_time) AS hour_bucket, iot_device_id,
    arg_max(country_code, event_time) AS country_code,
    avg(temp) AS avg_temp, avg(feels_like) AS avg_feels_like, avg(humidity) AS avg_humidity,
    avg(pressure) AS avg_pressure, avg(wind_speed) AS avg_wind_speed, avg(uvi) AS avg_uvi,
    avg(clouds) AS avg_clouds, avg(visibility) AS avg_visibility, avg(rain_1h) AS avg_rain_1h
  FROM f GROUP BY 1, 2
),
anchor AS (SELECT max(event_time) AS t FROM f)
"""



def _spliced_dim(name: str, sk: str, key_parts: tuple[str, ...], tracked: tuple[str, ...]) -> str:
    """CTEs of a dimension whose versions start at the times of the weekly states."""
    return f"""{name}_s AS (
  SELECT * FROM (
    SELECT iot_device_id, event_time AS batch_ts, {", ".join(tracked)}, row_number() OVER (
      PARTITION BY iot_device_id, week_end ORDER BY event_time DESC) AS _rn
    FROM (SELECT b.* EXCLUDE (batch_ts), batch_ts AS week_end,
            {country_case('latitude', 'longitude', 'code')} AS country_code,
            {country_case('latitude', 'longitude', 'name')} AS country_name,
            {country_case('latitude', 'longitude', 'city')} AS city FROM b)
  ) WHERE _rn = 1
),
{name}_v AS (SELECT *, {_changed(tracked)} AS changed FROM {name}_s WINDOW w AS (PARTITION BY iot_device_id ORDER BY batch_ts)),
{name} AS (
  SELECT {_sk(*key_parts, 'CAST(batch_ts AS VARCHAR)')} AS {sk}, iot_device_id, {", ".join(tracked)},
    batch_ts AS effective_start, {_NEXT} AS effective_end, {_NEXT} IS NULL AS is_current
  FROM {name}_v WHERE changed
)"""


_SPLICED = ",\n".join([
    _spliced_dim("spliced_device", "device_sk", ("CAST(iot_device_id AS VARCHAR)",), ("latitude", "longitude", "timezone")),
    _spliced_dim("spliced_country", "country_sk", ("CAST(iot_device_id AS VARCHAR)", "country_code"),
                 ("country_code", "country_name", "city")),
])

HOURLY_COLS = ("avg_temp", "avg_feels_like", "avg_humidity", "avg_pressure", "avg_wind_speed", "avg_uvi",
               "avg_clouds", "avg_visibility", "avg_rain_1h")


def _with(body: str) -> str:
    return f"WITH {WAREHOUSE_CTES}\n{body}"


def _rounded_staging(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return ", ".join(rnd(f"{p}{c}") + f" AS {c}" if c in DOUBLE_STAGING else f"{p}{c}" for c in STAGING_COLS.split(", "))


def _hourly_select(src: str = "h") -> str:
    return ", ".join(["hour_bucket", "iot_device_id", "country_code", *[rnd(c) + f" AS {c}" for c in HOURLY_COLS]]) + f" FROM {src}"


# the streamed load's clock, which dates every version
_CLOCK = "CAST(TIMESTAMP '2100-01-01 00:00:00' AS VARCHAR)"

_IN_SELECTED = "country_code IN (" + ", ".join(f"'{c}'" for c in SELECTED_COUNTRIES) + ")"

_METRIC_SQL = {
    "temp": "temp",
    "humidity": "CAST(humidity AS DOUBLE)",
    "pressure": "CAST(pressure AS DOUBLE)",
    "wind_speed": "wind_speed",
    "uvi": "uvi",
    "rain_1h": "COALESCE(rain_1h, 0.0)",
    "wind_gust": "COALESCE(wind_gust, wind_speed)",
}
_HOURLY_METRIC_SQL = {
    "temp": "avg_temp", "humidity": "avg_humidity", "pressure": "avg_pressure", "wind_speed": "avg_wind_speed",
    "uvi": "avg_uvi", "rain_1h": "avg_rain_1h", "wind_gust": "avg_wind_speed",
}


def _jittered() -> str:
    return f"""(SELECT event_id,
    {_LAT} + ((event_id % 21) - 10) * 0.5 AS latitude,
    {_LON} + ((event_id % 17) - 8) * 0.5 AS longitude
  FROM (SELECT *, {_STATION} AS station FROM events))"""


def _country_lookup() -> str:
    return f"""SELECT event_id, latitude, longitude,
  {country_case('latitude', 'longitude', 'code')} AS country_code,
  {country_case('latitude', 'longitude', 'name')} AS country_name,
  {country_case('latitude', 'longitude', 'city')} AS city
FROM {_jittered()}"""


def _spiky() -> str:
    k = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"
    return f"""(SELECT event_id,
    value / 5 - 20 AS temp, value / 5 - 25 AS feels_like, value / 5 - 70 AS dew_point,
    800.0 + (event_id % 400) + 0.5 AS pressure, {k} * 1.5 - 20.5 AS humidity, value / 25 AS uvi,
    {k} * 1.25 - 5.5 AS clouds, ((event_id * 37) % 12000) + 0.5 AS visibility,
    value / 20 - 2 AS wind_speed, value / 15 - 3 AS wind_gust, event_id * 1.7 AS wind_deg
  FROM events)"""


def _clamp(name: str, expr: str | None = None) -> str:
    lo, hi = BOUNDS[name]
    e = expr or name
    out = f"CAST({e} AS DOUBLE)"
    if lo is not None:
        out = f"greatest({out}, {float(lo)!r})"
    if hi is not None:
        out = f"least({out}, {float(hi)!r})"
    if name in INT_METRICS:
        return f"CAST(round_even({out}, 0) AS INTEGER)"
    return rnd(out, 2)


_DEVICES = f" AND iot_device_id IN {SELECTED_DEVICES}"


def _panel_series(metric: str, where: str = "") -> str:
    return _with(f"""SELECT event_time AS time, CAST(iot_device_id AS VARCHAR) AS metric, {rnd(_METRIC_SQL[metric])} AS value
FROM f WHERE event_time >= (SELECT t FROM anchor) - INTERVAL 1 HOUR{where}""")


def _panel_hourly(col: str, where: str = "") -> str:
    return _with(f"""SELECT hour_bucket AS time, CAST(iot_device_id AS VARCHAR) AS metric, {rnd(col)} AS value
FROM h WHERE hour_bucket >= (SELECT t FROM anchor) - INTERVAL 24 HOUR{where}""")


def _lag(where: str = "") -> str:
    extra = f" AND {where}" if where else ""
    return _with(f"""SELECT date_sub('second', max(event_time), max(ingestion_time)) AS value
FROM f WHERE ingestion_time >= (SELECT t FROM anchor) - INTERVAL 10 MINUTE{extra}""")


def _overview(where: str = "") -> str:
    extra = f" AND {where}" if where else ""
    return _with(f"""SELECT country_code,
  count(DISTINCT iot_device_id) AS device_count,
  {rnd('avg(temp)', 2)} AS avg_temp,
  {rnd('avg(CAST(humidity AS DOUBLE))', 2)} AS avg_humidity,
  {rnd('avg(CAST(pressure AS DOUBLE))', 2)} AS avg_pressure,
  {rnd('avg(wind_speed)', 2)} AS avg_wind_speed,
  {rnd('avg(uvi)', 2)} AS avg_uvi,
  {rnd('avg(COALESCE(rain_1h, 0.0))', 2)} AS avg_rain_1h,
  count(*) AS event_count
FROM f WHERE event_time >= (SELECT t FROM anchor) - INTERVAL 1 HOUR{extra}
GROUP BY country_code""")


def oracle_sql() -> dict[str, str]:
    fact_cols = (
        "fact_sk, date_key, device_sk, country_sk, iot_device_id, country_code, event_time, ingestion_time, "
        + ", ".join(rnd(c) + f" AS {c}" if c in DOUBLE_STAGING else c for c in MEAS)
        + ", weather_id, weather_main, weather_description"
    )
    sql: dict[str, str] = {
        "rollup_hourly": _with(f"SELECT {_hourly_select()}"),
        "flatten_envelope": f"WITH m AS ({MEASUREMENTS}) SELECT * FROM m",
        "raw_landing": f"""WITH m AS ({MEASUREMENTS})
SELECT CAST(iot_device_id AS VARCHAR) AS key,
  CAST(((iot_device_id - 1) % 6 + 6) % 6 AS INTEGER) AS partition,
  CAST(ingestion_time AS DATE) AS ingestion_date,
  CAST(iot_device_id AS VARCHAR) AS device_text,
  CAST(epoch(event_time) AS BIGINT) AS dt
FROM m""",
        "dedup_keys": f"""WITH m AS ({MEASUREMENTS}),
both_ AS (SELECT * FROM m UNION ALL SELECT * REPLACE (ingestion_time + INTERVAL 60 SECOND AS ingestion_time) FROM m),
d AS ({_dedup('both_')})
SELECT {_rounded_staging()} FROM d""",
        "latest_per_device": _with("""SELECT iot_device_id, event_time, latitude, longitude, timezone FROM (
  SELECT *, row_number() OVER (PARTITION BY iot_device_id ORDER BY event_time DESC NULLS LAST) AS _rn FROM r) WHERE _rn = 1"""),
        "insert_if_absent": _with(f"""SELECT {_rounded_staging()} FROM (
  SELECT * FROM r WHERE weekofyear(event_time) <= 3
  UNION ALL
  SELECT * FROM r s WHERE weekofyear(event_time) >= 2 AND NOT EXISTS (
    SELECT 1 FROM r t WHERE weekofyear(t.event_time) <= 3 AND t.event_time = s.event_time AND t.iot_device_id = s.iot_device_id))"""),
        "dim_date": _with("""SELECT
  CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  monthname(d) AS month_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
FROM (SELECT DISTINCT CAST(event_time AS DATE) AS d FROM r)"""),
        "country_lookup": _country_lookup(),
        "country_lookup_join": _country_lookup(),
        "timezone_lookup": f"""SELECT event_id, longitude, {timezone_case('longitude')} AS timezone
FROM (SELECT event_id, ((value * 7) % 360.0) - 180 AS longitude FROM events)""",
        "scd2_device": _with("SELECT * FROM dim_device"),
        "scd2_country": _with("SELECT * FROM dim_country"),
        "scd2_device_incremental": _with("SELECT * FROM dim_device"),
        "scd2_country_incremental": _with("SELECT * FROM dim_country"),
        "scd2_device_spliced": _with_extra(_SPLICED, "SELECT * FROM spliced_device"),
        "scd2_country_spliced": _with_extra(_SPLICED, "SELECT * FROM spliced_country"),
        "fact_load_asof": _with_extra(f"""{_SPLICED},
af AS (
  SELECT f.* REPLACE (d.device_sk AS device_sk, c.country_sk AS country_sk, c.country_code AS country_code)
  FROM f
  LEFT JOIN spliced_device d ON d.iot_device_id = f.iot_device_id AND f.event_time >= d.effective_start
    AND (d.effective_end IS NULL OR f.event_time < d.effective_end)
  LEFT JOIN spliced_country c ON c.iot_device_id = f.iot_device_id AND f.event_time >= c.effective_start
    AND (c.effective_end IS NULL OR f.event_time < c.effective_end)
)""", f"SELECT {fact_cols} FROM af"),
        "fact_load": _with(f"SELECT {fact_cols} FROM f"),
        "fact_load_incremental": _with(f"SELECT {fact_cols} FROM f"),
        "upsert_hourly": _with_extra(
            f"""stale AS (
  SELECT date_trunc('hour', event_time) AS hour_bucket, iot_device_id,
    arg_max(country_code, event_time) AS country_code,
    avg(temp) AS avg_temp, avg(feels_like) AS avg_feels_like, avg(humidity) AS avg_humidity,
    avg(pressure) AS avg_pressure, avg(wind_speed) AS avg_wind_speed, avg(uvi) AS avg_uvi,
    avg(clouds) AS avg_clouds, avg(visibility) AS avg_visibility, avg(rain_1h) AS avg_rain_1h
  FROM f WHERE event_time < (SELECT t FROM anchor) - INTERVAL 3 HOUR GROUP BY 1, 2
),
fresh AS (SELECT * FROM h WHERE hour_bucket >= date_trunc('hour', (SELECT t FROM anchor) - INTERVAL 2 HOUR)),
merged AS (
  SELECT * FROM stale s WHERE NOT EXISTS (
    SELECT 1 FROM fresh n WHERE n.hour_bucket = s.hour_bucket AND n.iot_device_id = s.iot_device_id)
  UNION ALL SELECT * FROM fresh
)""",
            f"SELECT {_hourly_select('merged')}",
        ),
    }
    for metric in SERIES_METRICS:
        sql[f"panel_series_{metric}"] = _panel_series(metric)
    for col in HOURLY_SERIES:
        sql[f"panel_hourly_{col}"] = _panel_hourly(col)
    since_1h = "event_time >= (SELECT t FROM anchor) - INTERVAL 1 HOUR"
    since_5m = "event_time >= (SELECT t FROM anchor) - INTERVAL 5 MINUTE"
    sql.update({
        "panel_active_devices": _with(f"SELECT count(DISTINCT iot_device_id) AS value FROM f WHERE {since_5m}"),
        "panel_events_ingested": _with(f"SELECT count(*) AS value FROM f WHERE {since_1h}"),
        "panel_latest_event_time": _with("SELECT max(event_time) AS value FROM f"),
        "panel_ingestion_lag": _lag(),
        "panel_device_summary": _with(f"""SELECT iot_device_id, country_code,
  {rnd('avg(temp)', 2)} AS avg_temp, {rnd('avg(humidity)', 2)} AS avg_humidity,
  {rnd('avg(wind_speed)', 2)} AS avg_wind_speed, count(*) AS record_count
FROM f WHERE {since_1h} GROUP BY iot_device_id, country_code"""),
        "panel_device_picker": _with("SELECT DISTINCT iot_device_id FROM dim_device WHERE is_current = TRUE"),
        "panel_active_countries": _with(f"SELECT count(DISTINCT country_code) AS value FROM f WHERE {since_5m}"),
        "panel_events_by_country": _with(f"SELECT count(*) AS value FROM f WHERE {since_1h} AND {_IN_SELECTED}"),
        "panel_devices_reporting": _with(
            f"SELECT count(DISTINCT iot_device_id) AS value FROM f WHERE {since_5m} AND {_IN_SELECTED}"),
        "panel_latest_event_time_by_country": _with(f"SELECT max(event_time) AS value FROM f WHERE {_IN_SELECTED}"),
        "panel_ingestion_lag_by_country": _lag(_IN_SELECTED),
        "panel_country_overview": _overview(),
        "panel_country_overview_selected": _overview(_IN_SELECTED),
        "panel_country_picker": _with("SELECT DISTINCT country_code FROM dim_country WHERE is_current = TRUE"),
    })
    def by_minute(value: str, where: str = "") -> str:
        return _with(f"""SELECT date_trunc('minute', event_time) AS time, country_code AS metric, {value} AS value
FROM f WHERE {since_1h}{where} GROUP BY 1, 2""")

    def by_hour(value: str, where: str = "") -> str:
        return _with(f"""SELECT hour_bucket AS time, country_code AS metric, {value} AS value
FROM h WHERE hour_bucket >= (SELECT t FROM anchor) - INTERVAL 24 HOUR{where}""")

    for metric in SERIES_METRICS:
        minute_value = rnd(f"avg({_METRIC_SQL[metric]})")
        sql[f"panel_series_{metric}_devices"] = _panel_series(metric, _DEVICES)
        sql[f"panel_metric_by_minute_{metric}"] = by_minute(minute_value)
        sql[f"panel_hourly_metric_by_country_{metric}"] = by_hour(rnd(_HOURLY_METRIC_SQL[metric]))
    for col in HOURLY_SERIES:
        sql[f"panel_hourly_{col}_devices"] = _panel_hourly(col, _DEVICES)
    sql["panel_metric_by_minute_unknown"] = by_minute("CAST(NULL AS DOUBLE)")
    sql["panel_hourly_metric_by_country_unknown"] = by_hour("CAST(NULL AS DOUBLE)")
    sql["panel_metric_by_minute_selected"] = by_minute(rnd("avg(temp)"), f" AND {_IN_SELECTED}")
    sql["panel_hourly_metric_by_country_selected"] = by_hour(rnd("avg_temp"), f" AND {_IN_SELECTED}")
    lag_value = "(SELECT date_sub('second', max(event_time), max(ingestion_time)) FROM f WHERE ingestion_time >= (SELECT t FROM anchor) - INTERVAL 10 MINUTE)"

    def step(name: str, value: str, lo: float, hi: float, higher_is_better: bool) -> str:
        top, bottom = ("green", "red") if higher_is_better else ("red", "green")
        return (f"SELECT '{name}' AS panel, CAST(v AS BIGINT) AS value, CASE WHEN v >= {hi} THEN '{top}' "
                f"WHEN v >= {lo} THEN 'yellow' WHEN v IS NOT NULL THEN '{bottom}' END AS status FROM (SELECT {value} AS v)")

    from tidewater.functions.measures import STATUS_STEPS as S

    sql.update({
        "series_reducers": _with(f"""SELECT CAST(iot_device_id AS VARCHAR) AS metric, {rnd('avg(temp)')} AS mean,
  {rnd('arg_max(temp, event_time)')} AS last, {rnd('max(temp)')} AS max FROM f GROUP BY 1"""),
        "last_not_null": _with(f"""SELECT CAST(iot_device_id AS VARCHAR) AS metric, {rnd('arg_max(wind_gust, event_time)')} AS value
FROM f WHERE wind_gust IS NOT NULL GROUP BY 1"""),
        "status_thresholds": _with(" UNION ALL ".join([
            step("active_devices", f"(SELECT count(DISTINCT iot_device_id) FROM f WHERE {since_5m})", *S["active_devices"]),
            step("active_countries", f"(SELECT count(DISTINCT country_code) FROM f WHERE {since_5m})", *S["active_countries"]),
            step("devices_reporting", f"(SELECT count(DISTINCT iot_device_id) FROM f WHERE {since_5m} AND {_IN_SELECTED})",
                 *S["devices_reporting"]),
            step("ingestion_lag_seconds", lag_value, *S["ingestion_lag_seconds"]),
        ])),
        "clamp_bounds": f"SELECT event_id, "
        + ", ".join((_clamp(m) if m in INT_METRICS else rnd(_clamp(m))) + f" AS {m}" for m in BOUNDS)
        + f" FROM {_spiky()}",
        "normalise_metrics": f"""SELECT event_id,
  CAST(round_even(((wind_deg % 360.0) + 360.0) % 360.0, 0) AS INTEGER) AS wind_deg,
  {rnd(f"least({_clamp('dew_point')}, {_clamp('temp')})")} AS dew_point
FROM {_spiky()}""",
        "event_time_format": f"""WITH m AS ({MEASUREMENTS})
SELECT iot_device_id, strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS event_iso,
  CAST(epoch(event_time) AS BIGINT) AS event_epoch,
  CAST(year(event_time) * 10000 + month(event_time) * 100 + day(event_time) AS INTEGER) AS date_key,
  CAST(isodow(event_time) AS INTEGER) AS iso_dow,
  date_sub('second', event_time, ingestion_time) AS lag_seconds,
  {_sk('CAST(iot_device_id AS VARCHAR)', 'CAST(event_time AS VARCHAR)')} AS row_key
FROM m""",
    })
    # single-batch load: every fact row takes the country of its device's
    # latest reading in the batch
    single = """cur AS (
  SELECT iot_device_id,
    """ + country_case('latitude', 'longitude', 'code') + """ AS country_code,
    """ + country_case('latitude', 'longitude', 'name') + """ AS country_name,
    """ + country_case('latitude', 'longitude', 'city') + """ AS city,
    latitude, longitude, timezone
  FROM (SELECT *, row_number() OVER (PARTITION BY iot_device_id ORDER BY event_time DESC NULLS LAST) AS _rn FROM r)
  WHERE _rn = 1
),
sf AS (
  SELECT """ + _sk('CAST(r.iot_device_id AS VARCHAR)', 'CAST(r.event_time AS VARCHAR)') + """ AS fact_sk,
    CAST(year(r.event_time) * 10000 + month(r.event_time) * 100 + day(r.event_time) AS INTEGER) AS date_key,
    """ + _sk('CAST(r.iot_device_id AS VARCHAR)', _CLOCK) + """ AS device_sk,
    """ + _sk('CAST(r.iot_device_id AS VARCHAR)', 'cur.country_code', _CLOCK) + """ AS country_sk,
    r.iot_device_id, cur.country_code, r.event_time, r.ingestion_time,
    """ + ", ".join(f"r.{c}" for c in MEAS) + """, r.weather_id, r.weather_main, r.weather_description
  FROM r LEFT JOIN cur ON cur.iot_device_id = r.iot_device_id
)"""
    sf_cols = ("fact_sk, date_key, device_sk, country_sk, iot_device_id, country_code, event_time, ingestion_time, "
               + ", ".join(rnd(c) + f" AS {c}" if c in DOUBLE_STAGING else c for c in MEAS)
               + ", weather_id, weather_main, weather_description")
    hourly_body = ", ".join(["hour_bucket", "iot_device_id", "country_code", *[rnd(c) + f" AS {c}" for c in HOURLY_COLS]])
    per_reading_country = country_case('latitude', 'longitude', 'code')
    sql.update({
        "stream_landing": f"WITH m AS ({MEASUREMENTS}) SELECT {_rounded_staging()} FROM m",
        "stream_warehouse_fact": _with_extra(single, f"SELECT {sf_cols} FROM sf"),
        "stream_warehouse_hourly": _with_extra(single + """,
sh AS (
  SELECT date_trunc('hour', event_time) AS hour_bucket, iot_device_id, arg_max(country_code, event_time) AS country_code,
    avg(temp) AS avg_temp, avg(feels_like) AS avg_feels_like, avg(humidity) AS avg_humidity,
    avg(pressure) AS avg_pressure, avg(wind_speed) AS avg_wind_speed, avg(uvi) AS avg_uvi,
    avg(clouds) AS avg_clouds, avg(visibility) AS avg_visibility, avg(rain_1h) AS avg_rain_1h
  FROM sf GROUP BY 1, 2
)""", f"SELECT {hourly_body} FROM sh"),
        "stream_warehouse_dims": _with_extra(single, "SELECT iot_device_id, latitude, longitude, timezone, "
                                             "country_code, country_name, city FROM cur"),
        "compaction": _with(f"SELECT {fact_cols} FROM f"),
        "stream_rollup": _with_extra(f"""placed AS (
  SELECT *, {per_reading_country} AS own_country FROM r
),
ph AS (
  SELECT date_trunc('hour', event_time) AS hour_bucket, iot_device_id, arg_max(own_country, event_time) AS country_code,
    avg(temp) AS avg_temp, avg(feels_like) AS avg_feels_like, avg(humidity) AS avg_humidity,
    avg(pressure) AS avg_pressure, avg(wind_speed) AS avg_wind_speed, avg(uvi) AS avg_uvi,
    avg(clouds) AS avg_clouds, avg(visibility) AS avg_visibility, avg(rain_1h) AS avg_rain_1h
  FROM placed GROUP BY 1, 2
)""", f"SELECT {hourly_body} FROM ph"),
        "stream_dedup": _with(f"SELECT {_rounded_staging()} FROM r"),
        "quarantine": f"""WITH m AS ({MEASUREMENTS}),
x AS (SELECT *, (CAST(epoch(event_time) AS BIGINT) + iot_device_id) % 10 AS k FROM m)
SELECT {_rounded_staging()} FROM (
  SELECT * REPLACE (CASE WHEN k <> 3 THEN event_time END AS event_time, CASE WHEN k <> 7 THEN iot_device_id END AS iot_device_id)
  FROM x WHERE k IN (3, 7))""",
        "quarantine_staging": _with(f"""SELECT {_rounded_staging()} FROM r
WHERE (CAST(epoch(event_time) AS BIGINT) + iot_device_id) % 10 NOT IN (3, 7)"""),
    })
    avg_cols = ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS avg_{c}" for c in
        ("temp", "feels_like", "humidity", "pressure", "wind_speed", "uvi", "clouds", "visibility", "rain_1h"))
    sql.update({
        "rollup_touched": _with(f"SELECT {_hourly_select()}"),
        "rollup_by_country": _with(f"""SELECT hour_bucket, iot_device_id, country_code, """
                                   + ", ".join(rnd(f"avg_{c}") + f" AS avg_{c}" for c in
                                               ("temp", "feels_like", "humidity", "pressure", "wind_speed", "uvi",
                                                "clouds", "visibility", "rain_1h"))
                                   + f""" FROM (
  SELECT date_trunc('hour', event_time) AS hour_bucket, iot_device_id, country_code, {avg_cols}
  FROM f GROUP BY 1, 2, 3)"""),
        "panel_device_series_long": _with(" UNION ALL ".join(
            f"SELECT event_time AS time, CAST(iot_device_id AS VARCHAR) AS device, '{m}' AS metric_name, "
            f"{rnd(_METRIC_SQL[m])} AS value FROM f WHERE event_time >= (SELECT t FROM anchor) - INTERVAL 1 HOUR"
            for m in ("temp", "humidity", "rain_1h", "wind_gust"))),
        "panel_hourly_metric_by_country_avg": _with(f"""SELECT hour_bucket AS time, country_code AS metric,
  {rnd('avg(avg_temp)')} AS value
FROM h WHERE hour_bucket >= (SELECT t FROM anchor) - INTERVAL 24 HOUR GROUP BY 1, 2"""),
    })
    sql["stream_rollup_window"] = sql["stream_rollup"]
    sql["catalog_tables"] = _with("""SELECT country_code, CAST(event_time AS DATE) AS day, count(*) AS events,
  count(DISTINCT iot_device_id) AS devices FROM f GROUP BY 1, 2""")
    sql["published_views"] = _with("""SELECT d.iot_device_id, d.timezone, count(*) AS events
FROM dim_device d JOIN f ON f.iot_device_id = d.iot_device_id WHERE d.is_current GROUP BY 1, 2""")
    sql["random_row_keys"] = _with("SELECT count(*) AS n_rows, count(*) AS n_keys, count(*) AS n_formed FROM r")
    sql["stream_last_not_null"] = sql["last_not_null"]

    def distinct_devices(hours: int, where: str = "") -> str:
        return _with(f"""SELECT count(DISTINCT iot_device_id) AS value FROM f
WHERE date_trunc('hour', event_time) >= date_trunc('hour', (SELECT t FROM anchor)) - INTERVAL {hours} HOUR{where}""")

    # at this size the sketches' error is below half a device
    sql["panel_active_devices_approx"] = distinct_devices(24)
    sql["panel_devices_reporting_approx"] = distinct_devices(48, f" AND {_IN_SELECTED}")
    return sql


def _with_extra(extra_ctes: str, body: str) -> str:
    return f"WITH {WAREHOUSE_CTES},\n{extra_ctes}\n{body}"
