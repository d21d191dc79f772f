"""Measurement expressions: clamping, normalisation, status steps, metric choice."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values (must equal the source system's) ---------------------------
# Physical bounds per metric, (low, high); None = open on that side.
BOUNDS: dict[str, tuple[float | None, float | None]] = {
    "temp": (-60.0, 60.0),
    "feels_like": (-65.0, 65.0),
    "dew_point": (-65.0, 55.0),
    "pressure": (870, 1084),
    "humidity": (0, 100),
    "uvi": (0.0, 12.0),
    "clouds": (0, 100),
    "visibility": (100, 10000),
    "wind_speed": (0.0, None),
    "wind_gust": (0.0, None),
}
# Metrics stored as whole numbers.
INT_METRICS = ("pressure", "humidity", "clouds", "visibility")

# Dashboard status steps: name -> (lower, upper, higher_is_better).
# Higher is better: below `lower` red, below `upper` yellow, else green.
# Lower is better: below `lower` green, below `upper` yellow, else red.
STATUS_STEPS: dict[str, tuple[float, float, bool]] = {
    "active_devices": (30, 55, True),
    "active_countries": (20, 50, True),
    "devices_reporting": (10, 50, True),
    "ingestion_lag_seconds": (120, 300, False),
}

# Metric selector: name -> fact column expression and hourly column.
SELECTABLE_METRICS = ("temp", "humidity", "pressure", "wind_speed", "uvi", "rain_1h", "wind_gust")
# --- end of fixed values ------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp(value: Column | str, lo=None, hi=None) -> Column:
    """Clamp to [lo, hi] as DOUBLE; NULL stays NULL (greatest/least alone
    would turn it into the bound because they skip NULL arguments)."""
    v = _c(value).cast("double")
    out = v
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(v.isNull(), F.lit(None).cast("double")).otherwise(out)


def clamp_metric(name: str, value: Column | str | None = None) -> Column:
    """Clamp a named metric to its physical bounds; whole-number metrics are
    rounded half-to-even, the others to two decimals."""
    lo, hi = BOUNDS[name]
    clamped = clamp(value if value is not None else name, lo, hi)
    if name in INT_METRICS:
        return F.bround(clamped, 0).cast("int")
    return F.round(clamped, 2)


def wrap_degrees(deg: Column | str) -> Column:
    """Direction wrapped into [0, 360), rounded half-even to an integer."""
    return F.bround(F.pmod(_c(deg).cast("double"), F.lit(360.0)), 0).cast("int")


def cap_dew_point(dew_point: Column | str, temp: Column | str) -> Column:
    """Dew point may not exceed temperature; NULL temperature leaves it as is; two decimals."""
    dp, t = _c(dew_point), _c(temp)
    return F.round(F.when(t.isNull(), dp).otherwise(F.least(dp, t)), 2)


def status(value: Column | str, lower: float, upper: float, higher_is_better: bool = True) -> Column:
    """red / yellow / green step status of a value (NULL -> NULL)."""
    v = _c(value)
    top, bottom = ("green", "red") if higher_is_better else ("red", "green")
    return F.when(v >= upper, top).when(v >= lower, "yellow").when(v.isNotNull(), bottom)


def metric_value(metric: str) -> Column:
    """Per-event value for a selectable metric (fact columns)."""
    exprs = {
        "temp": F.col("temp"),
        "humidity": F.col("humidity").cast("double"),
        "pressure": F.col("pressure").cast("double"),
        "wind_speed": F.col("wind_speed"),
        "uvi": F.col("uvi"),
        "rain_1h": F.coalesce(F.col("rain_1h"), F.lit(0.0)),
        "wind_gust": F.coalesce(F.col("wind_gust"), F.col("wind_speed")),
    }
    if metric not in exprs:
        return F.lit(None).cast("double")
    return exprs[metric]


def hourly_metric_value(metric: str) -> Column:
    """Hourly-rollup column for a selectable metric; gust maps to wind speed."""
    cols = {
        "temp": "avg_temp",
        "humidity": "avg_humidity",
        "pressure": "avg_pressure",
        "wind_speed": "avg_wind_speed",
        "uvi": "avg_uvi",
        "rain_1h": "avg_rain_1h",
        "wind_gust": "avg_wind_speed",
    }
    if metric not in cols:
        return F.lit(None).cast("double")
    return F.col(cols[metric])
