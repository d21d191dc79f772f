"""Coordinate lookups: country by ordered bounding boxes, timezone by band.

Both lookups are plain Catalyst expressions (a CASE chain over literals), so
they stay inside whole-stage codegen, need no join and no shuffle, and cost a
few comparisons per row whatever the data size.  For box tables that arrive
as data rather than as code, see ``tidewater.operators.range_lookup``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession, functions as F, types as T


@dataclass(frozen=True)
class Box:
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float
    code: str
    name: str
    city: str


# --- fixed values (must equal the source system's tables) -------------------
# Country bounding boxes, evaluated in this order, first match wins, all
# bounds inclusive.  No match or a NULL coordinate gives UNKNOWN_COUNTRY.
COUNTRY_BOXES: tuple[Box, ...] = (
    Box(43.0, 83.34, -141.0, -52.32, "CA", "Canada", "Toronto"),
    Box(14.38, 32.5, -118.6, -98.5, "MX", "Mexico", "Mexico City"),
    Box(-4.23, 16.05, -82.12, -66.85, "CO", "Colombia", "Bogota"),
    Box(24.0, 49.5, -125.0, -66.9, "US", "United States", "New York"),
    Box(-56.73, -17.5, -109.68, -66.08, "CL", "Chile", "Santiago"),
    Box(-20.2, -0.04, -84.64, -68.65, "PE", "Peru", "Lima"),
    Box(-55.19, -21.78, -73.56, -53.64, "AR", "Argentina", "Buenos Aires"),
    Box(-33.87, 5.27, -73.98, -28.63, "BR", "Brazil", "Sao Paulo"),
    Box(49.67, 61.06, -14.02, 2.09, "GB", "United Kingdom", "London"),
    Box(50.75, 53.74, 3.36, 7.23, "NL", "Netherlands", "Amsterdam"),
    Box(46.37, 49.02, 9.53, 17.16, "AT", "Austria", "Vienna"),
    Box(47.27, 55.1, 5.87, 15.04, "DE", "Germany", "Berlin"),
    Box(35.29, 47.09, 6.63, 18.78, "IT", "Italy", "Rome"),
    Box(20.67, 36.0, -17.32, -0.99, "MA", "Morocco", "Casablanca"),
    Box(27.43, 43.99, -18.39, 4.59, "ES", "Spain", "Madrid"),
    Box(41.3, 51.31, -5.2, 9.56, "FR", "France", "Paris"),
    Box(49.0, 55.04, 14.07, 24.15, "PL", "Poland", "Warsaw"),
    Box(57.8, 71.3, 4.09, 15.0, "NO", "Norway", "Oslo"),
    Box(55.14, 69.06, 10.59, 24.18, "SE", "Sweden", "Stockholm"),
    Box(21.99, 31.83, 24.65, 37.12, "EG", "Egypt", "Cairo"),
    Box(4.07, 13.89, 2.68, 14.68, "NG", "Nigeria", "Lagos"),
    Box(-4.9, 4.62, 33.91, 41.91, "KE", "Kenya", "Nairobi"),
    Box(-47.18, -22.13, 16.33, 38.29, "ZA", "South Africa", "Johannesburg"),
    Box(22.63, 26.15, 51.42, 56.6, "AE", "United Arab Emirates", "Dubai"),
    Box(16.29, 32.15, 34.46, 55.67, "SA", "Saudi Arabia", "Riyadh"),
    Box(24.84, 39.78, 44.03, 63.33, "IR", "Iran", "Tehran"),
    Box(35.81, 42.3, 25.57, 44.82, "TR", "Turkey", "Istanbul"),
    Box(41.19, 82.06, 19.64, 180.0, "RU", "Russia", "Moscow"),
    Box(6.55, 35.67, 67.95, 97.4, "IN", "India", "Mumbai"),
    Box(1.13, 1.51, 103.57, 104.57, "SG", "Singapore", "Singapore"),
    Box(0.85, 8.38, 98.74, 119.47, "MY", "Malaysia", "Kuala Lumpur"),
    Box(-11.21, 6.27, 94.77, 141.02, "ID", "Indonesia", "Jakarta"),
    Box(5.61, 20.46, 97.34, 105.64, "TH", "Thailand", "Bangkok"),
    Box(22.14, 22.57, 113.82, 114.5, "HK", "Hong Kong", "Hong Kong"),
    Box(7.69, 23.39, 102.14, 114.86, "VN", "Vietnam", "Ho Chi Minh City"),
    Box(10.33, 26.44, 114.29, 122.33, "TW", "Taiwan", "Taipei"),
    Box(32.91, 38.62, 124.37, 132.12, "KR", "South Korea", "Seoul"),
    Box(20.21, 45.71, 122.71, 154.21, "JP", "Japan", "Tokyo"),
    Box(8.67, 53.56, 73.5, 134.78, "CN", "China", "Beijing"),
    Box(-47.29, -34.0, 166.43, 178.55, "NZ", "New Zealand", "Auckland"),
    Box(-43.74, -10.07, 113.16, 153.64, "AU", "Australia", "Sydney"),
)
UNKNOWN_COUNTRY = ("XX", "Unknown", "Unknown")

# Longitude bands, half-open lo <= lon < hi, first match wins, else "UTC".
TIMEZONE_BANDS: tuple[tuple[float, float, str], ...] = (
    (-180, -157, "America/Honolulu"),
    (-157, -127, "America/Los_Angeles"),
    (-127, -97, "America/Denver"),
    (-97, -67, "America/New_York"),
    (-67, -30, "America/Sao_Paulo"),
    (-30, 15, "Europe/London"),
    (15, 37, "Europe/Berlin"),
    (37, 60, "Asia/Dubai"),
    (60, 90, "Asia/Kolkata"),
    (90, 120, "Asia/Bangkok"),
    (120, 145, "Asia/Tokyo"),
    (145, 180, "Australia/Sydney"),
)
DEFAULT_TIMEZONE = "UTC"
# --- end of fixed values ------------------------------------------------------

COUNTRY_STRUCT = T.StructType(
    [T.StructField(n, T.StringType(), True) for n in ("country_code", "country_name", "city")]
)


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def box_index(lat: Column | str, lon: Column | str, boxes=COUNTRY_BOXES) -> Column:
    """0-based index of the first box containing (lat, lon), else NULL.

    A NULL coordinate is read as NaN, which is larger than any bound and so
    misses every box.  Without NULLs the generated method stays well under the
    8,000 bytes up to which the JVM compiles methods (5,953 against 11,743).
    """
    lat, lon = (F.coalesce(_as_col(c).cast("double"), F.lit(float("nan"))) for c in (lat, lon))
    expr = None
    for i, b in enumerate(boxes):
        cond = lat.between(b.lat_min, b.lat_max) & lon.between(b.lon_min, b.lon_max)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(None).cast("int"))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _country_text(lat: str, lon: str, boxes) -> str:
    """``country_of`` of two columns by name, as the text of the same expression."""
    y, x = (f"coalesce(CAST(`{c.replace('`', '``')}` AS DOUBLE), CAST('NaN' AS DOUBLE))" for c in (lat, lon))
    inside = lambda v, low, high: f"{v} >= {float(low)!r}D AND {v} <= {float(high)!r}D"
    whens = " ".join(
        f"WHEN {inside(y, b.lat_min, b.lat_max)} AND {inside(x, b.lon_min, b.lon_max)} THEN {i}" for i, b in enumerate(boxes)
    )
    place = f"CASE {whens} ELSE CAST(NULL AS INT) END + 1"
    fields = []
    for pos, field in enumerate(("code", "name", "city")):
        values = f"array({', '.join(_text(getattr(b, field)) for b in boxes)})"
        name = COUNTRY_STRUCT.fieldNames()[pos]
        fields.append(f"'{name}', coalesce(try_element_at({values}, {place}), {_text(UNKNOWN_COUNTRY[pos])})")
    return f"named_struct({', '.join(fields)})"


def country_of(lat: Column | str, lon: Column | str, boxes=COUNTRY_BOXES) -> Column:
    """struct<country_code, country_name, city> for a coordinate pair.

    Columns given by name are put into one SQL text: built call by call the
    expression takes the driver a second, several times a batch.
    """
    if isinstance(lat, str) and isinstance(lon, str) and "." not in lat + lon and boxes:
        return F.expr(_country_text(lat, lon, boxes))
    idx = box_index(lat, lon, boxes) + F.lit(1)
    picked = []
    for pos, field in enumerate(("code", "name", "city")):
        values = F.array(*[F.lit(getattr(b, field)) for b in boxes])
        picked.append(
            F.coalesce(F.try_element_at(values, idx), F.lit(UNKNOWN_COUNTRY[pos]))
            .alias(COUNTRY_STRUCT.fieldNames()[pos])
        )
    return F.struct(*picked)


def timezone_of(lon: Column | str, bands=TIMEZONE_BANDS, default: str = DEFAULT_TIMEZONE) -> Column:
    """Timezone name for a longitude by half-open band; NULL or miss -> default."""
    lon = _as_col(lon)
    expr = None
    for lo, hi, tz in bands:
        cond = (lon >= F.lit(lo)) & (lon < F.lit(hi))
        expr = F.when(cond, F.lit(tz)) if expr is None else expr.when(cond, F.lit(tz))
    return expr.otherwise(F.lit(default))


def boxes_frame(spark: SparkSession, boxes=COUNTRY_BOXES):
    """The box table as a small DataFrame with its evaluation order ``ord``."""
    rows = [(i, b.lat_min, b.lat_max, b.lon_min, b.lon_max, b.code, b.name, b.city) for i, b in enumerate(boxes)]
    return spark.createDataFrame(
        rows,
        "ord int, lat_min double, lat_max double, lon_min double, lon_max double, "
        "country_code string, country_name string, city string",
    )
