import random

import duckdb

from pyspark.sql import functions as F

from tidewater.functions import geo
from tidewater.operators.range_lookup import lookup_boxes
from tidewater.sources.telemetry import STATIONS

LONS = [-180.0, -157.0, -156.999, 14.999, 15.0, 179.999, 180.0, None]


def first_by_sql(points) -> dict:
    """(lat, lon) -> (code, name, city) of the containing box of the smallest number, by DuckDB."""
    con = duckdb.connect()
    con.execute("CREATE TABLE box (ord INT, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, code VARCHAR, name VARCHAR, city VARCHAR)")
    con.executemany("INSERT INTO box VALUES (?, ?, ?, ?, ?, ?, ?, ?)", [
        (i, b.lat_min, b.lat_max, b.lon_min, b.lon_max, b.code, b.name, b.city) for i, b in enumerate(geo.COUNTRY_BOXES)])
    con.execute("CREATE TABLE pt (lat DOUBLE, lon DOUBLE)")
    con.executemany("INSERT INTO pt VALUES (?, ?)", sorted(set(points)))
    rows = con.execute("""SELECT lat, lon, arg_min(code, ord), arg_min(name, ord), arg_min(city, ord)
        FROM pt LEFT JOIN box ON lat BETWEEN a AND b AND lon BETWEEN c AND d GROUP BY lat, lon""").fetchall()
    return {(r[0], r[1]): r[2:] if r[2] else geo.UNKNOWN_COUNTRY for r in rows}


# Golden country of every gateway station (17 lie in more than one box).
GOLDEN = {
    1: "US", 2: "US", 3: "US", 4: "US", 5: "US", 6: "US", 7: "US", 8: "US", 9: "US", 10: "US",
    11: "GB", 12: "FR", 13: "DE", 14: "ES", 15: "IT", 16: "NL", 17: "AT", 18: "PL", 19: "SE", 20: "NO",
    21: "JP", 22: "CN", 23: "CN", 24: "KR", 25: "IN", 26: "IN", 27: "IN", 28: "ID", 29: "TH", 30: "SG",
    31: "MY", 32: "VN", 33: "HK", 34: "TW", 35: "JP", 36: "AU", 37: "AU", 38: "AU", 39: "AU", 40: "NZ",
    41: "EG", 42: "NG", 43: "KE", 44: "ZA", 45: "MA", 46: "AE", 47: "SA", 48: "IR", 49: "TR", 50: "RU",
    51: "BR", 52: "AR", 53: "BR", 54: "PE", 55: "CO", 56: "CL", 57: "MX", 58: "CA", 59: "CA", 60: "CA",
}


def test_station_golden(spark):
    df = spark.createDataFrame(STATIONS, "id int, lat double, lon double")
    got = {r.id: r.code for r in df.select("id", geo.country_of("lat", "lon").country_code.alias("code")).collect()}
    assert got == GOLDEN


def test_null_and_miss_fall_back(spark):
    df = spark.createDataFrame([(None, 10.0), (10.0, None), (0.0, -150.0)], "lat double, lon double")
    rows = df.select(geo.country_of("lat", "lon").alias("c")).select("c.*").collect()
    assert [tuple(r) for r in rows] == [geo.UNKNOWN_COUNTRY] * 3


def test_bounds_inclusive_and_first_match(spark):
    b = geo.COUNTRY_BOXES[0]
    pts = [(b.lat_min, b.lon_min), (b.lat_max, b.lon_max), (b.lat_max + 1e-9, b.lon_max)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    got = [r.c for r in df.select(geo.country_of("lat", "lon").country_code.alias("c")).collect()]
    assert got[:2] == ["CA", "CA"]
    assert got[2] == first_by_sql(pts)[pts[2]][0]


def test_native_matches_sql_on_random_points(spark):
    rnd = random.Random(7)
    pts = [(rnd.uniform(-60, 85), rnd.uniform(-180, 180)) for _ in range(2000)]
    # points sitting exactly on box edges
    for b in geo.COUNTRY_BOXES:
        pts += [(b.lat_min, b.lon_min), (b.lat_max, b.lon_max), (b.lat_min, b.lon_max)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    rows = df.select("lat", "lon", geo.country_of("lat", "lon").alias("c")).collect()
    want = first_by_sql(pts)
    for r in rows:
        assert (r.c.country_code, r.c.country_name, r.c.city) == want[r.lat, r.lon]


def test_join_form_matches_expression_form(spark):
    rnd = random.Random(11)
    pts = [(i, rnd.uniform(-60, 85), rnd.uniform(-180, 180)) for i in range(500)] + [(999, None, 1.0)]
    pts += [(1000, float("inf"), 1.0), (1001, 10.0, float("-inf")), (1002, float("nan"), 1.0), (1003, 10.0, float("nan"))]
    df = spark.createDataFrame(pts, "id int, latitude double, longitude double")
    joined = {r.id: r.country_code for r in lookup_boxes(df, geo.boxes_frame(spark)).collect()}
    native = {r.id: r.c for r in df.select("id", geo.country_of("latitude", "longitude").country_code.alias("c")).collect()}
    assert joined == native


def test_timezone_bands_half_open(spark):
    df = spark.createDataFrame([(x,) for x in LONS], "lon double")
    got = [r.tz for r in df.select(geo.timezone_of("lon").alias("tz")).collect()]
    assert got == ["America/Honolulu", "America/Los_Angeles", "America/Los_Angeles", "Europe/London", "Europe/Berlin",
                   "Australia/Sydney", "UTC", "UTC"]


def test_grid_join_path_matches_expression_form(spark):
    rnd = random.Random(5)
    pts = [(i, rnd.uniform(-60, 85), rnd.uniform(-180, 180)) for i in range(400)]
    for j, b in enumerate(geo.COUNTRY_BOXES):  # exact edges, incl. negative coordinates
        pts += [(1000 + 3 * j, b.lat_min, b.lon_min), (1001 + 3 * j, b.lat_max, b.lon_max),
                (1002 + 3 * j, b.lat_max, b.lon_min)]
    df = spark.createDataFrame(pts, "id int, latitude double, longitude double")
    grid = {r.id: (r.country_code, r.city) for r in
            lookup_boxes(df, geo.boxes_frame(spark), grid=7.5).collect()}
    native = {r.id: (r.c.country_code, r.c.city) for r in
              df.select("id", geo.country_of("latitude", "longitude").alias("c")).collect()}
    assert grid == native


def test_lookup_method_stays_compilable(spark, tmp_dir):
    spark.createDataFrame([(1.0, 2.0)], "lat double, lon double").write.parquet(f"{tmp_dir}/p")
    df = spark.read.parquet(f"{tmp_dir}/p").select(geo.country_of("lat", "lon"))
    code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(df._jdf.queryExecution().executedPlan())
    sizes = [int(line.split("maxMethodCodeSize:")[1].split(";")[0]) for line in code.splitlines() if "maxMethodCodeSize:" in line]
    assert sizes and max(sizes) < 8000


def test_many_boxes_of_every_size_and_shape(spark):
    """100,000 boxes: first match equal to a plain search, few candidates a point, four cells a box."""
    import numpy as np

    from tidewater.operators.range_lookup import box_cells

    rng = np.random.default_rng(4)
    n = 100_000
    size = 10.0 ** rng.uniform(-5, -0.5, (n, 2))
    size[:40], size[40:80, 0], size[80:120, 1], size[120:160] = 30.0, 40.0, 60.0, 0.0  # large, two ways long, points
    low = np.stack([rng.uniform(-85, 50, n), rng.uniform(-175, 110, n)], axis=1)
    low[:160] = np.round(low[:160])  # edges where cells of every size meet
    high = low + size
    boxes = spark.createDataFrame(
        [(i, float(low[i, 0]), float(high[i, 0]), float(low[i, 1]), float(high[i, 1]), f"c{i}", f"n{i}", f"t{i}") for i in range(n)],
        "ord int, lat_min double, lat_max double, lon_min double, lon_max double, country_code string, country_name string, city string",
    ).persist()
    cells = box_cells(boxes).persist()
    assert cells.groupBy("ord").count().agg(F.max("count")).first()[0] <= 4
    some = np.r_[rng.integers(0, n, 150), np.arange(160)]
    points = np.concatenate([low[some], high[some], (low[some] + high[some]) / 2, low[some] - 1e-7, rng.uniform(-90, 90, (100, 2))])
    rows = [(float(y), float(x)) for y, x in points] + [(None, 1.0), (1.0, None), (float("nan"), 1.0), (1.0, float("inf")), (500.0, 1.0)]
    got = lookup_boxes(spark.createDataFrame(rows, "latitude double, longitude double"), boxes).collect()
    assert len(got) == len(rows)
    for r in got:
        hit = np.array([], int)
        if r.latitude is not None and r.longitude is not None:
            hit = np.flatnonzero((low[:, 0] <= r.latitude) & (r.latitude <= high[:, 0]) & (low[:, 1] <= r.longitude) & (r.longitude <= high[:, 1]))
        assert r.country_code == (f"c{hit[0]}" if len(hit) else "XX")
    # boxes that share a cell of their own sizes: what a point in it is compared with
    per_cell = cells.groupBy("_ly", "_lx", "_gy", "_gx").count()
    assert per_cell.agg(F.max("count")).first()[0] < 200
    none = lookup_boxes(spark.createDataFrame(rows[:3], "latitude double, longitude double"), boxes.limit(0)).collect()
    assert [r.country_code for r in none] == ["XX"] * 3


def test_country_of_named_columns_is_one_text(spark, monkeypatch):
    corners = [(y, x) for b in geo.COUNTRY_BOXES for y in (b.lat_min, b.lat_max) for x in (b.lon_min, b.lon_max)]
    points = spark.createDataFrame([*corners, (None, 1.0), (1.0, None), (float("nan"), 0.0), (-0.0, 0.0)], "lat double, `lon``g` double")
    calls = geo.country_of(F.col("lat"), F.col("`lon``g`"))
    monkeypatch.setattr(F, "when", None)  # not built call by call
    text = geo.country_of("lat", "lon`g")
    both = points.select(calls.alias("a"), text.alias("b"))
    assert both.schema["a"].dataType == both.schema["b"].dataType
    assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
