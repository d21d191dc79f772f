"""First-match 2-D range lookup against a box table held as data.

For box tables fixed in code, ``functions.geo.country_of`` (a CASE chain) is
cheaper still.  This form takes the boxes as a DataFrame with an evaluation
order ``ord``:

1. the points' *distinct* coordinates are looked up, not every row;
2. every axis of a box gets cells of a size of its own, the smallest power of
   two (of ``COARSEST`` degrees) that is not below the box's extent, so a box
   lies in at most two cells an axis, four in all, whether it is a country or
   a street, a square or a strip; points are laid onto the cells of each pair
   of sizes that the box table uses, and both meet in an equi-join on the cell
   -- of which Spark may broadcast or shuffle either side -- with the exact
   bounds as a residual filter.  A point so meets only boxes of about its
   cell's size that overlap its cell;
3. the first matching box is ``min(ord)`` per coordinate (an integer
   aggregate, so a hash aggregate), joined back to the box attributes.

Points matching no box, or with a coordinate that is NULL, NaN or infinite,
get the fallback values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.functions.geo import UNKNOWN_COUNTRY

#: Degrees of the largest cell, and how often it is halved at most (to some ten metres).
COARSEST, LEVELS = 1024.0, 23
ATTRS = ("country_code", "country_name", "city")


def _level(lo: str, hi: str, grid: float) -> Column:
    """How often the largest cell can be halved and still be as long as the box."""
    extent = F.greatest(F.col(hi) - F.col(lo), F.lit(grid / 2**LEVELS))
    return F.least(F.greatest(F.floor(F.log2(F.lit(grid) / extent)), F.lit(0)), F.lit(LEVELS)).cast("int")


def _cell(place: Column, level: Column, grid: float) -> Column:
    return F.floor(place * F.pow(F.lit(2.0), level) / grid).cast("long")


def box_cells(boxes: DataFrame, grid: float = COARSEST) -> DataFrame:
    """The cells of each box: at most four rows a box, unless it is larger than the largest cell."""
    levels = boxes.filter("lat_min <= lat_max AND lon_min <= lon_max").select(
        "ord", "lat_min", "lat_max", "lon_min", "lon_max",
        _level("lat_min", "lat_max", grid).alias("_ly"), _level("lon_min", "lon_max", grid).alias("_lx"),
    )
    for cell, level, lo, hi in (("_gy", "_ly", "lat_min", "lat_max"), ("_gx", "_lx", "lon_min", "lon_max")):
        reached = F.sequence(_cell(F.col(lo), F.col(level), grid), _cell(F.col(hi), F.col(level), grid))
        levels = levels.select("*", F.explode(reached).alias(cell))
    return levels


def match_first(coords: DataFrame, boxes: DataFrame, lat: str, lon: str, grid: float = COARSEST) -> DataFrame:
    """(lat, lon) -> ord of the first containing box, for distinct finite coords."""
    inside = (
        F.col(lat).between(F.col("lat_min"), F.col("lat_max"))
        & F.col(lon).between(F.col("lon_min"), F.col("lon_max"))
    )
    cells = box_cells(boxes, grid)
    # the pairs of sizes in use: as many as the square of the levels at most, whatever the boxes
    sizes = [(r[0], r[1]) for r in cells.select("_ly", "_lx").distinct().collect()]
    if not sizes:
        return coords.limit(0).withColumn("ord", F.lit(None).cast("int"))
    pairs = F.array(*[F.struct(F.lit(y).alias("_ly"), F.lit(x).alias("_lx")) for y, x in sorted(sizes)])
    keyed = coords.select("*", F.explode(pairs).alias("_size")).select(
        lat, lon, F.col("_size._ly").alias("_ly"), F.col("_size._lx").alias("_lx")
    )
    keyed = keyed.withColumns({"_gy": _cell(F.col(lat), F.col("_ly"), grid), "_gx": _cell(F.col(lon), F.col("_lx"), grid)})
    hits = keyed.join(cells, ["_ly", "_lx", "_gy", "_gx"]).filter(inside)
    return hits.groupBy(lat, lon).agg(F.min("ord").alias("ord"))


def _on_globe(c: str):
    # also false for NULL, NaN (larger than any number) and the infinities
    return F.col(c).between(-360.0, 360.0)


def lookup_boxes(points: DataFrame, boxes: DataFrame, lat: str = "latitude", lon: str = "longitude",
                 fallback=UNKNOWN_COUNTRY, grid: float = COARSEST) -> DataFrame:
    """``points`` plus the attributes of the first box containing each point.
    ``grid`` is the size of the largest cell in degrees."""
    coords = points.select(lat, lon).where(_on_globe(lat) & _on_globe(lon)).distinct()
    first = match_first(coords, boxes, lat, lon, grid)
    attrs = first.join(boxes.select("ord", *ATTRS), "ord").drop("ord")
    joined = points.join(attrs, [lat, lon], "left")
    return joined.select(
        *[c for c in points.columns],
        *[F.coalesce(F.col(a), F.lit(v)).alias(a) for a, v in zip(ATTRS, fallback)],
    )
