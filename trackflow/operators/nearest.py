"""Nearest of a large set of reference points: branch and bound down nested cells, as a chain of equi-joins.

``functions.geo.nearest`` puts a handful of points into the projection. Here the points are a table of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackflow.config import EARTH_RADIUS_NM
from trackflow.functions.geo import great_circle_nm, great_circle_sql

STEP = 2  # a cell has 4 ** STEP cells of the next level
DEPTH = 14  # the finest cells are 180 / 2 ** 14 degrees high, two thirds of a nautical mile
BOUNDED = 4096  # levels of at most so many cells are small by construction

KNOWN = "{lat} BETWEEN -90 AND 90 AND {lon} BETWEEN -180 AND 180"  # false for null and NaN


def least_distance_sql() -> str:
    """No place of a cell is nearer: each term of the haversine formula at its least over the cell's box.

    The longitude gap is taken around the circle; of the cosines inside the box, the smaller end is the least.
    """
    up = "greatest(__south - __lat, __lat - __north, 0D)"
    across = "greatest(abs(pmod(__lon - (__west + __east) / 2 + 540D, 360D) - 180D) - (__east - __west) / 2, 0D)"
    h = (
        f"pow(sin(radians({up}) / 2), 2) + greatest(cos(radians(__lat)), 0D) "
        f"* greatest(least(cos(radians(__south)), cos(radians(__north))), 0D) * pow(sin(radians({across}) / 2), 2)"
    )
    return f"{2 * EARTH_RADIUS_NM}D * asin(sqrt(least(1D, {h})))"


def cells(places: DataFrame, level: int, depth: int) -> DataFrame:
    """Non-empty cells of one level: parent, box of the places inside, and one of them."""
    shift = depth - level
    at = places.select(F.shiftright("__x", shift).alias("__x"), F.shiftright("__y", shift).alias("__y"), "__plat", "__plon")
    some = F.min(F.struct("__plat", "__plon"))
    boxes = at.groupBy("__x", "__y").agg(
        F.min("__plat").alias("__south"), F.max("__plat").alias("__north"), F.min("__plon").alias("__west"),
        F.max("__plon").alias("__east"), some.alias("__some"),
    )
    return boxes.withColumns({"__px": F.shiftright("__x", STEP), "__py": F.shiftright("__y", STEP)})


def nearest_place(
    rows: DataFrame, places: DataFrame, id_col: str, lat: str = "lat", lon: str = "lon", depth: int = DEPTH
) -> DataFrame:
    """``rows`` with the id of the nearest place (``nearest_id``) and its great-circle distance (``nearest_nm``).

    ``places`` has ``id_col``, ``lat`` and ``lon``; of equally near ones the smallest id counts. The result is exact: a cell is
    left only if no place in it can be nearer than a place already seen. Different positions are searched once, however often
    they repeat, and places at one position are one. Level by level, a position keeps the cells that may hold its nearest
    place, a few at a time, and meets their inner cells by an equi-join; the first levels have at most 4,096 cells and are
    broadcast. Unknown or impossible coordinates (null, NaN, out of range) have no nearest place and are none; without
    places all rows have null.
    """
    if depth % STEP or depth <= 0:
        raise ValueError(f"depth must be a positive multiple of {STEP}")
    side = 1 << depth
    spot = lambda c, low, span: F.least(F.floor((F.col(c) - F.lit(low)) / F.lit(span) * side), F.lit(side - 1)).cast("int")
    known = places.where(KNOWN.format(lat="lat", lon="lon")).groupBy(F.col("lat").alias("__plat"), F.col("lon").alias("__plon"))
    known = known.agg(F.min(id_col).alias("__id")).withColumns({"__x": spot("__plon", -180.0, 360.0), "__y": spot("__plat", -90.0, 180.0)})

    here = rows.select(F.col(lat).cast("double").alias("__lat"), F.col(lon).cast("double").alias("__lon")).where(KNOWN.format(lat="__lat", lon="__lon"))
    first = [F.struct(F.lit(x).alias("__cx"), F.lit(y).alias("__cy")) for x in range(2**STEP) for y in range(2**STEP)]
    front = here.distinct().select("__lat", "__lon", F.inline(F.array(*first)))
    best = Window.partitionBy("__lat", "__lon")
    for level in range(STEP, depth + 1, STEP):
        inner = cells(known, level, depth)
        inner = F.broadcast(inner) if 4**level <= BOUNDED else inner
        x, y = ("__x", "__y") if level == STEP else ("__px", "__py")
        met = front.join(inner, (F.col("__cx") == F.col(x)) & (F.col("__cy") == F.col(y))).withColumns({
            "__least": F.expr(least_distance_sql()), "__seen": great_circle_nm("__lat", "__lon", "__some.__plat", "__some.__plon"),
        })
        near = met.withColumn("__seen", F.min("__seen").over(best)).where("__least <= __seen * (1 + 1e-9D) + 1e-6D")
        front = near.select("__lat", "__lon", F.col("__x").alias("__cx"), F.col("__y").alias("__cy"))
    last = front.join(known, (F.col("__cx") == F.col("__x")) & (F.col("__cy") == F.col("__y")))
    found = last.groupBy("__lat", "__lon").agg(F.expr(f"min(struct({great_circle_sql('__lat', '__lon', '__plat', '__plon')} AS nm, __id AS id))").alias("__best"))
    on = (F.col(lat).cast("double") == F.col("__lat")) & (F.col(lon).cast("double") == F.col("__lon"))
    joined = rows.join(found, on, "left")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], F.col("__best.id").alias("nearest_id"), F.col("__best.nm").alias("nearest_nm"))
