"""Great-circle distance and nearest reference point, as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackflow.config import EARTH_RADIUS_NM, Point


def great_circle_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Haversine distance in nautical miles as SQL text; null when a coordinate is.

    The clamp keeps antipodes in asin's domain. ``least`` skips nulls, hence the outer test.
    """
    h = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    known = f"{lat1} + {lon1} + {lat2} + {lon2} IS NOT NULL"
    return f"CASE WHEN {known} THEN {2 * EARTH_RADIUS_NM}D * asin(sqrt(least(1D, {h}))) END"


def great_circle_nm(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Distance between two positions given as column names or SQL expressions."""
    return F.expr(great_circle_sql(lat1, lon1, lat2, lon2))


def nearest(lat: str, lon: str, points: Sequence[Point]) -> Column:
    """Struct (dist, rank) of the closest point; ties go to the earlier one.

    The points are literals inside the projection, so no join and no shuffle is planned. The list
    is a parameter of the call and does not grow with the data. ``rank`` is the place in the list:
    a number travels cheaper through shuffles and aggregates than a name.
    """
    candidates = ", ".join(
        f"named_struct('dist', {great_circle_sql(lat, lon, f'{p.lat}D', f'{p.lon}D')}, 'rank', {rank})"
        for rank, p in enumerate(points)
    )
    return F.expr(f"array_min(array({candidates}))")


def point_id(rank: Column, points: Sequence[Point]) -> Column:
    return F.get(F.array(*[F.lit(p.id) for p in points]), rank)


def heading_change(now: Column, before: Column) -> Column:
    """Signed change of heading wrapped to [-180, 180)."""
    return F.pmod(now - before + F.lit(540.0), F.lit(360.0)) - F.lit(180.0)


def ceiling(clouds: Column) -> Column:
    """Lowest base among broken, overcast and obscured layers."""
    opaque = F.filter(clouds, lambda c: c["cover"].isin("BKN", "OVC", "OVX"))
    return F.array_min(F.transform(opaque, lambda c: c["base"]))
