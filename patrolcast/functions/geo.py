"""Geospatial column expressions (haversine, bearing, nearest fixed point).

All functions return ``Column`` expressions: they stay inside whole-stage
codegen and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import EARTH_RADIUS_KM, STATIONS


def _c(x) -> Column:
    return x if isinstance(x, Column) else (F.col(x) if isinstance(x, str) else F.lit(x))


def haversine(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in km; the root argument is clamped to 1 against rounding."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dlmb = F.radians(_c(lon2)) - F.radians(_c(lon1))
    h = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def bearing(lon1, lat1, lon2, lat2) -> Column:
    """Initial bearing from point 1 to point 2 in degrees, in (-180, 180]."""
    l1, p1 = F.radians(_c(lon1)), F.radians(_c(lat1))
    l2, p2 = F.radians(_c(lon2)), F.radians(_c(lat2))
    y = F.sin(l2 - l1) * F.cos(p2)
    x = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(l2 - l1)
    return F.degrees(F.atan2(y, x))


def nearest_point(x, y, points=None) -> Column:
    """Struct ``(dist, idx, lon, lat)`` of the nearest of a few fixed points.

    The minimum of an array of structs orders by distance first and index
    second, so ties go to the lowest index. No join: the points are literals,
    so the expression is a narrow projection (for a large point table use a
    spatial grid join instead).
    """
    points = STATIONS if points is None else points
    cands = [
        F.struct(haversine(x, y, F.lit(lon), F.lit(lat)).alias("dist"), F.lit(i).alias("idx"),
                 F.lit(lon).alias("lon"), F.lit(lat).alias("lat"))
        for i, (_, lon, lat) in enumerate(points)
    ]
    return F.array_min(F.array(*cands))


# --- SQL twins (DuckDB dialect) used by the oracle queries -----------------

def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    h = (f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * "
         f"pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)")
    return f"({2 * EARTH_RADIUS_KM!r} * asin(sqrt(least({h}, 1.0))))"


def bearing_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    y = f"sin(radians({lon2}) - radians({lon1})) * cos(radians({lat2}))"
    x = (f"cos(radians({lat1})) * sin(radians({lat2})) - sin(radians({lat1})) * cos(radians({lat2})) * "
         f"cos(radians({lon2}) - radians({lon1}))")
    return f"degrees(atan2({y}, {x}))"


def nearest_sql(x: str = "X", y: str = "Y") -> tuple[str, str, str]:
    """(distance, station lon, station lat) SQL of the nearest station; ties -> lowest index."""
    ds = [haversine_sql(x, y, repr(lon), repr(lat)) for _, lon, lat in STATIONS]
    dmin = f"least({', '.join(ds)})"
    lon = "CASE " + " ".join(f"WHEN {d} = {dmin} THEN {lon!r}" for d, (_, lon, _) in zip(ds, STATIONS)) + " END"
    lat = "CASE " + " ".join(f"WHEN {d} = {dmin} THEN {lat!r}" for d, (_, _, lat) in zip(ds, STATIONS)) + " END"
    return dmin, lon, lat
