"""Points and distances."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the point type.
CARTESIAN = 7203
GEOGRAPHIC = 4326
EARTH_RADIUS_M = 6_371_000.0
_FIELDS = ("x", "y", "z", "latitude", "longitude", "height")


def point(**coords: Column | float) -> Column:
    """point({x, y[, z]}) or point({latitude, longitude[, height]})."""
    srid = GEOGRAPHIC if "latitude" in coords else CARTESIAN

    def value(name):
        v = coords.get(name)
        return (v if isinstance(v, Column) else F.lit(v)).cast("double").alias(name)

    return F.struct(F.lit(srid).alias("srid"), *[value(n) for n in _FIELDS])


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres between coordinates in degrees."""
    def half(x: Column) -> Column:
        return (1 - F.cos(F.radians(x))) / 2

    h = half(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon2 - lon1)
    return EARTH_RADIUS_M * 2.0 * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def distance(a: Column, b: Column) -> Column:
    """Metres for geographic points, plane Euclidean distance otherwise."""
    plane = F.sqrt(F.pow(b["x"] - a["x"], F.lit(2)) + F.pow(b["y"] - a["y"], F.lit(2)))
    sphere = haversine(a["latitude"], a["longitude"], b["latitude"], b["longitude"])
    return F.when(a["srid"] == GEOGRAPHIC, sphere).otherwise(plane)


def within_bbox(p: Column, lower_left: Column, upper_right: Column) -> Column:
    """Borders included."""
    def inside(axis: str) -> Column:
        return p[axis].between(lower_left[axis], upper_right[axis])

    return F.when(p["srid"] == GEOGRAPHIC, inside("latitude") & inside("longitude")).otherwise(inside("x") & inside("y"))
