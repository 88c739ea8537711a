"""Geometry as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def central_angle(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle angle in radians between points in degrees (haversine)."""
    half_lat, half_lon = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.lit(EARTH_KM) * central_angle(lat1, lon1, lat2, lon2)


def heading_change(before: Column, after: Column) -> Column:
    """The smaller angle between two headings, in degrees."""
    turn = F.abs(after - before)
    return F.when(turn > 180, 360 - turn).otherwise(turn)


def cell(value: Column, size: float) -> Column:
    """Index of the grid line nearest to a coordinate; halves go to the even index."""
    return F.rint(value / F.lit(size)).cast("long")
