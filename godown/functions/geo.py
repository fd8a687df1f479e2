"""Road distance between two points given in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from godown.config import EARTH_KM, ROAD_FACTOR


def road_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance (acos form, argument clamped at 1) times the road factor."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    cosine = F.sin(p1) * F.sin(p2) + F.cos(p1) * F.cos(p2) * F.cos(F.radians(lon2 - lon1))
    return F.lit(EARTH_KM) * F.acos(F.least(F.lit(1.0), cosine)) * F.lit(ROAD_FACTOR)
