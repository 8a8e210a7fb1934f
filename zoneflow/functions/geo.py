"""Great-circle distance and the box predicate that lets a scan skip far-away rows."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088  # fixed value: mean Earth radius


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km between two points given in degrees."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * (half_lon * half_lon)
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def in_box(lat: Column, lon: Column, center_lat: float, center_lon: float, radius_km: float) -> Column:
    """True for every point within the radius, and for few others.

    Plain comparisons with literals, so they reach the file scan. Longitudes are in [-180, 180].
    """
    slack = 1e-6
    angle = radius_km / EARTH_RADIUS_KM
    reach = math.degrees(angle) + slack
    box = lat.between(center_lat - reach, center_lat + reach)
    if angle + math.radians(abs(center_lat)) >= math.pi / 2 - slack:
        return box  # the circle touches a pole: every longitude is possible
    spread = math.degrees(math.asin(math.sin(angle) / math.cos(math.radians(center_lat)))) + slack
    west, east = center_lon - spread, center_lon + spread
    if west < -180:
        return box & ((lon >= west + 360) | (lon <= east))
    if east > 180:
        return box & ((lon >= west) | (lon <= east - 360))
    return box & lon.between(west, east)
