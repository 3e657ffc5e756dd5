"""Great-circle distance and the grid cells used to bound proximity joins."""
from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from transitlens.config import EARTH_RADIUS_M


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_m(lat1, lon1, lat2, lon2, radius_m: float = EARTH_RADIUS_M) -> Column:
    """Haversine distance in metres between two (lat, lon) points in degrees."""
    lat1, lon1, lat2, lon2 = (_c(x) for x in (lat1, lon1, lat2, lon2))
    s_lat = F.sin(F.radians(lat2 - lat1) / 2)
    s_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = s_lat * s_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s_lon * s_lon
    return F.lit(2 * radius_m) * F.asin(F.sqrt(a))


def fine_cell_deg(within_m: float, radius_m: float = EARTH_RADIUS_M, margin: float = 0.95) -> float:
    """Side (degrees) of a square lat/lon cell whose members are all closer than
    ``within_m`` to each other.

    For two points in one cell |dlat| <= g and |dlon| <= g.  The great-circle
    distance is at most the length of the path along the meridian and then
    along a parallel, R*|dlat| + R*cos(lat)*|dlon| <= 2*R*g.  Choosing
    2*R*g = margin * within_m keeps a 5 % gap to the threshold, far more than
    any floating-point error of the haversine evaluation.
    """
    return math.degrees(margin * within_m / (2.0 * radius_m))


def reach_deg(lat, within_m: float, radius_m: float = EARTH_RADIUS_M):
    """(dlat, dlon) in degrees that bound every point closer than ``within_m``.

    |dlat| <= d/R always.  For longitude, hav(d/R) >= cos(lat1)*cos(lat2)*hav(dlon)
    and cos(lat2) >= cos(|lat1| + d/R), which gives the bound below.  A small
    additive margin covers rounding.  Near the poles the bound degenerates and
    is capped at 180 degrees (the whole parallel).
    """
    theta = within_m / radius_m
    dlat = F.lit(math.degrees(theta) * 1.000001 + 1e-9)
    lat = _c(lat)
    lat_far = F.least(F.abs(F.radians(lat)) + F.lit(theta), F.lit(math.pi / 2))
    hav = math.sin(theta / 2) ** 2
    denom = F.cos(F.radians(lat)) * F.cos(lat_far)
    ratio = F.when(denom > F.lit(hav), F.lit(hav) / denom)
    dlon = F.coalesce(F.degrees(F.lit(2.0) * F.asin(F.sqrt(ratio))) * F.lit(1.000001) + F.lit(1e-9), F.lit(180.0))
    return dlat, dlon
