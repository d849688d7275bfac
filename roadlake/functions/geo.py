"""Distances, bearings and projections as column expressions. Two earth radii are in use; they are never unified."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metres for matching and laps, kilometres for summaries, planar metres per degree.
RADIUS_M = 6_371_000.0
RADIUS_KM = 6371.0088
METRES_PER_DEGREE = 111_320.0
ROUTE_METRES_PER_DEGREE = 111_195.0


def _hav(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2.0)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2.0)
    return half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = RADIUS_M) -> Column:
    """Great-circle metres, arctangent form."""
    h = _hav(lat1, lon1, lat2, lon2)
    return F.lit(2.0 * radius) * F.atan2(F.sqrt(h), F.sqrt(F.lit(1.0) - h))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = RADIUS_KM) -> Column:
    """Great-circle kilometres, arcsine form."""
    return F.lit(2.0 * radius) * F.asin(F.sqrt(_hav(lat1, lon1, lat2, lon2)))


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing from the first point to the second, in [0, 360)."""
    p1, p2, dl = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    angle = F.degrees(F.atan2(F.sin(dl) * F.cos(p2), F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl)))
    return (angle + 360.0) % 360.0


def bearing_delta(a: Column, b: Column) -> Column:
    """Smallest angle between two bearings, in [0, 180]."""
    turn = F.abs(a - b) % 360.0
    return F.least(turn, F.lit(360.0) - turn)


def planar_m(lat: Column, lon: Column, lat0: Column, lon0: Column, per_degree: float = ROUTE_METRES_PER_DEGREE) -> Column:
    """Equirectangular metres from (lat0, lon0), with longitude scaled at lat0."""
    dy = (lat - lat0) * per_degree
    dx = (lon - lon0) * per_degree * F.cos(F.radians(lat0))
    return F.sqrt(dx * dx + dy * dy)


def segment_fraction(bx: Column, by: Column, px: Column, py: Column) -> Column:
    """How far along a planar segment (bx, by) the point (px, py) projects, clamped to [0, 1]; 0 on a point-like one."""
    length2 = bx * bx + by * by
    share = (px * bx + py * by) / F.nullif(length2, F.lit(0.0))
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)), F.lit(0.0))
