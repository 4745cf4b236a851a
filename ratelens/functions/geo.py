"""Geometry on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean radius of the earth in km.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance of two points given in degrees."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lng = F.sin(F.radians(lng2 - lng1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def unit_sphere(lat: Column, lng: Column) -> dict[str, Column]:
    """Cartesian x, y, z of a point given in degrees."""
    lat, lng = F.radians(lat), F.radians(lng)
    return {"x": F.cos(lat) * F.cos(lng), "y": F.cos(lat) * F.sin(lng), "z": F.sin(lat)}


def one_place(lat: Column, lng: Column) -> list[Column]:
    """Aggregates of latitude and longitude that come from one row: of the rows with both, the greatest pair.

    Pairs are compared by latitude, then longitude, to 12 decimals, as one whole
    number, so that the aggregate stays a hash aggregate.
    """
    steps = [(F.round(x * 1e12)).try_cast("decimal(20,0)") for x in (lat, lng)]
    order = F.try_add((steps[0] * F.lit(10**15).cast("decimal(16,0)")).cast("decimal(38,0)"), steps[1])
    return [F.max_by(lat, order), F.max_by(lng, order)]
