"""Great-circle distance and the grid used to join by it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from venuemart.lexicons import EARTH_RADIUS


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Distance in metres between two points given in degrees."""
    lon1, lat1, lon2, lat2 = (F.radians(c) for c in (lon1, lat1, lon2, lat2))
    h = F.pow(F.sin((lat2 - lat1) / 2), F.lit(2)) + F.cos(lat1) * F.cos(lat2) * F.pow(
        F.sin((lon2 - lon1) / 2), F.lit(2)
    )
    # `least` would take 1 for a NaN.
    return F.lit(2 * EARTH_RADIUS) * F.asin(F.sqrt(F.when(F.isnan(h), h).otherwise(F.least(h, F.lit(1.0)))))


def _unit_sphere(lon: Column, lat: Column) -> list[Column]:
    lon, lat = F.radians(lon), F.radians(lat)
    return [F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)]


def _reach(radius: float) -> float:
    """Half a cell in metres: at least the straight-line length of an arc of `radius`, plus rounding."""
    return radius * (1 + 1e-6) + 1e-3


def cell_of(lon: Column, lat: Column, radius: float) -> list[Column]:
    """The cell (x, y, z) of a point; cells are cubes of space, so poles and the date line are ordinary."""
    side = 2 * _reach(radius)
    return [F.floor(v * F.lit(EARTH_RADIUS / side)) for v in _unit_sphere(lon, lat)]


def cells_within(lon: Column, lat: Column, radius: float) -> list[Column]:
    """Per axis, the one or two cell numbers that anything within `radius` of the point can have."""
    side = 2 * _reach(radius)
    half = F.lit(0.5)
    scaled = [v * F.lit(EARTH_RADIUS / side) for v in _unit_sphere(lon, lat)]
    return [F.array_distinct(F.array(F.floor(v - half), F.floor(v + half))) for v in scaled]
