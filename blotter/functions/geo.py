"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of a coordinate in a Morton key; a step is some 600 m at the equator.
MORTON_BITS = 16

# Fixed value: radius of the earth in kilometres.
EARTH_RADIUS_KM = 6371


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres between two points in degrees."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), 2) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def morton_key(lat: Column, lon: Column) -> Column:
    """The place of a point on a Morton curve over all latitudes and longitudes, as a long.

    The bits of both coordinates take turns. Coordinates out of range count as the nearest in range;
    null if one is missing.
    """

    def steps(degrees: Column, least: float, span: float) -> Column:
        size = float(1 << MORTON_BITS)
        at = F.floor((degrees.cast("double") - least) / span * size)
        within = F.greatest(F.lit(0.0), F.least(at.cast("double"), F.lit(size - 1))).cast("long")
        return F.when(degrees.isNotNull() & ~F.isnan(degrees.cast("double")), within)

    def apart(value: Column) -> Column:
        # Each step halves the groups of bits and moves them apart by as many places.
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return value

    y, x = apart(steps(lat, -90.0, 180.0)), apart(steps(lon, -180.0, 360.0))
    return F.shiftleft(y, 1).bitwiseOR(x)
