"""Rounding, rates and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371


def round_even(value: Column, digits: int = 0) -> Column:
    """Round half to even by scaling, as numpy does (``bround`` works on the decimal text instead)."""
    value = value.cast("double")
    if digits == 0:
        return F.rint(value)
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def rate(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole``; null when ``whole`` is zero."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    return ratio if digits is None else round_even(ratio, digits)


def log_distance(distance: Column) -> Column:
    return F.log1p(distance)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km; the root is capped at 1 so rounding noise cannot leave asin's domain."""
    half_lat = (F.radians(lat2) - F.radians(lat1)) / 2
    half_lon = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.sin(half_lat) * F.sin(half_lat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(
        half_lon
    ) * F.sin(half_lon)
    return F.asin(F.sqrt(F.when(chord > 1.0, 1.0).otherwise(chord))) * (2 * EARTH_RADIUS_KM)


def imd(mean: Column, std: Column, mobility: Column, digits: int) -> Column:
    """Differential mobility: how far a sector (or person) moves less than the baseline, in deviations."""
    return round_even(F.try_divide(mean - mobility, std), digits)
