"""Great-circle distances as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Distance that stays accurate, and never NaN, down to coincident points."""
    half_dlat = F.radians(lat2 - lat1) / 2.0
    half_dlng = F.radians(lng2 - lng1) / 2.0
    chord = F.pow(F.sin(half_dlat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_dlng), F.lit(2.0))
    return F.asin(F.sqrt(_within_one(chord))) * (2.0 * EARTH_RADIUS_KM)


def law_of_cosines_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Spherical law of cosines, with the cosine held inside [-1, 1].

    Rounding lifts the cosine of coincident points above 1, where ``acos`` is
    NaN; it also cancels digits below some metres. Prefer ``haversine_km``.
    """
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    cosine = F.sin(phi1) * F.sin(phi2) + F.cos(phi1) * F.cos(phi2) * F.cos(F.radians(lng2 - lng1))
    return F.acos(_within_one(cosine)) * EARTH_RADIUS_KM


def _within_one(value: Column) -> Column:
    # least() and greatest() skip nulls, which would give an unknown position a distance
    return F.when(value > 1.0, F.lit(1.0)).when(value < -1.0, F.lit(-1.0)).otherwise(value)
