"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Mean earth radius by unit.
EARTH_RADIUS = {"miles": 3958.7613, "kilometers": 6371.0088}


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "miles") -> Column:
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_chord = (
        F.pow(F.sin((phi2 - phi1) / 2), F.lit(2.0))
        + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), F.lit(2.0))
    )
    return F.asin(F.sqrt(F.least(half_chord, F.lit(1.0)))) * F.lit(2 * EARTH_RADIUS[unit])
