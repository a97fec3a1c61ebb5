"""Great-circle distance from built-in trigonometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rounding import round_2dp

# Fixed value: mean radius of the spherical earth used by common warehouse geography types.
EARTH_RADIUS_KM = 6371.01


def distance_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Kilometres between two points, two decimals; NULL if a coordinate is missing or off the globe."""
    valid = (
        lat1.between(-90, 90)
        & lat2.between(-90, 90)
        & lng1.between(-180, 180)
        & lng2.between(-180, 180)
    )
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlng = F.sin(F.radians(lng2 - lng1) / 2)
    h = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlng * half_dlng
    # Rounding can push h a hair above 1 for antipodal points.
    km = F.asin(F.least(F.lit(1.0), F.sqrt(h))) * (2 * EARTH_RADIUS_KM)
    return F.when(valid, round_2dp(km))
