"""Great-circle distance as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3959
KM_PER_MILE = 1.60934

_RADIUS_KM = EARTH_RADIUS_MILES * KM_PER_MILE


def great_circle_km(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Haversine distance in km between two points given in degrees."""
    half_lat = F.radians(F.col(lat2) - F.col(lat1)) / 2
    half_lon = F.radians(F.col(lon2) - F.col(lon1)) / 2
    shrink = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    chord = F.sqrt(F.pow(F.sin(half_lat), 2) + shrink * F.pow(F.sin(half_lon), 2))
    # Rounding may push the chord of antipodal points past one, where asin is NaN.
    chord = F.when(chord > 1.0, F.lit(1.0)).otherwise(chord)
    return F.asin(chord) * (2 * _RADIUS_KM)
