"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions._args import ColumnOrExpr, as_column

# Radius of the earth in miles, kilometres in a mile.
EARTH_RADIUS_MILES = 3961
UNITS = {"mi": 1.0, "km": 1.60934}


def degrees_to_radians(degrees: ColumnOrExpr) -> Column:
    return F.radians(as_column(degrees))


def haversine_distance(
    lat1: ColumnOrExpr, lon1: ColumnOrExpr, lat2: ColumnOrExpr, lon2: ColumnOrExpr, unit: str = "mi"
) -> Column:
    """Distance over the globe between two points given in degrees, in ``mi`` or ``km``."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}, got {unit!r}")
    phi1, phi2 = degrees_to_radians(lat1), degrees_to_radians(lat2)
    lambda1, lambda2 = degrees_to_radians(lon1), degrees_to_radians(lon2)

    def haversine(angle: Column) -> Column:
        return F.pow(F.sin(angle / F.lit(2)), F.lit(2))

    chord = haversine(phi2 - phi1) + F.cos(phi1) * F.cos(phi2) * haversine(lambda2 - lambda1)
    diameter = F.lit(2.0 * EARTH_RADIUS_MILES * UNITS[unit])
    # Rounding can lift the chord of two antipodes a hair above one.
    return diameter * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))
