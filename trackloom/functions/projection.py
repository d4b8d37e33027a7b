"""WGS84 latitude and longitude to transverse Mercator metres, as columns: Krueger's series, true to well under a millimetre within a zone."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS84 ellipsoid, and the scale and false easting of UTM.
AXIS, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, EASTING, NORTHING = 0.9996, 500000.0, 10000000.0

_N = FLATTENING / (2 - FLATTENING)
RADIUS = AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# The series' coefficients in the third flattening, to its fourth power.
ALPHA = [
    _N / 2 - 2 / 3 * _N**2 + 5 / 16 * _N**3 + 41 / 180 * _N**4,
    13 / 48 * _N**2 - 3 / 5 * _N**3 + 557 / 1440 * _N**4,
    61 / 240 * _N**3 - 103 / 140 * _N**4,
    49561 / 161280 * _N**4,
]


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) % 60 + 1).cast("int")


def utm(lat: Column, lon: Column, zone: Column | int) -> tuple[Column, Column]:
    """(easting, northing) in a zone, south of the equator with the false northing; null where the latitude is no number within 84 degrees."""
    zone = F.lit(zone) if isinstance(zone, int) else zone
    fits = F.abs(lat) <= 84
    phi, away = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    e = 2 * math.sqrt(_N) / (1 + _N)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi, eta = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for k, a in enumerate(ALPHA, 1):
        east = east + a * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
        north = north + a * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
    return F.when(fits, EASTING + SCALE * RADIUS * east), F.when(fits, SCALE * RADIUS * north + F.when(lat < 0, NORTHING).otherwise(0.0))
