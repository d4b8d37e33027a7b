"""Cameras, boxes and the earth as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackloom.functions.angles import to_local

# The WGS84 ellipsoid.
RADIUS, ECCENTRICITY2 = 6378137.0, 0.0066943799901413165


def pinhole(x: Column, y: Column, z: Column, fx: float, fy: float, cx: float, cy: float, width: int, height: int) -> tuple[Column, Column, Column]:
    """u, v, and whether the point is in front of the camera and in the image."""
    u, v = x * fx / z + cx, y * fy / z + cy
    return u, v, (z > 0.5) & (u >= 0) & (u < width) & (v >= 0) & (v < height)


def fisheye(x: Column, y: Column, z: Column, fx: float, fy: float, cx: float, cy: float, k: tuple[float, float, float, float], limit_deg: float = 87.0) -> tuple[Column, Column, Column]:
    """Equidistant projection with four coefficients: u, v, and whether the angle is under the limit."""
    r = F.hypot(x, y)
    theta = F.atan2(r, z)
    t2 = theta * theta
    bent = theta * (1 + k[0] * t2 + k[1] * t2 * t2 + k[2] * t2 * t2 * t2 + k[3] * t2 * t2 * t2 * t2)
    scale = bent / F.greatest(r, F.lit(1e-9))
    return scale * x * fx + cx, scale * y * fy + cy, theta < math.radians(limit_deg)


def ground_ray(rx: Column, ry: Column, height: float) -> tuple[Column, Column]:
    """Where a ray (rx, ry, 1) of a level camera meets the ground `height` below it: distance ahead and aside."""
    ahead = height / ry
    return ahead, ahead * rx


def footprint(x: Column, y: Column, length: Column, width: Column, yaw: Column) -> Column:
    """Array of the four corners (x, y), clockwise from front left."""
    c, s = F.cos(yaw), F.sin(yaw)
    corner = lambda sx, sy: F.struct((x + c * sx * length / 2 - s * sy * width / 2).alias("x"), (y + s * sx * length / 2 + c * sy * width / 2).alias("y"))
    return F.array(corner(1, 1), corner(1, -1), corner(-1, -1), corner(-1, 1))


def inside_box(px: Column, py: Column, x: Column, y: Column, length: Column, width: Column, yaw: Column) -> Column:
    along, across = to_local(px - x, py - y, yaw)
    return (F.abs(along) <= length / 2) & (F.abs(across) <= width / 2)


def ecef(lat_deg: Column, lon_deg: Column, alt: Column) -> tuple[Column, Column, Column]:
    lat, lon = F.radians(lat_deg), F.radians(lon_deg)
    n = RADIUS / F.sqrt(1 - ECCENTRICITY2 * F.sin(lat) * F.sin(lat))
    return (n + alt) * F.cos(lat) * F.cos(lon), (n + alt) * F.cos(lat) * F.sin(lon), (n * (1 - ECCENTRICITY2) + alt) * F.sin(lat)


def enu(lat: Column, lon: Column, alt: Column, lat0: Column, lon0: Column, alt0: Column) -> tuple[Column, Column, Column]:
    """East, north and up of a place as seen from an origin."""
    dx, dy, dz = (a - b for a, b in zip(ecef(lat, lon, alt), ecef(lat0, lon0, alt0), strict=True))
    p, q = F.radians(lat0), F.radians(lon0)
    east = -F.sin(q) * dx + F.cos(q) * dy
    north = -F.sin(p) * F.cos(q) * dx - F.sin(p) * F.sin(q) * dy + F.cos(p) * dz
    return east, north, F.cos(p) * F.cos(q) * dx + F.cos(p) * F.sin(q) * dy + F.sin(p) * dz


def metres_per_degree(lat_deg: Column) -> tuple[Column, Column]:
    """Of latitude and of longitude, by the usual cosine series."""
    r = F.radians(lat_deg)
    return 111132.92 - 559.82 * F.cos(2 * r) + 1.175 * F.cos(4 * r) - 0.0023 * F.cos(6 * r), 111412.84 * F.cos(r) - 93.5 * F.cos(3 * r) + 0.118 * F.cos(5 * r)


def valid_rotation(m: list[list[Column]], tolerance: float = 1e-6) -> Column:
    """Finite, orthonormal rows, determinant 1."""
    dot = lambda a, b: a[0] * b[0] + a[1] * b[1] + a[2] * b[2]
    det = m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0]) + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])
    ok = F.abs(det - 1) < tolerance
    for i in range(3):
        for j in range(i, 3):
            ok = ok & (F.abs(dot(m[i], m[j]) - float(i == j)) < tolerance)
    return F.coalesce(ok, F.lit(False))


def fit_rotation(x: str, y: str, u: str, v: str) -> Column:
    """Aggregate: the angle that best turns (x, y) into (u, v), both about their means."""
    return F.atan2(F.covar_pop(x, v) - F.covar_pop(y, u), F.covar_pop(x, u) + F.covar_pop(y, v))


def fitted_shift(x: str, y: str, u: str, v: str) -> tuple[Column, Column, Column]:
    """Aggregates (angle, shift, shift): the turn and shift with the least squared error from (x, y) to (u, v), at scale 1.

    The turn is a proper one whatever the points: a set that a reflection would fit better gets its best rotation all the same.
    """
    angle = fit_rotation(x, y, u, v)
    c, s = F.cos(angle), F.sin(angle)
    return angle, F.avg(u) - (c * F.avg(x) - s * F.avg(y)), F.avg(v) - (s * F.avg(x) + c * F.avg(y))


Matrix = list[list[Column]]


def inverse3(m: Matrix) -> Matrix:
    """The inverse of a 3 x 3 matrix by its cofactors; null where the determinant is 0."""
    minor = lambda i, j: m[(i + 1) % 3][(j + 1) % 3] * m[(i + 2) % 3][(j + 2) % 3] - m[(i + 1) % 3][(j + 2) % 3] * m[(i + 2) % 3][(j + 1) % 3]
    det = F.nullif(m[0][0] * minor(0, 0) + m[0][1] * minor(0, 1) + m[0][2] * minor(0, 2), F.lit(0.0))
    return [[minor(j, i) / det for j in range(3)] for i in range(3)]


def ground_point(u: Column, v: Column, camera: Matrix, turn: Matrix, shift: list[Column], height: float = 0.0) -> tuple[Column, Column]:
    """Ego (x, y) where the ray through a pixel meets the ground at `height`; null where it doesn't point down or meets it behind the camera.

    camera is the 3 x 3 matrix of intrinsics; turn and shift carry ego coordinates into the camera's.
    """
    back = inverse3(camera)
    ray = [row[0] * u + row[1] * v + row[2] for row in back]
    into = lambda w: [turn[0][k] * w[0] + turn[1][k] * w[1] + turn[2][k] * w[2] for k in range(3)]
    at, way = [-c for c in into(shift)], into(ray)
    far = F.when(way[2] < -1e-6, (height - at[2]) / way[2])
    hits = far > 0
    return F.when(hits, at[0] + far * way[0]), F.when(hits, at[1] + far * way[1])
