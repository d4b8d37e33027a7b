"""Angles and quaternions as column expressions; quaternions are (w, x, y, z)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Quaternion = tuple[Column, Column, Column, Column]
Vector = tuple[Column, Column, Column]


def wrap(angle: Column) -> Column:
    """To [-pi, pi); floored modulo, so negative angles wrap too."""
    return F.pmod(angle + math.pi, F.lit(2 * math.pi)) - math.pi


def axis_error(a: Column, b: Column) -> Column:
    """Difference of two directions that may point either way along their axis, in [0, pi/2]."""
    d = F.abs(wrap(a - b))
    return F.least(d, math.pi - d)


def yaw(q: Quaternion) -> Column:
    w, x, y, z = q
    return F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))


def product(a: Quaternion, b: Quaternion) -> Quaternion:
    aw, ax, ay, az = a
    bw, bx, by, bz = b
    return (aw * bw - ax * bx - ay * by - az * bz, aw * bx + ax * bw + ay * bz - az * by, aw * by - ax * bz + ay * bw + az * bx, aw * bz + ax * by - ay * bx + az * bw)


def conjugate(q: Quaternion) -> Quaternion:
    return q[0], -q[1], -q[2], -q[3]


def rotation(q: Quaternion) -> list[list[Column]]:
    """The rotation matrix of a unit quaternion."""
    w, x, y, z = q
    return [
        [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
        [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
        [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)],
    ]


def transform(matrix: list[list[Column]], shift: Vector, p: Vector) -> Vector:
    return tuple(m[0] * p[0] + m[1] * p[1] + m[2] * p[2] + t for m, t in zip(matrix, shift, strict=True))


def inverse_transform(matrix: list[list[Column]], shift: Vector, p: Vector) -> Vector:
    d = [a - t for a, t in zip(p, shift, strict=True)]
    return tuple(matrix[0][k] * d[0] + matrix[1][k] * d[1] + matrix[2][k] * d[2] for k in range(3))


def to_local(dx: Column, dy: Column, heading: Column) -> tuple[Column, Column]:
    """A world offset in the frame of something that looks along heading."""
    c, s = F.cos(heading), F.sin(heading)
    return c * dx + s * dy, c * dy - s * dx


def to_world(x: Column, y: Column, heading: Column) -> tuple[Column, Column]:
    c, s = F.cos(heading), F.sin(heading)
    return c * x - s * y, s * x + c * y


def quarter_turns(angle_deg: Column) -> Column:
    """Degrees to the nearest multiple of 90; halves go to the even quarter."""
    return F.rint(angle_deg / 90) * 90
