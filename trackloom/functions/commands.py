"""Driving commands and plans as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackloom.functions.angles import wrap


def reordered(onehot: Column) -> Column:
    """[left, straight, right, unknown] -> [straight, left, right]; unknown becomes all zero. Anything but one 1 among four is an error."""
    total = F.aggregate(onehot, F.lit(0), lambda a, v: a + v)
    checked = F.when((F.size(onehot) != 4) | (total > 1), F.raise_error(F.lit("a command is one of four"))).otherwise(F.array(onehot[1], onehot[0], onehot[2]))
    return checked.cast("array<int>")


def intent(lateral: Column, threshold: float) -> Column:
    """left if any lateral offset is over the threshold, else right if any is under its negative, else straight."""
    return F.when(F.array_max(lateral) > threshold, "left").when(F.array_min(lateral) < -threshold, "right").otherwise("straight")


def plan_at(plan: Column, t: Column, step: float) -> Column:
    """A plan of values at 0, step, 2 * step, ... at time t, linear in between, its last value after the end."""
    last = F.size(plan) - 1
    k = F.least(F.floor(t / step).cast("int"), last - 1)
    share = F.least(t / step - k, F.lit(1.0))
    return F.element_at(plan, k + 1) + share * (F.element_at(plan, k + 2) - F.element_at(plan, k + 1))


def best_mode(logits: Column, modes: Column) -> Column:
    """The mode of the largest logit, the first of equals."""
    return F.element_at(modes, F.array_position(logits, F.array_max(logits)).cast("int"))


def extended(points: Column, more: int, hold: bool = False) -> Column:
    """A plan of (x, y) longer by `more` points: its last step repeated, or its last point."""
    end = F.element_at(points, -1)
    before = F.element_at(points, -2)
    far = lambda k: end if hold else F.struct((end["x"] + k * (end["x"] - before["x"])).alias("x"), (end["y"] + k * (end["y"] - before["y"])).alias("y"))
    return F.concat(points, F.array(*[far(k) for k in range(1, more + 1)]))


def poses(points: Column, epsilon: float = 1e-4) -> Column:
    """(x, y, heading) of a plan that starts at the origin. A step of no more than epsilon keeps the heading before it, 0 at the start;
    headings go on without jumps of a whole turn."""
    origin = F.array(F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")))
    steps = F.zip_with(F.concat(origin, F.slice(points, F.lit(1), F.size(points) - 1)), points, lambda a, b: F.struct(b["x"].alias("x"), b["y"].alias("y"), (b["x"] - a["x"]).alias("dx"), (b["y"] - a["y"]).alias("dy")))
    kind = "struct<last:double,heading:double,out:array<struct<x:double,y:double,heading:double>>>"

    def step(acc: Column, s: Column) -> Column:
        now = F.when(F.hypot(s["dx"], s["dy"]) > epsilon, F.atan2(s["dy"], s["dx"])).otherwise(acc["last"])
        heading = F.when(F.size(acc["out"]) == 0, now).otherwise(acc["heading"] + wrap(now - acc["last"]))
        return F.struct(now.alias("last"), heading.alias("heading"), F.concat(acc["out"], F.array(F.struct(s["x"].alias("x"), s["y"].alias("y"), heading.alias("heading")))).alias("out")).cast(kind)

    start = F.struct(F.lit(0.0).alias("last"), F.lit(0.0).alias("heading"), F.array().cast("array<struct<x:double,y:double,heading:double>>").alias("out")).cast(kind)
    return F.aggregate(steps, start, step)["out"]
