"""Stateful stream operators over scenes. Rows of a micro-batch are sorted by time; rows older than the state are dropped and counted."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DECAY, FAR, TURN = 0.7, 10.0, 0.5
OUT = "scene long, t long, cells int, total double, reset boolean, late int"
STATE = "scene binary, t binary, pose binary, filled binary, value binary"


def block(scene: str = "scene") -> Column:
    """64 scenes of neighbouring numbers: one call of Python and one record of state serve them all."""
    return F.shiftright(scene, 6)


def warped(grids: np.ndarray, dx: np.ndarray, dy: np.ndarray, turn: np.ndarray, cell: float = 1.0) -> np.ndarray:
    """Each grid as seen after moving by its (dx, dy) and turning: each new cell reads the nearest old one, 0 from outside."""
    m, n = grids.shape[:2]
    at = np.arange(n) - n // 2
    x, y = np.meshgrid(at * cell, at * cell, indexing="ij")
    c, s, dx, dy = (k[:, None, None] for k in (np.cos(turn), np.sin(turn), dx, dy))
    r = np.rint((c * x - s * y + dx) / cell).astype(int) + n // 2
    q = np.rint((s * x + c * y + dy) / cell).astype(int) + n // 2
    inside = (r >= 0) & (r < n) & (q >= 0) & (q < n)
    old = np.where(inside, r * n + q, 0).reshape(m, n * n)
    return np.where(inside, np.take_along_axis(grids.reshape(m, n * n), old, 1).reshape(grids.shape), 0.0)


class Accumulator:
    """Decayed log-odds of many scenes, each in the frame of its moving ego; a missing pose, a step of FAR or more, or a turn of TURN or
    more starts anew. Only cells that are not zero are dumped."""

    def __init__(self, size: int = 16, state: tuple | None = None) -> None:
        scene, t, pose, filled, value = state or (b"",) * 5
        self.scene, self.t, self.pose = np.frombuffer(scene, np.int64), np.frombuffer(t, np.int64), np.frombuffer(pose).reshape(-1, 3)
        self.grid = np.zeros((len(self.scene), size, size))
        self.grid.reshape(-1)[np.frombuffer(filled, np.int32)] = np.frombuffer(value)

    def dump(self) -> tuple:
        flat = self.grid.reshape(-1)
        filled = np.flatnonzero(flat)
        return tuple(a.tobytes() for a in (self.scene, self.t, self.pose, filled.astype(np.int32), flat[filled]))

    def meet(self, scenes: np.ndarray) -> None:
        """Room for scenes that were not met before; they have no pose."""
        every = np.union1d(self.scene, scenes)
        at, size = np.searchsorted(every, self.scene), self.grid.shape[1]
        t, pose, grid = np.zeros(len(every), np.int64), np.full((len(every), 3), np.nan), np.zeros((len(every), size, size))
        t[at], pose[at], grid[at] = self.t, self.pose, self.grid
        self.scene, self.t, self.pose, self.grid = every, t, pose, grid

    def add(self, at: np.ndarray, t: np.ndarray, pose: np.ndarray, cell: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cells, total, reset) of one next frame of each scene in these places; a cell is a place in all grids laid end to end."""
        x, y, yaw = (pose - self.pose[at]).T
        turn = (yaw + np.pi) % (2 * np.pi) - np.pi
        goes_on = (np.hypot(x, y) < FAR) & (np.abs(turn) < TURN)  # not where a pose is missing
        c, s = np.cos(self.pose[at, 2]), np.sin(self.pose[at, 2])
        on, x, y = at[goes_on], (c * x + s * y)[goes_on], (c * y - s * x)[goes_on]
        moved = DECAY * warped(self.grid[on], x, y, turn[goes_on])
        self.grid[at] = 0.0
        self.grid[on] = moved
        np.add.at(self.grid.reshape(-1), cell, value)
        self.t[at], self.pose[at] = t, pose
        grid = self.grid[at].reshape(len(at), -1)
        return (np.abs(grid) > 1e-9).sum(axis=1), grid.sum(axis=1), ~goes_on


def advance(rows: pd.DataFrame, held: Accumulator) -> pd.DataFrame:
    """All scenes take their first frame at once, then their second, and so on."""
    scene, t = (rows[k].to_numpy(np.int64) for k in ("scene", "t"))
    place, value = rows[["r", "c"]].to_numpy(float), rows["v"].to_numpy(float)
    order = np.lexsort((value, place[:, 1], place[:, 0], t, scene))
    scene, t, place, value, pose = scene[order], t[order], place[order], value[order], rows[["x", "y", "yaw"]].to_numpy(float)[order]
    begins = np.concatenate([np.ones(min(1, len(t)), bool), (np.diff(scene) != 0) | (np.diff(t) != 0)])
    first, frame = np.flatnonzero(begins), np.cumsum(begins) - 1
    missing = np.bincount(frame, np.isnan(pose).any(axis=1)) > 0
    scene, t, pose = scene[first], t[first], np.where(missing[:, None], np.nan, pose[first])

    known = np.isin(scene, held.scene)
    held.meet(scene)
    at = np.searchsorted(held.scene, scene)
    go = np.flatnonzero(~(known & (t <= held.t[at])))
    n = np.arange(len(go))
    turn = n - np.maximum.accumulate(np.where(np.diff(scene[go], prepend=scene[go][:1] - 1) != 0, n, 0))
    turns = np.full(len(first), -1)
    turns[go] = turn

    size = held.grid.shape[1]
    inside = np.flatnonzero(((place >= 0) & (place < size)).all(axis=1))
    inside = inside[np.argsort(turns[frame[inside]], kind="stable")]
    cell, value = at[frame[inside]] * size * size + (place[inside] @ [size, 1]).astype(int), value[inside]
    go, last = go[np.argsort(turn, kind="stable")], int(turn.max(initial=-1))
    frames, cells_of = (np.searchsorted(turns[of], np.arange(last + 2)) for of in (go, frame[inside]))
    cells, total, reset = np.zeros(len(first), int), np.zeros(len(first)), np.zeros(len(first), bool)
    for k in range(last + 1):
        own, its = go[frames[k] : frames[k + 1]], slice(cells_of[k], cells_of[k + 1])
        cells[own], total[own], reset[own] = held.add(at[own], t[own], pose[own], cell[its], value[its])
    total = np.copysign(np.floor(np.abs(total) * 1e9 + 0.5) / 1e9, total)  # halves away from zero, as in SQL
    late = np.where(turns < 0, np.bincount(frame), 0)
    return pd.DataFrame({"scene": scene, "t": t, "cells": cells, "total": total, "reset": reset, "late": late})


def accumulate_stream(rows: DataFrame, size: int = 16) -> DataFrame:
    """One row per scene and frame of a stream of (scene, t, x, y, yaw, r, c, v). A frame's cells must arrive in one micro-batch; where all
    of a block's rows of a micro-batch lie in one file, its state is written once for them."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = Accumulator(size, state.get if state.exists else None)
        yield advance(pd.concat(list(parts)), held)
        state.update(held.dump())

    return rows.dropna(subset=["scene", "t"]).withColumn("block", block()).groupBy("block").applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def accumulate_batch(rows: DataFrame, size: int = 16) -> DataFrame:
    """The same over a table: each scene from its start."""

    def whole(part: pd.DataFrame) -> pd.DataFrame:
        return advance(part, Accumulator(size))

    return rows.dropna(subset=["scene", "t"]).withColumn("block", block()).groupBy("block").applyInPandas(whole, OUT)


def frame_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream; the limit per trigger is the back pressure."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
