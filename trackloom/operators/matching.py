"""Greedy matching and suppression. They depend on order inside a frame: Spark sorts the boxes by frame, and a task goes through batches of
many frames. Frames are cut by (scene, frame) and hold a bounded number of boxes. The four matching rules are not interchangeable."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MATCH = "frame long, pred long, truth long, distance double"


#: A frame's boxes, or one side of them: arrays by column, classes as numbers.
Boxes = dict[str, np.ndarray]


def by_frame(df: DataFrame, order: list, run: Callable, schema: str) -> DataFrame:
    """run() over Arrow batches in which frames stand together, each in the given order; the frame at a batch's end may go on in the next."""
    return df.repartition("frame").sortWithinPartitions("frame", *order).mapInArrow(run, schema)


def whole_frames(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Boxes, list[tuple[int, int]]]]:
    """Tables of whole frames, their columns as arrays, and where each frame begins and ends. Of one frame too many, only that one waits."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        frame = batch.column("frame").to_numpy(zero_copy_only=False)
        last = int(np.argmax(frame == frame[-1]))  # where the batch's last frame begins
        if held and (last or held[-1].column("frame")[-1].as_py() != frame[0]):
            yield _cut([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        elif last:
            yield _cut([batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield _cut(held)


def _cut(parts: list[pa.RecordBatch]) -> tuple[pa.Table, Boxes, list[tuple[int, int]]]:
    table = pa.Table.from_batches(parts)
    columns = {n: table.column(n).combine_chunks() for n in table.column_names}
    if "cls" in columns:
        columns["cls"] = columns["cls"].dictionary_encode().indices.fill_null(-1)
    boxes = {n: c.to_numpy(zero_copy_only=False) for n, c in columns.items()}
    frame = boxes["frame"]
    starts = [0, *(np.flatnonzero(frame[1:] != frame[:-1]) + 1).tolist()]
    return table, boxes, list(zip(starts, [*starts[1:], len(frame)], strict=True))


def _distances(p: Boxes, t: Boxes, same_class: bool) -> np.ndarray:
    a, b = ({c: np.asarray(side[c]) for c in ("x", "y", "cls")} for side in (p, t))
    d = np.hypot(a["x"][:, None] - b["x"][None, :], a["y"][:, None] - b["y"][None, :])
    if same_class:
        d = np.where(a["cls"][:, None] == b["cls"][None, :], d, np.inf)
    return d


def _nearest_free(d: np.ndarray, order: list[int], radius: float, closed: bool) -> list[tuple[int, int]]:
    """Each row in order takes the nearest column no other row has taken, the first of equals, within radius."""
    free, out = np.ones(d.shape[1], bool), []
    for i in order:
        row = np.where(free, d[i], np.inf)
        if len(row) and (j := int(np.argmin(row))) >= 0 and (row[j] <= radius if closed else row[j] < radius):
            free[j] = False
            out.append((i, j))
    return out


def score_first(p: Boxes, t: Boxes, radius: float) -> list[tuple[int, int]]:
    """Detections by falling score take the nearest free truth of their class."""
    return _nearest_free(_distances(p, t, True), np.argsort(-np.asarray(p["score"]), kind="stable").tolist(), radius, False)


def truth_first(p: Boxes, t: Boxes, radius: float) -> list[tuple[int, int]]:
    """Truths in their order take the nearest free detection of their class."""
    return [(i, j) for j, i in _nearest_free(_distances(p, t, True).T, list(range(len(t["x"]))), radius, False)]


def listed_order(p: Boxes, t: Boxes, radius: float) -> list[tuple[int, int]]:
    """Detections in their order, whatever their score, take the nearest free truth."""
    return _nearest_free(_distances(p, t, True), list(range(len(p["x"]))), radius, False)


def run_pairs(p: Boxes, t: Boxes, radius: float) -> list[tuple[int, int]]:
    """Boxes of one run in their order take the nearest free box of another run; the radius itself still matches."""
    return _nearest_free(_distances(p, t, True), list(range(len(p["x"]))), radius, True)


def _overlap(p: Boxes, t: Boxes) -> np.ndarray:
    """IoU of axis-aligned boxes (x, y, w, l by corner and size), 0 across classes."""
    p, t = ({c: np.asarray(side[c]) for c in ("x", "y", "w", "l", "cls")} for side in (p, t))
    a = [c[:, None] for c in (p["x"], p["y"], p["x"] + p["w"], p["y"] + p["l"])]
    b = [c[None, :] for c in (t["x"], t["y"], t["x"] + t["w"], t["y"] + t["l"])]
    inter = np.clip(np.minimum(a[2], b[2]) - np.maximum(a[0], b[0]), 0, None) * np.clip(np.minimum(a[3], b[3]) - np.maximum(a[1], b[1]), 0, None)
    area = (p["w"] * p["l"])[:, None] + (t["w"] * t["l"])[None, :] - inter
    return np.where(p["cls"][:, None] == t["cls"][None, :], inter / np.maximum(area, 1e-12), 0.0)


def by_overlap(p: Boxes, t: Boxes, least: float) -> list[tuple[int, int]]:
    """Detections by falling score take the free truth of largest IoU, at least `least`."""
    return _nearest_free(-_overlap(p, t), np.argsort(-np.asarray(p["score"]), kind="stable").tolist(), -least, True)


def match(pred: DataFrame, truth: DataFrame, rule: Callable, limit: float) -> DataFrame:
    """(frame, pred, truth, distance) of every box: matched pairs, and boxes of either side alone with null for the other.

    pred and truth: frame, id, cls, score, x, y, w, l. Order inside a frame is by id.
    """
    columns = ["frame", "id", "cls", "score", "x", "y", "w", "l"]
    both = pred.select(*columns, F.lit(True).alias("said")).unionByName(truth.select(*columns, F.lit(False).alias("said")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, every, places in whole_frames(batches):
            frame, pred, truth, distance = [], [], [], []
            for lo, hi in places:
                said, own = every["said"][lo:hi], {c: every[c][lo:hi] for c in columns[1:]}
                p, t = ({c: v[side] for c, v in own.items()} for side in (said, ~said))
                pairs = rule(p, t, limit) if len(p["x"]) and len(t["x"]) else []
                i, j = np.array(pairs, np.int64).reshape(-1, 2).T
                alone, missed = np.delete(p["id"], i).tolist(), np.delete(t["id"], j).tolist()
                pred += p["id"][i].tolist() + alone + [None] * len(missed)
                truth += t["id"][j].tolist() + [None] * len(alone) + missed
                distance += np.hypot(p["x"][i] - t["x"][j], p["y"][i] - t["y"][j]).tolist() + [None] * (len(alone) + len(missed))
                frame += [int(every["frame"][lo])] * (len(i) + len(alone) + len(missed))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (frame, pred, truth)), pa.array(distance, pa.float64())], names=["frame", "pred", "truth", "distance"])

    return by_frame(both, [F.asc_nulls_last(c) for c in ("id", "score", "x", "y", "w", "l")], run, MATCH)


def _suppressed(boxes: DataFrame, one: Callable) -> DataFrame:
    """The boxes that one(own) names of each frame, in whose arrays they stand by falling score. Equal scores go by number, then place and size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, every, places in whole_frames(batches):
            kept = [lo + k for lo, hi in places for k in one({c: v[lo:hi] for c, v in every.items()})]
            yield from table.take(pa.array(kept, pa.int64())).to_batches()

    return by_frame(boxes, [F.desc_nulls_last("score"), *(F.asc_nulls_last(c) for c in ("box", "x", "y", "l", "w"))], run, boxes.schema)


def centre_nms(boxes: DataFrame, margin: float = 0.0) -> DataFrame:
    """Boxes by falling score; one whose centre lies in a kept box of its class (axis-aligned, grown by margin) goes."""

    def one(own: Boxes) -> list[int]:
        x, y, w, l, cls = (own[c] for c in ("x", "y", "w", "l", "cls"))
        left, kept = np.ones(len(x), bool), []
        for i in range(len(x)):
            if left[i]:
                kept.append(i)
                left &= ~((cls == cls[i]) & (np.abs(x - x[i]) <= w[i] / 2 + margin) & (np.abs(y - y[i]) <= l[i] / 2 + margin))
        return kept

    return _suppressed(boxes, one)


def clip_polygon(subject: list[tuple[float, float]], clip: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Intersection of two convex polygons with counter-clockwise corners, half-plane by half-plane."""
    out = subject
    for (ax, ay), (bx, by) in zip(clip, clip[1:] + clip[:1], strict=True):
        side = [(bx - ax) * (py - ay) - (by - ay) * (px - ax) for px, py in out]
        new = []
        for k, (p, s) in enumerate(zip(out, side, strict=True)):
            q, r = out[k - 1], side[k - 1]
            if (s >= 0) != (r >= 0):
                u = r / (r - s)
                new.append((q[0] + u * (p[0] - q[0]), q[1] + u * (p[1] - q[1])))
            if s >= 0:
                new.append(p)
        out = new
        if not out:
            return []
    return out


def area(polygon: list[tuple[float, float]]) -> float:
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(polygon, polygon[1:] + polygon[:1], strict=True))) / 2


def corners(x: float, y: float, l: float, w: float, yaw: float) -> list[tuple[float, float]]:  # noqa: E741
    c, s = np.cos(yaw), np.sin(yaw)
    return [(x + c * a * l / 2 - s * b * w / 2, y + s * a * l / 2 + c * b * w / 2) for a, b in ((1, 1), (-1, 1), (-1, -1), (1, -1))]


def rotated_iou(a: tuple, b: tuple) -> tuple[float, float]:
    """(IoU, intersection over the smaller area) of two rotated boxes (x, y, l, w, yaw)."""
    pa, pb = corners(*a), corners(*b)
    inter = area(clip_polygon(pa, pb)) if np.hypot(a[0] - b[0], a[1] - b[1]) <= (np.hypot(a[2], a[3]) + np.hypot(b[2], b[3])) / 2 else 0.0
    aa, ab = a[2] * a[3], b[2] * b[3]
    return inter / max(aa + ab - inter, 1e-12), inter / max(min(aa, ab), 1e-12)


def rotated_nms(boxes: DataFrame, iou: float = 0.3, contained: float = 0.7, yaw: str = "score") -> DataFrame:
    """Boxes by falling score; one that overlaps a kept one by iou, or lies in it by `contained`, goes. Equal scores go by number, then place and size."""

    def one(own: Boxes) -> list[int]:
        shapes = list(zip(*(own[c].tolist() for c in ("x", "y", "l", "w", yaw)), strict=True))
        x, y, half = own["x"], own["y"], np.hypot(own["l"], own["w"]) / 2
        kept: list[int] = []
        for i, shape in enumerate(shapes):
            before = np.array(kept, np.int64)
            near = before[np.hypot(x[before] - x[i], y[before] - y[i]) <= half[before] + half[i]]  # no others can overlap
            over = (rotated_iou(shape, shapes[k]) for k in near.tolist())
            if not any(u >= iou or v >= contained for u, v in over):
                kept.append(i)
        return kept

    return _suppressed(boxes, one)
