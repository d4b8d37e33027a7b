"""Array kernels for one frame's raster, hosted in grouped maps: components, holes, distances, fills, skeletons, polylines.

Rasters travel as sparse cells (frame, r, c) and are dense only inside a task, cut to the frame's own extent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.operators.grids import square
from trackloom.operators.joins import neighbours
from trackloom.operators.sequences import parabola_weights, parabolas


def dense(rows: pd.DataFrame, pad: int = 0) -> tuple[np.ndarray, int, int]:
    """(mask, first row, first column) of a frame's cells."""
    r0, c0 = int(rows["r"].min()) - pad, int(rows["c"].min()) - pad
    mask = np.zeros((int(rows["r"].max()) - r0 + 1 + pad, int(rows["c"].max()) - c0 + 1 + pad), bool)
    mask[rows["r"] - r0, rows["c"] - c0] = True
    return mask, r0, c0


def labelled(mask: np.ndarray, eight: bool = True) -> np.ndarray:
    """Component numbers from 1 in scan order; 0 outside."""
    out = np.zeros(mask.shape, np.int64)
    near = [s for s in square(1) if s != (0, 0) and (eight or 0 in s)]
    n = 0
    for start in zip(*np.nonzero(mask), strict=True):
        if out[start]:
            continue
        n += 1
        out[start], stack = n, [start]
        while stack:
            r, c = stack.pop()
            for a, b in near:
                p = (r + a, c + b)
                if 0 <= p[0] < mask.shape[0] and 0 <= p[1] < mask.shape[1] and mask[p] and not out[p]:
                    out[p] = n
                    stack.append(p)
    return out


def components(cells: DataFrame, least: int = 1, most: int | None = None) -> DataFrame:
    """frame, r, c, part, n: the component of each cell, those with `least` to `most` cells; part is numbered in scan order."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        mask, r0, c0 = dense(rows)
        parts = labelled(mask)
        r, c = np.nonzero(mask)
        part = parts[r, c]
        n = np.bincount(part)[part]
        keep = (n >= least) & (n <= (most or len(part)))
        return pd.DataFrame({"frame": rows["frame"].iloc[0], "r": r[keep] + r0, "c": c[keep] + c0, "part": part[keep], "n": n[keep]})

    return cells.groupBy("frame").applyInPandas(one, "frame long, r int, c int, part long, n long")


def filled_holes(cells: DataFrame, most: int = 400) -> DataFrame:
    """frame, r, c: the cells and every enclosed hole of at most `most` cells."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        mask, r0, c0 = dense(rows, 1)
        holes = labelled(~mask, eight=False)
        sizes = np.bincount(holes.ravel())
        small = (sizes <= most) & (np.arange(len(sizes)) != holes[0, 0])
        small[0] = False
        r, c = np.nonzero(mask | small[holes])
        return pd.DataFrame({"frame": rows["frame"].iloc[0], "r": r + r0, "c": c + c0})

    return cells.groupBy("frame").applyInPandas(one, "frame long, r int, c int")


def connected_to(cells: DataFrame, seed: tuple[int, int], least_share: float = 0.3) -> DataFrame:
    """frame, r, c: the component of the seed cell; if that is under least_share of the frame, the frame as it was."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        mask, r0, c0 = dense(rows)
        parts, at = labelled(mask), (seed[0] - r0, seed[1] - c0)
        own = parts[at] if 0 <= at[0] < mask.shape[0] and 0 <= at[1] < mask.shape[1] else 0
        region = parts == own if own else np.zeros_like(mask)
        r, c = np.nonzero(region if region.sum() >= least_share * mask.sum() else mask)
        return pd.DataFrame({"frame": rows["frame"].iloc[0], "r": r + r0, "c": c + c0})

    return cells.groupBy("frame").applyInPandas(one, "frame long, r int, c int")


def distances(mask: np.ndarray) -> np.ndarray:
    """Exact Euclidean distance of each place to the nearest set one: rows first, then the lower envelope of their parabolas."""
    far = float(sum(mask.shape))
    g = np.full(mask.shape, far)
    for order in (range(mask.shape[0]), range(mask.shape[0] - 1, -1, -1)):
        run = np.full(mask.shape[1], far)
        for r in order:
            run = np.where(mask[r], 0, run + 1)
            g[r] = np.minimum(g[r], run)
    column = np.arange(mask.shape[1])
    apart = (column[:, None] - column[None, :]) ** 2
    return np.sqrt(np.stack([(apart + (row * row)[None, :]).min(1) for row in g]))


def distance_field(cells: DataFrame, margin: int = 5) -> DataFrame:
    """frame, r, c, distance of every place within the frame's extent and margin."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        mask, r0, c0 = dense(rows, margin)
        r, c = np.indices(mask.shape)
        return pd.DataFrame({"frame": rows["frame"].iloc[0], "r": r.ravel() + r0, "c": c.ravel() + c0, "distance": distances(mask).ravel()})

    return cells.groupBy("frame").applyInPandas(one, "frame long, r int, c int, distance double")


def polygon_cells(points: np.ndarray) -> np.ndarray:
    """(r, c) of the cells whose centre lies in a polygon (even-odd rule; a centre on the lower or left edge is in)."""
    lo, hi = np.floor(points.min(0)).astype(int), np.ceil(points.max(0)).astype(int)
    r, c = np.meshgrid(np.arange(lo[0], hi[0] + 1), np.arange(lo[1], hi[1] + 1), indexing="ij")
    y, x = r + 0.5, c + 0.5
    inside = np.zeros(r.shape, bool)
    for (ay, ax), (by, bx) in zip(points, np.roll(points, -1, axis=0), strict=True):
        if ay != by:
            inside ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    return np.stack([r[inside], c[inside]], 1)


def polygon_spans(y: np.ndarray, x: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(polygon, r, first c, last c) of the cells that polygon_cells() gives, run by run, for polygons whose vertices stand one after
    another and end at `ends`. Where a row's middle line crosses the edges, in order, the cells between every other two crossings are inside."""
    starts = np.concatenate([[0], ends[:-1]])
    own = np.repeat(np.arange(len(ends)), ends - starts)
    after = np.arange(1, len(y) + 1)
    after[ends[ends > starts] - 1] = starts[ends > starts]
    edge = np.flatnonzero((y != y[after]) & ~np.isnan(y + x + y[after] + x[after]))  # what lacks a corner crosses nothing
    lo, hi = np.minimum(y[edge], y[after[edge]]), np.maximum(y[edge], y[after[edge]])
    first = np.ceil(lo - 0.5).astype(np.int64) - 1
    n = np.ceil(hi - 0.5).astype(np.int64) + 1 - first
    edge, r = np.repeat(edge, n), np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    crosses = (y[edge] > r + 0.5) != (y[after[edge]] > r + 0.5)
    edge, r = edge[crosses], r[crosses]
    ay, ax, by, bx = y[edge], x[edge], y[after[edge]], x[after[edge]]
    at = (bx - ax) * (r + 0.5 - ay) / (by - ay) + ax
    order = np.lexsort((at, r, own[edge]))
    poly, r, at = own[edge][order], r[order], at[order]
    new = np.concatenate([[True], (poly[1:] != poly[:-1]) | (r[1:] != r[:-1])])[: len(r)]
    place = np.arange(len(r)) - np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))
    left = np.flatnonzero(place[1:] % 2 == 1)
    a, z = np.ceil(at[left] - 0.5).astype(np.int64), np.ceil(at[left + 1] - 0.5).astype(np.int64) - 1
    left, a, z = left[a <= z], a[a <= z], z[a <= z]
    return poly[left], r[left], a, z


#: Cells that a task makes at once, about; a polygon alone may have more.
PAINT = 2_000_000


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of polygons (frame, layer, ys, xs) that come by frame; the last frame waits for the next batch, which may go on with it."""
    held: pa.Table | None = None
    for batch in batches:
        layer = batch.column(1)
        ys, xs = batch.column(2), batch.column(3)
        y, x = (np.asarray(c.flatten().to_numpy(zero_copy_only=False), np.float64) for c in (ys, xs))
        if np.isinf(y).any() or np.isinf(x).any():
            raise ValueError("a polygon goes on for ever")
        ends = np.cumsum(pc.fill_null(pc.list_value_length(ys), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        starts = np.concatenate([[0], ends[:-1]])
        some = np.flatnonzero(ends > starts)
        size = np.zeros(len(ends))
        if len(some):
            y_, x_ = np.nan_to_num(y), np.nan_to_num(x)
            extent = lambda v: np.maximum.reduceat(v, starts[some]) - np.minimum.reduceat(v, starts[some]) + 2
            size[some] = extent(y_) * extent(x_)
        part = (np.cumsum(size) // PAINT).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(ends)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi == lo:
                continue
            v0, v1 = int(starts[lo]), int(ends[hi - 1])
            poly, r, a, z = polygon_spans(y[v0:v1], x[v0:v1], ends[lo:hi] - v0)
            n = z - a + 1
            poly, r = np.repeat(poly, n) + lo, np.repeat(r, n)
            c = np.repeat(a - np.cumsum(n) + n, n) + np.arange(len(r))
            rows = pa.table([batch.column(0).take(pa.array(poly)), pa.array(r, pa.int32()), pa.array(c, pa.int32()), layer.take(pa.array(poly))], names=["frame", "r", "c", "layer"])
            rows = _topmost(rows if held is None else pa.concat_tables([held, rows]))
            if rows.num_rows:
                frame = rows.column(0).combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
                last = int(np.argmax(frame == frame[-1]))
                yield from rows.slice(0, last).combine_chunks().to_batches()
                held = rows.slice(last)
    if held is not None:
        yield from held.combine_chunks().to_batches()


def _topmost(rows: pa.Table) -> pa.Table:
    """Of each cell the row with the largest layer; frames keep their order."""
    if not rows.num_rows:
        return rows
    frame = rows.column("frame").combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
    r, c = (rows.column(k).to_numpy().astype(np.int64) for k in ("r", "c"))
    layer = pc.fill_null(rows.column("layer").cast(pa.int64()), np.iinfo(np.int64).min).to_numpy()
    place = (r << 32) + c
    order = np.lexsort((place, frame))
    frame, place = frame[order], place[order]
    starts = np.flatnonzero(np.concatenate([[True], (frame[1:] != frame[:-1]) | (place[1:] != place[:-1])]))
    top = np.maximum.reduceat(layer[order], starts)
    kept = rows.take(pa.array(order[starts]))
    return kept.set_column(3, rows.schema.field("layer"), pa.array(top, pa.int64(), mask=top == np.iinfo(np.int64).min).cast(rows.schema.field("layer").type))


def _filled(polygons: DataFrame) -> DataFrame:
    kind = {f.name: f.dataType.simpleString() for f in polygons.schema}
    rows = polygons.select("frame", "layer", "ys", "xs").sortWithinPartitions("frame")
    return rows.mapInArrow(_fill, f"frame {kind['frame']}, r int, c int, layer {kind['layer']}")


def filled_shapes(polygons: DataFrame) -> DataFrame:
    """filled_polygons() of polygons that have their vertices in arrays: (frame, layer, ys array<double>, xs array<double>)."""
    return _filled(polygons.repartition("frame"))


def filled_polygons(vertices: DataFrame) -> DataFrame:
    """frame, r, c, layer of vertices (frame, poly, layer, seq, y, x); where layers overlap, the largest wins.

    One shuffle, by frame: a task goes through its frames in batches of many polygons, and holds one frame's cells and a batch's.
    """
    v = vertices.repartition("frame").groupBy("frame", "poly", "layer").agg(F.sort_array(F.collect_list(F.struct("seq", "y", "x"))).alias("v"))
    return _filled(v.select("frame", "layer", F.expr("transform(v, p -> double(p.y))").alias("ys"), F.expr("transform(v, p -> double(p.x))").alias("xs")))


def thinned(mask: np.ndarray) -> np.ndarray:
    """A skeleton by Zhang and Suen's two alternating passes."""
    m = np.pad(mask, 1).astype(np.uint8)
    while True:
        before = m.sum()
        for first in (True, False):
            p = [np.roll(m, (-a, -b), (0, 1)) for a, b in ((-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1))]
            count = sum(x.astype(int) for x in p)
            turns = sum(((x == 0) & (y == 1)).astype(int) for x, y in zip(p, p[1:] + p[:1], strict=True))
            n, e, s, w = p[0], p[2], p[4], p[6]
            open_ = (n * e * s == 0) & (e * s * w == 0) if first else (n * e * w == 0) & (n * s * w == 0)
            m = np.where((m == 1) & (count >= 2) & (count <= 6) & (turns == 1) & open_, 0, m).astype(np.uint8)
        if m.sum() == before:
            return m[1:-1, 1:-1].astype(bool)


def skeleton(cells: DataFrame) -> DataFrame:
    def one(rows: pd.DataFrame) -> pd.DataFrame:
        mask, r0, c0 = dense(rows)
        r, c = np.nonzero(thinned(mask))
        return pd.DataFrame({"frame": rows["frame"].iloc[0], "r": r + r0, "c": c + c0})

    return cells.groupBy("frame").applyInPandas(one, "frame long, r int, c int")


def simplified(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Places of the points that stay: none of the others lies farther than tolerance from the line that replaces it."""
    keep, stack = {0, len(points) - 1}, [(0, len(points) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        d, rel = points[b] - points[a], points[a + 1 : b] - points[a]
        length = np.hypot(*d)
        off = np.abs(d[0] * rel[:, 1] - d[1] * rel[:, 0]) / length if length else np.hypot(rel[:, 0], rel[:, 1])
        k = int(np.argmax(off))
        if off[k] > tolerance:
            keep.add(a + 1 + k)
            stack += [(a, a + 1 + k), (a + 1 + k, b)]
    return np.array(sorted(keep))


def linked(ends: pd.DataFrame, gap: float, angle_deg: float) -> list[tuple[int, int]]:
    """Pairs of line ends (line, x, y, heading outward) joined greedily by falling closeness: each end once, of two lines,
    within gap, and facing each other within angle."""
    e = ends.reset_index(drop=True)
    x, y, h, line = (e[c].to_numpy() for c in ("x", "y", "heading", "line"))
    d = np.hypot(x[:, None] - x[None, :], y[:, None] - y[None, :])
    turn = np.abs((h[:, None] - h[None, :] + 2 * np.pi) % (2 * np.pi) - np.pi)
    i, j = np.nonzero(np.triu((d <= gap) & (line[:, None] != line[None, :]) & (turn <= np.radians(angle_deg)), 1))
    order = np.lexsort((j, i, d[i, j]))
    return greedy(list(zip(i[order].tolist(), j[order].tolist(), strict=True)))


def greedy(pairs: list[tuple]) -> list[tuple]:
    """The pairs, in order, whose ends no earlier chosen pair has."""
    used: set = set()
    out = []
    for a, b in pairs:
        if a not in used and b not in used:
            used |= {a, b}
            out.append((a, b))
    return out


def linked_lines(ends: DataFrame, gap: float, angle_deg: float) -> DataFrame:
    """scene, line_a, side_a, line_b, side_b: the ends (scene, line, side, x, y, heading) of each scene that linked() joins.

    Candidates come from a join on cells of the gap's size; a task gets a scene's candidates, which are as many as its ends have
    neighbours, and never a table of all ends against all.
    """
    near = neighbours(ends, ends, ["scene"], "x", "y", gap).filter("line <> line_b and (line, side) < (line_b, side_b)")
    facing = F.abs(F.pmod(F.col("heading") - F.col("heading_b") + 2 * np.pi, F.lit(2 * np.pi)) - np.pi) <= np.radians(angle_deg)
    pairs = near.filter(facing).select("scene", "line", "side", "line_b", "side_b", "distance")

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["distance", "line", "side", "line_b", "side_b"], kind="stable")
        a, b = (list(zip(rows[f"line{k}"].tolist(), rows[f"side{k}"].tolist(), strict=True)) for k in ("", "_b"))
        out = [(rows["scene"].iloc[0], *p, *q) for p, q in greedy(list(zip(a, b, strict=True)))]
        return pd.DataFrame(out, columns=["scene", "line_a", "side_a", "line_b", "side_b"])

    return pairs.groupBy("scene").applyInPandas(one, "scene long, line_a long, side_a int, line_b long, side_b int")


def smoothed(points: np.ndarray, reach: int = 3) -> np.ndarray:
    """Each point on the parabola that fits its neighbours within reach best, by their places; ends have fewer neighbours."""
    ends = [(min(k, reach), min(len(points) - 1 - k, reach)) for k in range(len(points))]
    return np.array([np.array(parabola_weights(a, b)) @ points[k - a : k + b + 1] for k, (a, b) in enumerate(ends)])


def simplified_lines(points: DataFrame, tolerance: float) -> DataFrame:
    """scene, n, kept, sx, sy of points (scene, n, x, y): whether simplified() keeps a point, and where its neighbours' parabola puts it."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("n", ignore_index=True)
        kept = np.zeros(len(rows), bool)
        kept[simplified(rows[["x", "y"]].to_numpy(float), tolerance)] = True
        return rows[["scene", "n", "sx", "sy"]].assign(kept=kept)

    smooth = parabolas(points.select("scene", F.col("n").cast("long").alias("n"), "x", "y"), ["scene"], ["n"], ["x", "y"])
    return smooth.groupBy("scene").applyInPandas(one, "scene long, n long, sx double, sy double, kept boolean").select("scene", "n", "kept", "sx", "sy")
