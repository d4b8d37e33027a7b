"""GeoPackage layers as a Python data source: SQLite files read by ranges of rows, their geometries as points of rings and lines."""

from __future__ import annotations

import contextlib
import os
import sqlite3
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from trackloom.sources.byte_ranges import files_below, local_path

# Bytes of the envelope by its code, and the kinds of geometries.
ENVELOPES = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}
KINDS = {1: "point", 2: "line", 3: "polygon", 4: "points", 5: "lines", 6: "polygons"}


def wkb_of(blob: bytes) -> bytes:
    """The WKB behind a GeoPackage geometry's header."""
    if len(blob) < 8 or blob[:2] != b"GP":
        raise ValueError("no GeoPackage geometry")
    code = blob[3] >> 1 & 7
    if code not in ENVELOPES:
        raise ValueError(f"envelope {code} is unknown")
    return blob[8 + ENVELOPES[code] :]


def geometry(wkb: bytes) -> tuple[str, list[tuple[int, int, int, float, float]]]:
    """(kind, [(part, ring, n, x, y)]) of a WKB geometry of either byte order; heights and measures are left out. What is cut off raises."""
    out: list[tuple[int, int, int, float, float]] = []

    def head(at: int) -> tuple[str, int, int, int]:
        order = "<" if wkb[at] == 1 else ">"
        (code,) = struct.unpack_from(order + "I", wkb, at + 1)
        return order, code % 1000, 2 + (0, 1, 1, 2)[code // 1000 % 4], at + 5

    def count(order: str, at: int) -> tuple[int, int]:
        return struct.unpack_from(order + "I", wkb, at)[0], at + 4

    def points(order: str, width: int, n: int, at: int, part: int, ring: int) -> int:
        flat = struct.unpack_from(f"{order}{n * width}d", wkb, at)
        out.extend((part, ring, k, flat[k * width], flat[k * width + 1]) for k in range(n))
        return at + 8 * n * width

    def read(at: int, part: int) -> int:
        order, kind, width, at = head(at)
        if kind == 1:
            return points(order, width, 1, at, part, 0)
        if kind not in KINDS:
            raise ValueError(f"WKB type {kind} isn't read")
        n, at = count(order, at)
        if kind == 2:
            return points(order, width, n, at, part, 0)
        for k in range(n):
            if kind == 3:
                size, at = count(order, at)
                at = points(order, width, size, at, part, k)
            else:
                at = read(at, k)
        return at

    try:
        kind = KINDS.get(head(0)[1], "")
        read(0, 0)
    except (struct.error, IndexError) as error:
        raise ValueError("WKB is cut off") from error
    return kind, out


def polygon_blob(rings: list[list[tuple[float, float]]]) -> bytes:
    """A polygon as a GeoPackage geometry without an envelope."""
    body = struct.pack("<BII", 1, 3, len(rings))
    for ring in rings:
        body += struct.pack("<I", len(ring)) + b"".join(struct.pack("<dd", *p) for p in ring)
    return b"GP\x00\x01" + struct.pack("<i", 4326) + body


@dataclass
class Rows(InputPartition):
    path: str
    lo: int
    hi: int


def _open(path: str) -> contextlib.closing:
    return contextlib.closing(sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True))


class GeoPackageLayer(DataSource):
    """path, fid, kind, part, ring, n, x, y of every point of a layer, in all GeoPackages of a folder or in one file.

    A task reads a range of about `rowsPerTask` row numbers of one file, in batches; rows without a geometry have no points. The path has to be one that
    all executors see. Options: path, layer, rowsPerTask (10000).
    """

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def schema(self) -> str:
        return "path string, fid long, kind string, part int, ring int, n int, x double, y double"

    def reader(self, schema: object) -> DataSourceReader:
        return _LayerReader(self.options)


class _LayerReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.layer, self.each = options["path"], options["layer"], int(options.get("rowsPerTask", "10000"))
        if not self.layer.replace("_", "").isalnum():
            raise ValueError(f"{self.layer!r} is no layer's name")

    def partitions(self) -> list[Rows]:
        out = []
        for path in files_below(self.path, ".gpkg"):
            with _open(path) as file:
                lo, hi = file.execute(f'SELECT min(rowid), max(rowid) FROM "{self.layer}"').fetchone()
            if lo is not None:
                out += [Rows(path, k, min(k + self.each - 1, hi)) for k in range(lo, hi + 1, self.each)]
        return out

    def read(self, partition: Rows) -> Iterator[tuple]:
        with _open(partition.path) as file:
            for fid, blob in file.execute(f'SELECT rowid, geom FROM "{self.layer}" WHERE geom IS NOT NULL AND rowid BETWEEN ? AND ?', (partition.lo, partition.hi)):
                kind, points = geometry(wkb_of(blob))
                for p in points:
                    yield partition.path, fid, kind, *p


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GeoPackageLayer)


def write_layers(rows: DataFrame, folder: str, crs: str) -> int:
    """Write rows (file, layer, fid, geom binary) as GeoPackages of a folder, one for each `file`, and return how many there are.

    A file is one task's work; it is written aside and renamed, so a task that runs again leaves one whole file. Null geometries stay null.
    """
    root = local_path(folder)
    os.makedirs(root, exist_ok=True)

    def one(part: pd.DataFrame) -> pd.DataFrame:
        handle, aside = tempfile.mkstemp(prefix=".", dir=root)
        os.close(handle)
        with contextlib.closing(sqlite3.connect(aside)) as file:
            file.execute("CREATE TABLE meta (key TEXT, value TEXT)")
            file.execute("INSERT INTO meta VALUES ('projectedCoordSystem', ?)", (crs,))
            file.execute("CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, srs_id INTEGER)")
            for layer, own in part.groupby("layer"):
                file.execute("INSERT INTO gpkg_contents VALUES (?, 'features', 4326)", (layer,))
                file.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY, geom BLOB)')
                file.executemany(f'INSERT INTO "{layer}" VALUES (?, ?)', [(int(i), g) for i, g in zip(own["fid"], own["geom"], strict=True)])
            file.commit()
        os.replace(aside, os.path.join(root, f"{part['file'].iloc[0]}.gpkg"))
        return pd.DataFrame({"n": [1]})

    return rows.select("file", "layer", "fid", "geom").groupBy("file").applyInPandas(one, "n long").count()
