"""Parsers for text and binary inputs. Malformed rows are kept with a reason, never dropped silently."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.scalars import finite, first_reason


def label_lines(lines: DataFrame, fields: int, numbers: list[int], sizes: list[int], cls: int, known: list[str]) -> DataFrame:
    """lines(line, raw) with parts, values and reason (null if accepted): field_count, parse, non_finite, size or class, in this order."""
    split = lines.withColumn("parts", F.split("raw", " "))
    values = F.array(*[F.expr(f"try_cast(get(parts, {k}) as double)") for k in numbers])
    rows = split.withColumn("values", values)
    bad_size = F.exists(F.array(*[F.expr(f"try_cast(get(parts, {k}) as double)") for k in sizes]), lambda v: v <= 0)
    reason = first_reason(
        ("field_count", F.size("parts") != fields),
        ("parse", F.exists("values", lambda v: v.isNull())),
        ("non_finite", F.exists("values", lambda v: ~finite(v))),
        ("size", bad_size),
        ("class", ~F.get("parts", F.lit(cls)).isin(known)),
    )
    return rows.withColumn("reason", reason)


def stamped_files(spark: SparkSession, folder: str, pattern: str = r"([^/]+)/(\d+)-(\d+)\.[a-z]+$") -> DataFrame:
    """path, stream, t (ns) of files whose stem is seconds-nanoseconds, from the listing alone."""
    return stamped(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path"), pattern)


def stamped(paths: DataFrame, pattern: str = r"([^/]+)/(\d+)-(\d+)\.[a-z]+$") -> DataFrame:
    """path, stream, t (ns) of those paths whose stem is seconds-nanoseconds."""
    found = paths.filter(F.col("path").rlike(pattern))
    return found.select("path", F.regexp_extract("path", pattern, 1).alias("stream"), (F.regexp_extract("path", pattern, 2).cast("long") * 1_000_000_000 + F.regexp_extract("path", pattern, 3).cast("long")).alias("t"))


def scenes_under(spark: SparkSession, folder: str, marker: str, depth: int = 3) -> DataFrame:
    """scene paths: folders at most `depth` levels down that hold a file named marker."""
    root = folder.rstrip("/")
    return scene_folders(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", marker).load(root).select("path"), root, marker, depth)


def scene_folders(paths: DataFrame, root: str, marker: str, depth: int = 3) -> DataFrame:
    """scene: the folders of paths to a file named marker, at most `depth` levels below root."""
    parent = paths.filter(F.substring_index("path", "/", -1) == marker).select(F.regexp_replace("path", r"/[^/]+$", "").alias("scene"))
    below = F.substring_index("scene", root.rstrip("/"), -1)
    return parent.filter(F.size(F.filter(F.split(below, "/"), lambda p: p != "")) <= depth).distinct()


def log_rows(texts: DataFrame, column: str, schema: str) -> DataFrame:
    """The rows of JSON arrays in a column, with the other columns beside them. What isn't an array (a pickle, say) is an error."""
    kind = f"array<struct<{', '.join(f.replace(' ', ':', 1) for f in schema.split(', '))}>>"
    checked = F.when(F.col(column).rlike(r"^\s*\["), F.col(column)).otherwise(F.raise_error(F.lit("a log has to be a JSON array")))
    others = [c for c in texts.columns if c != column]
    return texts.select(*others, F.inline(F.from_json(checked, kind)))


def telemetry(lines: DataFrame, schema: str) -> DataFrame:
    """The fields of CSV lines (recording, line) that start with seconds and nanoseconds, as t in nanoseconds."""
    rows = lines.select("recording", F.from_csv("line", schema).alias("f")).select("recording", "f.*")
    return rows.withColumn("t", F.col("sec") * 1_000_000_000 + F.col("nsec")).drop("sec", "nsec")


def float_points(files: DataFrame, width: int = 5) -> DataFrame:
    """path, pt, x, y, z of binaryFile rows that hold float32 records of `width` values; a cut-off record is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if len(raw) % (4 * width):
                    raise ValueError(f"{path}: not whole records of {width} floats")
                yield _points(path, np.frombuffer(raw, "<f4").reshape(-1, width)[:, :3])

    return files.select("path", "content").mapInArrow(run, "path string, pt int, x float, y float, z float")


def _points(path: str, xyz: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(xyz)), pa.array(np.arange(len(xyz), dtype=np.int32)), *[pa.array(np.ascontiguousarray(xyz[:, k])) for k in range(3)]], names=["path", "pt", "x", "y", "z"])


# The format's types.
_PCD_TYPES = {("F", 4): "<f4", ("F", 8): "<f8", ("U", 1): "u1", ("U", 2): "<u2", ("U", 4): "<u4", ("I", 1): "i1", ("I", 2): "<i2", ("I", 4): "<i4"}


def pcd_points(raw: bytes) -> np.ndarray:
    """(n, 3) float32 of a binary PCD file; its header names the fields, and a body that is too short is an error."""
    head, body = {}, None
    at = 0
    while body is None:
        end = raw.index(b"\n", at)
        words = raw[at:end].decode("ascii", "replace").split()
        at = end + 1
        if words and not words[0].startswith("#"):
            head[words[0]] = words[1:]
            if words[0] == "DATA":
                if words[1:] != ["binary"]:
                    raise ValueError("only binary PCD data is read")
                body = raw[at:]
    counts = [int(c) for c in head.get("COUNT", ["1"] * len(head["FIELDS"]))]
    record = np.dtype([(name, _PCD_TYPES[kind, int(size)], (count,) if count > 1 else ()) for name, kind, size, count in zip(head["FIELDS"], head["TYPE"], head["SIZE"], counts, strict=True)])
    n = int(head["POINTS"][0])
    if len(body) < n * record.itemsize:
        raise ValueError("PCD data is cut off")
    rows = np.frombuffer(body, record, n)
    return np.stack([rows[k].astype(np.float32) for k in ("x", "y", "z")], 1)


def pcd_files(files: DataFrame) -> DataFrame:
    """path, pt, x, y, z of binaryFile rows that hold binary PCD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield _points(path, pcd_points(raw))

    return files.select("path", "content").mapInArrow(run, "path string, pt int, x float, y float, z float")


def rle_runs(counts: str) -> list[int]:
    """Run lengths of a compressed COCO mask string: six-bit groups, five of value, and differences to the run two before."""
    out: list[int] = []
    at = 0
    while at < len(counts):
        value, shift, more = 0, 0, True
        while more:
            c = ord(counts[at]) - 48
            value |= (c & 31) << shift
            more = bool(c & 32)
            at += 1
            shift += 5
            if not more and c & 16:
                value |= -1 << shift
        out.append(value + out[-2] if len(out) > 2 else value)
    return out


def rle_text(runs: list[int]) -> str:
    """The string that rle_runs() reads."""
    out = []
    for i, n in enumerate(runs):
        left = n - runs[i - 2] if i > 2 else n
        while True:
            low, left = left & 31, left >> 5
            last = left == (-1 if low & 16 else 0)
            out.append(chr(48 + low + (0 if last else 32)))
            if last:
                break
    return "".join(out)


def rle_arrays(counts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """rle_runs() of many strings: the runs of all, one after another, and which string each is of. Null has none."""
    text = pc.fill_null(counts, "").cast(pa.large_string())
    ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.frombuffer(text.buffers()[1], np.int64)[text.offset]
    c = np.frombuffer(text.buffers()[2], np.uint8)[at : at + ends[-1]].astype(np.int64) - 48
    if (c[ends[ends > 0] - 1] & 32).any():
        raise ValueError("a mask's counts are cut off")
    last = np.flatnonzero(c & 32 == 0)
    first = np.concatenate([[0], last[:-1] + 1])
    n = last - first + 1
    value = np.add.reduceat((c & 31) << 5 * (np.arange(len(c)) - np.repeat(first, n)), first)
    value -= np.where(c[last] & 16, np.int64(1) << 5 * n, 0)
    own = np.searchsorted(ends, last, "right")
    k = np.arange(len(own)) - np.searchsorted(own, own)
    chain = own * 3 + np.where(k == 0, 0, 1 + k % 2)  # a run adds to the one two before, from the fourth on
    order = np.argsort(chain, kind="stable")
    total, chain = np.cumsum(value[order]), chain[order]
    start = np.searchsorted(chain, chain)
    runs = np.empty_like(value)
    runs[order] = total - np.where(start > 0, total[start - 1], 0)
    return runs, own


def rle_texts(runs: np.ndarray) -> pa.Array:
    """rle_text() of each row of a table of runs."""
    left = runs.astype(np.int64)
    left[:, 3:] -= runs[:, 1:-2]
    chars, used, live = np.zeros((*runs.shape, 13), np.uint8), np.zeros((*runs.shape, 13), bool), np.ones(runs.shape, bool)
    for k in range(13):
        low, left = left & 31, left >> 5
        more = left != np.where(low & 16, -1, 0)
        chars[..., k], used[..., k] = 48 + low + 32 * more, live
        live = live & more
        if not live.any():
            break
    ends = np.concatenate([[0], np.cumsum(used.sum((1, 2)))]).astype(np.int32)
    return pa.StringArray.from_buffers(len(runs), pa.py_buffer(ends), pa.py_buffer(chars[used]))


def wkb_polygon(blob: bytes) -> list[list[tuple[float, float]]]:
    """Rings of a WKB polygon of either byte order."""
    order = "<" if blob[0] == 1 else ">"
    kind, rings = struct.unpack_from(order + "II", blob, 1)
    if kind != 3:
        raise ValueError(f"WKB type {kind} is no polygon")
    at, out = 9, []
    for _ in range(rings):
        (n,) = struct.unpack_from(order + "I", blob, at)
        flat = struct.unpack_from(f"{order}{2 * n}d", blob, at + 4)
        out.append(list(zip(flat[::2], flat[1::2], strict=True)))
        at += 4 + 16 * n
    return out
