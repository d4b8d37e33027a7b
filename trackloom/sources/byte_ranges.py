"""File sources that read no more than they need: the two ends of large files, and text by numbered lines.

Both are Python data sources: a task has some of the files, and opens them itself, so the path has to be one that all executors see (a local or
mounted folder). Register them once a session with register().
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def local_path(path: str) -> str:
    """A path as Python opens it; of schemes only file: is one."""
    plain = path[5:] if path.startswith("file:") else path
    if "://" in plain:
        raise ValueError(f"{path} isn't a mounted folder")
    return "/" + plain.lstrip("/") if path.startswith("file:") else plain


def files_below(path: str, suffix: str = "") -> list[str]:
    """The files of a folder and its folders by name, or the file itself. Hidden ones, which writers leave while they write, don't count."""
    root = local_path(path)
    if os.path.isfile(root):
        return [root]
    if not os.path.isdir(root):
        raise FileNotFoundError(path)
    found = []
    for folder, folders, names in os.walk(root):
        folders[:] = [f for f in folders if f[0] not in "._"]
        found += [os.path.join(folder, n) for n in names if n[0] not in "._" and n.endswith(suffix)]
    return sorted(found)


@dataclass
class Files(InputPartition):
    paths: list[str]


class _FileReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.suffix, self.each = options["path"], options.get("suffix", ""), int(options.get("filesPerTask", "64"))

    def partitions(self) -> list[Files]:
        found = files_below(self.path, self.suffix)
        return [Files(found[k : k + self.each]) for k in range(0, len(found), self.each)]


class FileEnds(DataSource):
    """path, size, head, tail, bytes_read of each file: its first `chunk` bytes, and the last ones of files of more than two chunks.

    Nothing between is read, however large a file is. Options: path, chunk (10 MiB), suffix, filesPerTask.
    """

    @classmethod
    def name(cls) -> str:
        return "file_ends"

    def schema(self) -> str:
        return "path string, size long, head binary, tail binary, bytes_read long"

    def reader(self, schema: object) -> DataSourceReader:
        return _EndsReader(self.options)


class _EndsReader(_FileReader):
    def __init__(self, options: dict[str, str]) -> None:
        super().__init__(options)
        self.chunk = int(options.get("chunk", str(10 << 20)))

    def read(self, partition: Files) -> Iterator[tuple]:
        for path in partition.paths:
            with open(path, "rb", buffering=0) as file:
                size = os.fstat(file.fileno()).st_size
                head, tail = _exactly(file, min(self.chunk, size)), b""
                if size > 2 * self.chunk:
                    file.seek(size - self.chunk)
                    tail = _exactly(file, self.chunk)
            yield path, size, head, tail, len(head) + len(tail)


def _exactly(file, n: int) -> bytes:
    """n bytes, or what there is up to the end; a read may give fewer than it was asked for."""
    parts = []
    while n and (part := file.read(n)):
        parts.append(part)
        n -= len(part)
    return b"".join(parts)


class NumberedLines(DataSource):
    """path, line, text of each line of each text file, counted from 1; what isn't UTF-8 is replaced. Files are read line by line, never whole.
    Options: path, suffix, filesPerTask."""

    @classmethod
    def name(cls) -> str:
        return "numbered_lines"

    def schema(self) -> str:
        return "path string, line long, text string"

    def reader(self, schema: object) -> DataSourceReader:
        return _LinesReader(self.options)


class _LinesReader(_FileReader):
    ROWS = 4096

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            with open(path, encoding="utf-8", errors="replace", newline="\n") as file:
                some: list[str] = []
                at = 0
                for text in file:
                    some.append(text.rstrip("\n").removesuffix("\r"))
                    if len(some) == self.ROWS:
                        yield self._batch(path, at, some)
                        at, some = at + len(some), []
                if some:
                    yield self._batch(path, at, some)

    @staticmethod
    def _batch(path: str, at: int, some: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path] * len(some)), pa.array(range(at + 1, at + len(some) + 1), pa.int64()), pa.array(some)], names=["path", "line", "text"])


def register(spark: SparkSession) -> None:
    for source in (FileEnds, NumberedLines):
        spark.dataSource.register(source)


def write_files(contents: DataFrame, folder: str) -> int:
    """Write each row of contents(name, content binary) as a file of the folder, and return how many there are.

    A file is written aside and renamed, so a task that runs again, or twice, leaves one whole file.
    """
    root = local_path(folder)
    os.makedirs(root, exist_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                handle, aside = tempfile.mkstemp(prefix=".", dir=root)
                with os.fdopen(handle, "wb") as file:
                    file.write(content)
                os.replace(aside, os.path.join(root, name))
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    return sum(r["n"] for r in contents.select("name", "content").mapInArrow(run, "n long").groupBy().sum("n").toDF("n").collect() if r["n"])
