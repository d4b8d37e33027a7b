"""Token-ID output: best-fit-decreasing packing with a segment tree over capacities, as fixed-width id matrices.

Documents are tokenised where they are read and cut at multiples of the sequence length, so overlong ones lose nothing. Their
pieces, with ids in the narrowest unsigned type that holds the vocabulary, are dealt to groups by a hash of what they are and of how many of
their like came before, piece by piece, so that no id, and no document however long, fills a group. A group is one task's work and one matrix.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import map_rows, text_of
from trackloom.llm.packing import CACHE, dealt

LENGTH, PAD_ID = 4096, 0
GROUP_CHARS = 16 << 20
MATRIX = "sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, doc_starts array<long>"


def id_type(tokenizer: str) -> str:
    from trackloom.llm.tokens import word_tokens

    return "<u2" if len(word_tokens(tokenizer).ends) <= 1 << 16 else "<u4"


class Capacities:
    """Open bins by free room, in a segment tree over 0..limit: each node says whether a bin lies below it, so the tightest
    room that still fits is found in log2(limit) steps. Of equal rooms the bin opened first is taken."""

    def __init__(self, limit: int) -> None:
        self.leaves = 1 << limit.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(limit + 1)]

    def add(self, room: int, which: int) -> None:
        heapq.heappush(self.bins[room], which)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, bin) of the tightest bin with room for need, taken out; None if there is none."""
        node = need + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.count[node]:
                    node += 1
        room = node - self.leaves
        self._change(room, -1)
        return room, heapq.heappop(self.bins[room])


def best_fit_decreasing(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length; ties go to the earlier item."""
    free, opened = Capacities(limit), 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[k])
        room, which = free.take(need) or (limit, opened)
        opened += which == opened
        bins[k], offsets[k] = which, limit - room
        free.add(room - need, which)
    return bins, offsets


def _pieces(docs: DataFrame, tokenizer: str, limit: int, kind: str, cache: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from trackloom.llm.tokens import places, word_tokens

        table, seen = word_tokens(tokenizer, cache), Counter()
        for b in batches:
            cut = [(i, lo, ids[lo : lo + limit].astype(kind).tobytes()) for i, ids in zip(b.column(0).to_pylist(), table.texts(b.column(1)), strict=True) for lo in range(0, len(ids), limit)]
            doc_ids, starts, raw = (list(x) for x in zip(*cut, strict=True))
            place = places(seen, doc_ids, starts, [zlib.crc32(x) for x in raw])
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(raw, pa.binary()), pa.array(place, pa.int64())], names=["doc_id", "start", "ids", "place"])

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), run, "doc_id long, start long, ids binary, place long", 512)


def pack_matrices(docs: DataFrame, tokenizer: str, limit: int = LENGTH, group_chars: int = GROUP_CHARS, seed: int = 17, cache: int = CACHE) -> DataFrame:
    """One row per sequence, a row of its group's id matrix: ids holds exactly `limit` ids, padded with PAD_ID after n_tokens.

    cu_seqlens has the segments' ends after a leading 0 (and limit nowhere unless the row is full); position_resets where positions
    start again from 0, one per segment; doc_ids and doc_starts which document each segment comes from, and where in its ids it starts.
    Every id of every document, with the end id, lies in exactly one segment. Null and empty texts have the end id alone; very long texts are
    cut at multiples of limit; rows that repeat are packed as often; null doc_ids are packed too. Of equally long pieces of a group the one with the
    smaller doc_id (null last), start and ids goes first. Other columns are not read; an empty table gives an empty result.
    """
    kind = id_type(tokenizer)
    width = np.dtype(kind).itemsize
    chars = docs.agg(F.sum(F.length(text_of()))).first()[0] or 0
    groups = max(1, -(-chars // group_chars))

    def pack(part: pa.Table) -> pa.Table:
        group = part.column("group")[0].as_py()
        part = part.append_column("n", pc.divide(pc.cast(pc.binary_length(part.column("ids")), pa.int64()), width))
        part = part.take(pc.sort_indices(part, sort_keys=[("n", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids", "ascending")]))
        sizes, doc_ids, starts, raw = part.column("n").to_numpy(), part.column("doc_id").to_pylist(), part.column("start").to_pylist(), part.column("ids").to_pylist()
        bins, offsets = best_fit_decreasing(sizes, limit)
        order, out = np.lexsort((offsets, bins)), []
        for own in np.split(order, np.flatnonzero(np.diff(bins[order])) + 1):
            ends, at = np.cumsum(sizes[own]), own.tolist()
            ids = b"".join([raw[k] for k in at])
            used = int(ends[-1])
            out.append((group * (1 << 32) + int(bins[own[0]]), used, ids + np.full(limit - used, PAD_ID, kind).tobytes(), [0, *ends.tolist()], (ends - sizes[own]).tolist(), [doc_ids[k] for k in at], [starts[k] for k in at]))
        kinds = {"sequence_id": pa.int64(), "n_tokens": pa.int32(), "ids": pa.binary(), "cu_seqlens": pa.list_(pa.int32()), "position_resets": pa.list_(pa.int32()), "doc_ids": pa.list_(pa.int64()), "doc_starts": pa.list_(pa.int64())}
        return pa.table({name: pa.array(column, t) for (name, t), column in zip(kinds.items(), zip(*out, strict=True), strict=True)})

    return dealt(_pieces(docs, tokenizer, limit, kind, cache), groups, seed).groupBy("group").applyInArrow(pack, MATRIX)


def write_matrices(packed: DataFrame, path: str) -> None:
    """The matrices as a table, rows in the order of their sequence ids within each file."""
    packed.sortWithinPartitions("sequence_id").write.parquet(path)


def positions(resets: list[int], limit: int) -> np.ndarray:
    """Position of each place of a row, from its resets."""
    at = np.zeros(limit, np.int64)
    at[resets] = resets
    return np.arange(limit) - np.maximum.accumulate(at)
