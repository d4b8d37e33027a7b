"""First-fit-decreasing packing over a tournament tree of bin capacities, in randomised groups of documents.

Documents are tokenised where they are read; only their pieces (ids, lengths, checksums; no tokens) are dealt to
groups by a hash of what they are and of how many of their like came before, piece by piece, so that groups are alike in size whatever the sources, however long a
document is, and however many rows share an id or have none. A group is one task's work and holds about GROUP_CHARS characters;
the number of groups grows with the corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import map_rows, text_of

SEQUENCE = 4096
#: A group has some ten thousand pieces then, enough for the last bins not to matter.
GROUP_CHARS = 32 << 20
#: Words that a worker keeps the ids of; a pipeline's workers have less room.
CACHE = 600_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(docs: DataFrame, tokenizer: str, limit: int = SEQUENCE, cache: int = CACHE) -> DataFrame:
    """Each document's pieces, with the place that they are dealt by: its ids cut at multiples of limit. Null texts have the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from trackloom.llm.tokens import places, word_tokens

        table, seen = word_tokens(tokenizer, cache), Counter()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), table.texts(batch.column(1)), strict=True):
                for lo in range(0, len(ids), limit):
                    part = ids[lo : lo + limit]
                    out.append((doc_id, lo, len(part), zlib.crc32(part.astype("<u4").tobytes()), len(ids)))
            columns = list(zip(*out, strict=True))
            columns.append(places(seen, columns[0], columns[1], columns[3]))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place"])

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), run, PIECES + ", place long", 512)


def dealt(pieces: DataFrame, groups: int, seed: int) -> DataFrame:
    """pieces with the group that each goes to. The task's number keeps equal pieces of many tasks apart; it is a task's own whenever it runs."""
    return pieces.withColumn("group", F.pmod(F.xxhash64("place", F.spark_partition_id(), F.lit(seed)), F.lit(groups))).drop("place")


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length. The tree's leaves are bins in order of opening; an inner node has the larger of its children's free room,
    so the first bin with room is found from the root down, in log2(bins) steps. Ties go to the earlier item, then the earlier bin."""
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    room = np.full(2 * leaves, capacity, np.int64).tolist()
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for k in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[k]), 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[k], offsets[k] = node - leaves, capacity - room[node]
        room[node] -= need
        while node > 1:
            node //= 2
            left, right = room[2 * node], room[2 * node + 1]
            new = left if left > right else right
            if room[node] == new:
                break
            room[node] = new
    return bins, offsets


def pack_pieces(pieces: DataFrame, groups: int, limit: int = SEQUENCE, seed: int = 7) -> DataFrame:
    """pieces with sequence_id and offset. Sequence ids are unique over all groups. Ids travel as Arrow integers, so nulls leave the others whole."""

    def pack(part: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        part = part.take(pc.sort_indices(part, sort_keys=order))
        bins, offsets = first_fit_decreasing(part.column("length").to_numpy(), limit)
        sequence = part.column("group").to_numpy() * (1 << 32) + bins
        return part.drop_columns("group").append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offsets))

    return dealt(pieces, groups, seed).groupBy("group").applyInArrow(pack, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, limit: int = SEQUENCE, group_chars: int = GROUP_CHARS, cache: int = CACHE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece of every document.

    A null text is an empty one. Repeated rows are packed as often as they occur; a null doc_id is packed too, and goes last among equals. Very long texts are
    cut at multiples of limit. Of equally long pieces of a group the one with the smaller doc_id, start and checksum goes
    first. Other columns are not read. An empty table gives an empty result.
    """
    chars = docs.agg(F.sum(F.length(text_of()))).first()[0] or 0
    return pack_pieces(token_pieces(docs, tokenizer, limit, cache), max(1, -(-chars // group_chars)), limit)
