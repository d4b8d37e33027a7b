"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may differ from a passage by k = floor(rate * m) edits. Cut into k + 1 pieces, at least one
piece then occurs unchanged in the passage. One automaton finds all pieces of all items in a text in one pass; each
hit names an item and a place, and Myers' bit-parallel distance settles that place. Items are found wherever they stand, inside longer words
too and whatever their length; whole_words asks for word boundaries at both ends, of items of every length.
Benchmarks are the query set: they go to the tasks in blocks of BLOCK_CHARS characters, each block against all rows. A task, the plans and
the driver hold one block at a time, and a corpus is read once for every block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import drop_table, map_rows, materialize, text_of

RATE, BLOCK_CHARS = 0.05, 4_000_000


def normalized(text: str | None) -> str:
    """Lower-case, each run of white space one space, none at the ends."""
    return " ".join((text or "").lower().split())


def myers(pattern: str, text: str, most: int) -> int | None:
    """Least edit distance of pattern to any substring of text, if at most `most`."""
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    m = len(pattern)
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        x = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | ~(x | up) & full, up & x
        score += bool(plus & last) - bool(minus & last)
        plus, minus = plus << 1 & full, minus << 1 & full
        x = eq | down
        up, down = minus | ~(x | plus) & full, plus & x
        best = min(best, score)
    return best if best <= most else None


def bounded(pattern: str, text: str, lo: int, hi: int, most: int) -> int | None:
    """Least edit distance, if at most `most`, of pattern to a stretch of text[lo:hi] that starts and ends between words."""
    edge = lambda k: k in (0, len(text)) or not (text[k - 1].isalnum() and text[k].isalnum())
    ends = [k for k in range(lo, min(hi, len(text)) + 1) if edge(k)]
    found = [d for a in ends for z in ends if abs(z - a - len(pattern)) <= most and (d := whole_distance(pattern, text[a:z])) <= most]
    return min(found, default=None)


def whole_distance(a: str, b: str) -> int:
    """Edit distance of two short texts."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


class Matcher:
    """Finds the items (item_id, text) of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE, whole_words: bool = False) -> None:
        import ahocorasick

        self.rate, self.whole_words, self.texts = rate, whole_words, {}
        pieces: dict[str, list[tuple[str, int]]] = {}
        for item, raw in items:
            text = normalized(raw)
            if text:
                self.texts.setdefault(text, []).append(item)
        for text in self.texts:
            n = self.budget(text) + 1
            cuts = [len(text) * i // n for i in range(n + 1)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                pieces.setdefault(text[lo:hi], []).append((text, lo))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()
        self.any = bool(pieces)

    def budget(self, text: str) -> int:
        return int(self.rate * len(text))

    def find(self, raw: str | None) -> list[tuple[int, int]]:
        """(item_id, distance) of each item that the text contains within its budget."""
        text = normalized(raw)
        best: dict[str, int] = {}
        tried: set[tuple[str, int]] = set()
        for end, (size, places) in self.automaton.iter(text) if self.any else ():
            for item, lo in places:
                k, start = self.budget(item), end + 1 - size - lo
                if best.get(item) == 0 or (item, start) in tried:
                    continue
                tried.add((item, start))
                near = text[max(0, start - k) : max(0, start + len(item) + k)]
                distance = 0 if item in near else myers(item, near, k)
                if self.whole_words and distance is not None:
                    distance = bounded(item, text, max(0, start - k), max(0, start + len(item) + k), k)
                if distance is not None:
                    best[item] = min(distance, best.get(item, distance))
        return sorted((i, d) for text, d in best.items() for i in self.texts[text])


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The query set, cut into blocks by size, one after another."""
    items = benchmark.select("item_id", text_of().alias("t")).filter("item_id is not null").distinct()
    chars = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    for b in range(n):
        yield [(r[0], r[1]) for r in items.filter(F.pmod(F.xxhash64("item_id", "t"), F.lit(n)) == b).collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, whole_words: bool = False) -> DataFrame:
    """doc_id, item_id, distance of every document and test item that it holds, within rate * the item's length edits.

    Texts are compared in lower case with white space collapsed. Items count wherever they stand, or, with whole_words, between word boundaries
    alone; null or empty items, and items without an id, match nothing. Null and empty texts hold nothing; very long ones are
    searched whole. Of several places of an item the least distance counts. Rows that repeat, or have no doc_id, are reported as often as they
    occur; an empty table on either side gives an empty result. Other columns are not read.
    """
    found = None
    for items in _blocks(benchmark):
        part = map_rows(docs.select("doc_id", text_of()), _leak_rows(items, rate, whole_words), "doc_id long, item_id long, distance int", 512)
        found = part if found is None else found.unionByName(part)  # a task of a union works for one of its parts
    return found if found is not None else docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance int")


def _leak_rows(items: list[tuple[int, str]], rate: float, whole_words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, rate, whole_words)
        for b in batches:
            rows = [(i, *hit) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for hit in matcher.find(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int32()))], names=["doc_id", "item_id", "distance"])

    return run


def drop_leaking(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, whole_words: bool = False) -> DataFrame:
    """docs without the rows that hold a test item; same columns, whatever their names.

    Null and empty texts stay, and so do rows without a doc_id that hold no item; rows that repeat go or stay together; an
    empty table stays empty. Very long texts are searched whole. Each block of the benchmark is a pass of its own over what the passes before
    left, which is written between them, so that no task holds two automata.
    """
    column = docs.columns.index("text")

    def keep(items: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, rate, whole_words)
            for b in batches:
                yield b.filter(pa.array([not matcher.find(t) for t in b.column(column).to_pylist()], pa.bool_()))

        return run

    left, made = docs, None
    for k, items in enumerate(_blocks(benchmark)):
        if k:
            written = materialize(left, "clean")
            if made is not None:
                drop_table(made)
            left = made = written
        left = map_rows(left, keep(items), docs.schema, 512)
    return left
