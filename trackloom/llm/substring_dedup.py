"""Substring dedup over a log-structured fingerprint index.

A word goes if a window of `window` consecutive words covers it and the same words also start in a document with a smaller id.

Every window has an anchor: the smallest hash among its GRAM-word grams (the leftmost of equals). Equal windows have equal
anchors at equal places, and neighbouring windows mostly share theirs, so a document has an anchor in about one of 22 words. The
stretch of words under all windows of one anchor is its span. The index holds, for each anchor and span
fingerprint, the smallest document that has it: a class. It is a list of immutable runs, each sorted by anchor.

append() takes a batch: its classes are merge-joined with the runs by anchor, and
- a document whose class also has a smaller document loses all windows of that span;
- where an anchor has several classes, their smallest documents are read again, and every window is verified
  by its own fingerprint against the windows of the other classes.
Then the batch's classes become a new run, and runs are compacted into one when there are too many.
Fingerprints of spans and windows are 128 bits wide: two lanes over independent word hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import Tables, WordHashes, drop_table, flagged, gram_hashes, join_skewed, map_rows, materialize, mix, shared_dir, text_of, word_hashes

WINDOW, GRAM, SEGMENT = 50, 8, 1 << 20
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_SALT = np.uint64(0xA0761D6478BD642F)


class Prints:
    """Fingerprints of any stretch of a word sequence, from prefix sums of a polynomial in an odd base (invertible mod 2**64)."""

    _powers: tuple[list[np.ndarray], list[np.ndarray]] | None = None

    def __init__(self, words: np.ndarray) -> None:
        n = len(words) + 1
        if Prints._powers is None or len(Prints._powers[0][0]) < n:
            size = max(n, 1 << 15)
            inverse = [pow(int(b), -1, 1 << 64) for b in _BASES]
            Prints._powers = tuple([np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size, b, np.uint64))]) for b in bases] for bases in (_BASES, np.array(inverse, np.uint64)))
        self.sums = []
        for lane, (up, values) in enumerate(zip(Prints._powers[0], (words, mix(words ^ _SALT)), strict=True)):
            self.sums.append(np.concatenate([[np.uint64(0)], np.cumsum(values * up[: n - 1], dtype=np.uint64)]))

    def of(self, lo: np.ndarray, hi: np.ndarray, extra: np.ndarray | int = 0) -> list[np.ndarray]:
        """Both lanes of words[lo:hi], with extra mixed in."""
        size = (hi - lo).astype(np.uint64) + (np.asarray(extra).astype(np.uint64) << np.uint64(32))
        return [mix((s[hi] - s[lo]) * down[lo] + size * _SALT).view(np.int64) for s, down in zip(self.sums, Prints._powers[1], strict=True)]


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of each anchor; words has at most SEGMENT + window entries."""
    starts = len(words) - window + 1
    grams = gram_hashes(words, min(GRAM, window))
    width = window - min(GRAM, window) + 1
    low = np.uint64((1 << 24) - 1)
    least, size = (grams & ~low) | np.arange(len(grams), dtype=np.uint64), 1
    while size * 2 <= width:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    least = np.minimum(least[:starts], least[width - size : width - size + starts])
    place = (least & low).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
    return grams[place[first]], place[first], first, np.concatenate([first[1:] - 1, [starts - 1]])


def segments(words: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of a long sequence that share no window and miss none."""
    for at in range(0, len(words) - window + 1, SEGMENT):
        yield at, words[at : at + SEGMENT + window - 1]


def _anchor_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for b in batches:
            parts: list[list[np.ndarray]] = [[np.empty(0, np.int64)] * 6]
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for at, words in segments(word_hashes(text, cache, lower=False), window):
                    g, place, lo, hi = anchors(words, window)
                    one, two = Prints(words).of(lo, hi + window, place - lo)
                    parts.append([g.view(np.int64), one, two, np.full(len(g), doc_id), lo + at, hi + at])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts, strict=True)], names=["g", "h1", "h2", "doc", "lo", "hi"])

    return run


def _window_rows(window: int):
    """Fingerprints of all windows at the wanted anchors of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for b in batches:
            parts: list[list[np.ndarray]] = [[np.empty(0, np.int64)] * 4]
            for doc_id, text, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                for at, words in segments(word_hashes(text, cache, lower=False), window):
                    g, _, lo, hi = anchors(words, window)
                    on = np.isin(g.view(np.int64), np.array(wanted, np.int64))
                    if on.any():
                        starts = np.concatenate([np.arange(a, z + 1) for a, z in zip(lo[on], hi[on], strict=True)])
                        one, two = Prints(words).of(starts, starts + window)
                        parts.append([one, two, np.full(len(starts), doc_id), starts + at])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts, strict=True)], names=["w1", "w2", "doc", "start"])

    return run


def _without(window: int):
    """(doc_id, text, ranges of removed windows) -> (doc_id, n_words, n_removed, kept text's words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, text, ranges in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                kept = words
                if ranges:
                    turn = np.zeros(len(words) + 1, np.int64)
                    np.add.at(turn, [r["lo"] for r in ranges], 1)
                    np.add.at(turn, [r["hi"] + window for r in ranges], -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(turn[:-1]) == 0)]
                out.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["doc_id", "n_words", "n_removed", "kept_text"])

    return run


class FingerprintIndex:
    """Immutable runs of (g, h1, h2, doc, n), bucketed and sorted by anchor, and the documents appended so far.

    A run is a bucketed table, so merging it with the next batch or with other runs shuffles nothing of it. Documents have to
    come in rising order of their ids, because a document loses what a smaller one has; append() raises otherwise. Texts of
    earlier batches are read again only for anchors that have several classes; keeping the fingerprints of all their
    windows instead would take almost three times the texts' room.
    """

    def __init__(self, window: int = WINDOW, most_runs: int = 2, buckets: int = 8) -> None:
        self.window, self.most_runs, self.buckets = window, most_runs, buckets
        self.runs: list[tuple[str, DataFrame]] = []
        self.seen: DataFrame | None = None
        self.last: int | None = None

    def _classes(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("g", "h1", "h2").agg(F.min("doc").alias("doc"), F.sum("n").alias("n"))

    def _write_run(self, classes: DataFrame) -> DataFrame:
        spark, name = classes.sparkSession, f"trackloom_run_{uuid.uuid4().hex}"
        path = f"{shared_dir(spark)}/{name}"
        classes.repartition(self.buckets, "g").write.bucketBy(self.buckets, "g").sortBy("g", "h1", "h2").option("path", path).saveAsTable(name)
        self.runs.append((name, spark.table(name)))
        return self.runs[-1][1]

    def append(self, docs: DataFrame) -> DataFrame:
        """(doc, lo, hi): the ranges of windows that documents of this batch lose. docs(doc_id, text) joins the index."""
        docs = docs.select("doc_id", "text").filter("doc_id is not null")
        first, last = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
        if first is not None and self.last is not None and first <= self.last:
            raise ValueError(f"documents have to come by rising doc_id: {first} after {self.last}")
        self.last = self.last if last is None else last
        self.seen = docs if self.seen is None else self.seen.unionByName(docs)
        tables = Tables()
        rows = tables.write(map_rows(docs, _anchor_rows(self.window), "g long, h1 long, h2 long, doc long, lo long, hi long", 256), "anchors")
        old = [run for _, run in self.runs]
        known = run = self._write_run(self._classes(rows.withColumn("n", F.lit(1).cast("long"))))
        if old:
            mine = run.select("g").distinct()
            for earlier in old:
                known = known.unionByName(earlier.join(mine, "g", "left_semi"))
            known = self._classes(known)
        several = known.groupBy("g").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("g")
        #: Classes of several occurrences, or of anchors that have several classes; all others are unique text.
        classes = known.join(several.withColumn("many", F.lit(True)), "g", "left").filter("n > 1 or many").withColumn("many", F.coalesce("many", F.lit(False)))
        classes = tables.write(classes.select("g", "h1", "h2", F.col("doc").alias("least"), "many", "n"), "shared")
        whole = join_skewed(rows, classes.drop("many"), ["g", "h1", "h2"], rows.count()).filter("least < doc").select("doc", "lo", "hi")
        wanted = classes.filter("many").select(F.col("least").alias("doc"), "g").distinct()
        found = tables.done(whole.unionByName(self._verified(wanted, docs, tables)), "ranges")
        if len(self.runs) > self.most_runs:
            self.compact()
        return found

    def _verified(self, wanted: DataFrame, batch: DataFrame, tables: Tables) -> DataFrame:
        """Windows at the wanted anchors (doc, g) that a smaller document has too; of this batch's documents."""
        per = tables.write(wanted.groupBy("doc").agg(F.collect_set("g").alias("gs")), "wanted")
        texts = flagged(self.seen, per, "doc", "hit", tables).filter("hit").dropDuplicates(["doc_id"])
        windows = tables.write(map_rows(texts.join(per, texts["doc_id"] == per["doc"]).select("doc_id", "text", "gs"), _window_rows(self.window), "w1 long, w2 long, doc long, start long", 256), "windows")
        least = windows.groupBy("w1", "w2").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count(F.lit(1)).alias("n")).filter("least < most").drop("most")
        late = join_skewed(windows, least, ["w1", "w2"], windows.count()).filter("least < doc")
        return late.join(batch.select(F.col("doc_id").alias("doc")), "doc", "left_semi").select("doc", F.col("start").alias("lo"), F.col("start").alias("hi"))

    def compact(self) -> None:
        """One sorted run instead of all; the old ones are removed."""
        old, self.runs = self.runs, []
        rows = old[0][1]
        for _, run in old[1:]:
            rows = rows.unionByName(run)
        self._write_run(self._classes(rows))
        self._drop(old)

    def close(self) -> None:
        """Remove the runs."""
        self._drop(self.runs)
        self.runs = []

    @staticmethod
    def _drop(runs: list[tuple[str, DataFrame]]) -> None:
        for name, run in runs:
            drop_table(run)
            run.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


#: About so many characters of text per bucket of a run, and Spark's default limit of their number.
BUCKET_CHARS, MOST_BUCKETS = 64 << 20, 100_000


def substring_dedup(docs: DataFrame, window: int = WINDOW, batches: int = 3) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text of every row of docs(doc_id, text, ...).

    Words are runs of anything but ASCII white space, unchanged; kept ones are joined by one space. The documents enter the index
    in `batches` batches by id. Null texts have no words; rows that repeat a doc_id are one document and never lose to each other;
    rows without a doc_id lose nothing. Very long texts are cut into segments that share no window and miss none. Other columns are
    not read. An empty table gives an empty result.
    """
    docs = docs.select("doc_id", text_of().alias("text"))
    chars, cuts = docs.agg(F.sum(F.length("text")), F.percentile_approx("doc_id", [k / batches for k in range(1, batches)] or [0.5], 1000)).first()
    index, ranges = FingerprintIndex(window, buckets=min(MOST_BUCKETS, max(8, (chars or 0) // BUCKET_CHARS))), None
    cuts = sorted(set(cuts or [])) if batches > 1 else []
    for lo, hi in zip([None, *cuts], [*cuts, None], strict=True):
        batch = docs.filter((F.col("doc_id") > lo if lo is not None else F.lit(True)) & (F.col("doc_id") <= hi if hi is not None else F.lit(True)))
        found = index.append(batch)
        ranges = found if ranges is None else ranges.unionByName(found)
    index.close()
    per = materialize(ranges.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "ranges-of")
    marked = flagged(docs, per, "doc", "hit", Tables())
    clean = marked.filter("not hit").select("doc_id", "text", F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>").alias("ranges"))
    dirty = marked.filter("hit").join(per, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "text", "ranges")
    return map_rows(clean.unionByName(dirty), _without(window), "doc_id long, n_words long, n_removed long, kept_text string", 256)


def digests(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
