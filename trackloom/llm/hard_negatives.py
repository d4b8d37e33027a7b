"""Hard-negative mining: product quantisation with stored residual norms, and an exact integer rerank of each window.

Vectors are integers. Each part of a vector (PART components) is the nearest of 256 integer codewords plus a residual. The score of an
anchor a with a row is the sum of the row's codewords' table entries, an exact integer, plus a times the residual, which is at most |a| times the
stored residual norm either way. So every row has a rigorous interval for its score, and a row is scored exactly only if its interval
can still reach the window that is asked for:

- positives: the upper end reaches the fifth largest lower end of the anchor's label;
- negatives of a window [lo, hi]: the interval touches the window, and reaches the third largest lower end of those surely in it.

Rows and anchors are dealt to groups of bounded size; each pair of groups is one cogroup, and gives back at most as many rows as are asked for.
The codebook is learnt from a bounded sample; it decides how much is scored exactly, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import Tables, map_rows

SCALE, LARGEST = 256, 1 << 27
#: Components of a part, codewords of a part, rows that the codebook is learnt from, and rounds of its learning.
PART, WORDS, SAMPLE, ROUNDS = 2, 256, 4096, 8
#: Rows and anchors of a group, and anchors whose tables a task holds at once.
GROUP_ROWS, GROUP_ANCHORS, AT_ONCE = 8_192, 4_096, 16
POSITIVES, NEGATIVES = 5, 3


def prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, label, vector (floor(256 * x) of each component): the rows that take part, one for each vec_id.

    Rows without a vec_id, a label or a vector, and those with a null or non-finite component take no part; nor do vectors without components or
    of another length than most have (of equals the longer), and those with a component of 2^27 or more, whose scores fit no long. Of rows that share a
    vec_id the one with the smallest label and vector counts.
    """
    x = F.col("embedding")
    fits = F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double") * SCALE) < LARGEST, F.lit(False)))  # false for infinities; NaN is larger than all
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(x) > 0) & fits)
    rows = rows.select("vec_id", label.alias("label"), F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("int")).alias("vector"))
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    rows = rows.filter(F.size("vector") == (lengths["d"] if lengths else 0))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")).select("vec_id", "r.label", "r.vector")


def learnt_codebook(sample: np.ndarray, part: int = PART, words: int = WORDS, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Integer codewords of each part, by k-means over the sample's rows; parts of the sample that differ in fewer values have fewer."""
    book = []
    for lo in range(0, sample.shape[1], part):
        own = sample[:, lo : lo + part].astype(np.float64)
        start = np.unique(own, axis=0)
        at = start[np.linspace(0, len(start) - 1, min(words, len(start))).astype(int)]
        for _ in range(rounds):
            near = nearest(own, at)
            n = np.bincount(near, minlength=len(at))
            sums = np.stack([np.bincount(near, own[:, j], len(at)) for j in range(own.shape[1])], axis=1)
            at = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], at)
        book.append(np.rint(at).astype(np.int64))
    return book


def nearest(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The nearest codeword of each row, or one as near up to rounding."""
    w = words.astype(np.float64)
    return np.argmin((w * w).sum(axis=1) - 2 * rows.astype(np.float64) @ w.T, axis=1)


def encode(rows: np.ndarray, book: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared residual norm) of each row; the norm is exact for the codes that were chosen."""
    codes, rest, lo = np.empty((len(rows), len(book)), np.uint8), np.zeros(len(rows), np.int64), 0
    for m, words in enumerate(book):
        own = rows[:, lo : lo + words.shape[1]].astype(np.int64)
        codes[:, m] = nearest(own, words)
        rest += ((own - words[codes[:, m]]) ** 2).sum(axis=1)
        lo += words.shape[1]
    return codes, rest


ENCODED = "vec_id long, label long, vector binary, codes binary, rest long"


def encoded(rows: DataFrame, book: list[np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(2).flatten().to_numpy().reshape(b.num_rows, -1)
            codes, rest = encode(x, book)
            raw = [pa.array([r.tobytes() for r in m], pa.binary()) for m in (x.astype("<i4"), codes)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *raw, pa.array(rest)], names=["vec_id", "label", "vector", "codes", "rest"])

    return map_rows(rows.select("vec_id", "label", "vector"), run, ENCODED, 4096)


def unpacked(table: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind).reshape(table.num_rows, -1)


class Block:
    """The rows of a group, sorted by label: what intervals and exact scores are taken from."""

    def __init__(self, table: pa.Table, book: list[np.ndarray]) -> None:
        label = table.column("label").to_numpy()
        order = np.argsort(label, kind="stable")
        self.label, self.ids, self.book = label[order], table.column("vec_id").to_numpy()[order], book
        self.vectors = unpacked(table, "vector", "<i4")[order]
        self.codes = np.ascontiguousarray(unpacked(table, "codes", "u1")[order].T)
        self.norm = np.sqrt(table.column("rest").to_numpy()[order].astype(np.float64))

    def tables(self, anchors: np.ndarray) -> list[np.ndarray]:
        """The table of each part: the product of every anchor with every codeword. Narrow integers where no sum can leave them."""
        most = int(np.abs(anchors).max(initial=0)) * max(int(np.abs(w).max(initial=0)) for w in self.book) * anchors.shape[1]
        out, lo = [], 0
        for words in self.book:
            out.append((anchors[:, lo : lo + words.shape[1]] @ words.T).astype(np.int32 if most < 1 << 31 else np.int64))
            lo += words.shape[1]
        return out

    def looked_up(self, tables: list[np.ndarray], rows: slice) -> np.ndarray:
        """The sum of table entries of each anchor (row) and row of the block (column)."""
        total = np.take(tables[0], self.codes[0, rows], axis=1)
        for part, codes in zip(tables[1:], self.codes[1:, rows], strict=True):
            total += np.take(part, codes, axis=1)
        return total

    def bounds(self, anchor: np.ndarray, rows: slice) -> np.ndarray:
        """At most so far is the exact score from the looked-up one; rounded up."""
        size = np.sqrt(float((anchor.astype(np.float64) ** 2).sum()))
        return np.ceil(size * self.norm[rows] * (1 + 1e-9)).astype(np.int64) + 1

    def exact(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.vectors[rows].astype(np.int64) @ anchor

    def of_label(self, label: int) -> slice:
        return slice(int(np.searchsorted(self.label, label)), int(np.searchsorted(self.label, label, "right")))


def first(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """The n rows of the highest scores, ties by smaller id."""
    return rows[np.lexsort((ids, -scores))[:n]]


def anchors_at_once(table: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The anchors in parts, those of a label together."""
    table = table.sort_by([("label", "ascending"), ("vec_id", "ascending")])
    for lo in range(0, table.num_rows, AT_ONCE):
        part = table.slice(lo, AT_ONCE)
        yield part, unpacked(part, "vector", "<i4").astype(np.int64)


def best_positives(anchors: pa.Table, block: Block, most: int) -> list[tuple]:
    """(anchor_id, other_id, score): the anchors' first `most` rows of the same label in this block."""
    out = []
    for part, vectors in anchors_at_once(anchors):
        labels, tables = part.column("label").to_numpy(), block.tables(vectors)
        for label in np.unique(labels).tolist():
            rows, own = block.of_label(label), np.flatnonzero(labels == label)
            if rows.start == rows.stop:
                continue
            scores = block.looked_up([t[own] for t in tables], rows)
            for k, looked in zip(own.tolist(), scores, strict=True):
                anchor_id, reach = part.column("vec_id")[k].as_py(), block.bounds(vectors[k], rows)
                least, possible = looked - reach, block.ids[rows] != anchor_id
                if (n := int(possible.sum())) > most:
                    possible &= looked + reach >= np.partition(least[possible], n - most)[n - most]
                at = np.flatnonzero(possible) + rows.start
                found = block.exact(vectors[k], at)
                chosen = first(np.arange(len(at)), found, block.ids[at], most)
                out += zip([anchor_id] * len(chosen), block.ids[at[chosen]].tolist(), found[chosen].tolist(), strict=True)
    return out


def in_window(anchor: np.ndarray, looked: np.ndarray, reach: np.ndarray, at: np.ndarray, block: Block, lo: int, hi: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of the first `most` rows with lo <= score <= hi among the rows `at` of the block."""
    least, largest = looked - reach, looked + reach
    touching, inside = (least <= hi) & (largest >= lo), (least >= lo) & (largest <= hi)
    if (n := int(inside.sum())) >= most:
        touching &= largest >= np.partition(least[inside], n - most)[n - most]
    rows = at[touching]
    scores = block.exact(anchor, rows)
    fits = (scores >= lo) & (scores <= hi)
    rows, scores = rows[fits], scores[fits]
    chosen = first(np.arange(len(rows)), scores, block.ids[rows], most)
    return rows[chosen], scores[chosen]


def window_of(positive_score: int) -> tuple[int, int]:
    """The scores s with 50 * positive <= 100 * s <= 95 * positive; empty (lo > hi) below 0."""
    return -(-positive_score // 2), 19 * positive_score // 20


def best_negatives(anchors: pa.Table, block: Block, most: int) -> list[tuple]:
    """(anchor_id, positive_id, positive_score, negative_id, score): for each positive the first `most` rows of other labels in its window."""
    out = []
    for part, vectors in anchors_at_once(anchors):
        tables = block.looked_up(block.tables(vectors), slice(0, len(block.ids)))
        for k, row in enumerate(part.select(["vec_id", "label", "positives"]).to_pylist()):
            windows = [(p["id"], p["score"], *window_of(p["score"])) for p in row["positives"]]
            windows = [w for w in windows if w[2] <= w[3]]
            if not windows:
                continue
            reach = block.bounds(vectors[k], slice(0, len(block.ids)))
            near = (tables[k] + reach >= min(w[2] for w in windows)) & (tables[k] - reach <= max(w[3] for w in windows)) & (block.label != row["label"])
            at = np.flatnonzero(near)
            for positive_id, positive_score, lo, hi in windows:
                rows, scores = in_window(vectors[k], tables[k][at], reach[at], at, block, lo, hi, most)
                out += [(row["vec_id"], positive_id, positive_score, i, s) for i, s in zip(block.ids[rows].tolist(), scores.tolist(), strict=True)]
    return out


def of_groups(anchors: DataFrame, rows: DataFrame, book: list[np.ndarray], search, names: list[str], most: int) -> DataFrame:
    """search(anchors, block, most) of every pair of a group of anchors (column a) and a group of rows (column g)."""
    a_groups, g_groups = anchors.agg(F.max("a")).first()[0], rows.agg(F.max("g")).first()[0]
    if a_groups is None or g_groups is None:
        return rows.sparkSession.createDataFrame([], ", ".join(f"{n} long" for n in names))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = search(left, Block(right, book), most) if left.num_rows and right.num_rows else []
        columns = list(zip(*found, strict=True)) or [()] * len(names)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    left = anchors.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(g_groups))))
    right = rows.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(a_groups))))
    return left.groupBy("a", "g").cogroup(right.groupBy("a", "g")).applyInArrow(run, ", ".join(f"{n} long" for n in names))


def dealt(rows: int, size: int) -> Column:
    """A group by the hash of the id, which is a row's own: as many groups as `rows` rows fill."""
    return F.pmod(F.xxhash64("vec_id", F.lit(31)), F.lit(max(1, -(-rows // size)))).cast("int")


def ranked(found: DataFrame, by: list[str], score: str, other: str, most: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), other))
    return found.withColumn("rank", place).filter(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame,
    every: int = 50,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    sample: int = SAMPLE,
    group_rows: int = GROUP_ROWS,
    group_anchors: int = GROUP_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of vectors(vec_id, embedding, label, ...).

    Anchors are the rows whose vec_id is divisible by `every`. prepared() says which rows take part, and what repeats do. Equal scores go
    by the smaller vec_id, also beyond what is returned. An anchor alone with its label has no positive, and a positive of negative score no window:
    they give no rows. Other columns are not read; an empty table gives an empty result.
    """
    tables = Tables()
    rows = tables.write(prepared(vectors), "vectors")
    some = rows.orderBy(F.xxhash64("vec_id", F.lit(5)), "vec_id").limit(sample).select("vector").toPandas()["vector"]  # `sample` rows at most
    if not len(some):
        return tables.done(rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"), "negatives")
    book = learnt_codebook(np.stack(some.to_list()))
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0)).first()
    coded = tables.write(encoded(rows, book).withColumn("g", dealt(n, group_rows)), "codes")
    anchors = coded.filter(F.col("vec_id") % every == 0).select("vec_id", "label", "vector", dealt(n_anchors, group_anchors).alias("a"))

    near = of_groups(anchors, coded, book, best_positives, ["anchor_id", "positive_id", "positive_score"], positives)
    near = tables.write(ranked(near, ["anchor_id"], "positive_score", "positive_id", positives), "positives")
    asked = near.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    told = anchors.join(asked, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "vector", "a", "positives")
    told = told.toDF(*told.columns)  # names of its own: it is joined with the table that it comes from
    far = of_groups(told, coded, book, best_negatives, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"], negatives)
    out = ranked(far, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return tables.done(out.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score"), "negatives")
