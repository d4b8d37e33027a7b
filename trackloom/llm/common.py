"""What the operators of this subpackage share: tables in the shared folder, text defaults, Arrow helpers."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIR: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir); a temp folder only where none is set and the master is local."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    key = spark.sparkContext.applicationId
    if key not in _OWN_DIR:
        _OWN_DIR[key] = "file://" + tempfile.mkdtemp(prefix="trackloom-")
    return _OWN_DIR[key]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/trackloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove a table that materialize() made and nothing reads any more."""
    spark = df.sparkSession
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Tables:
    """The tables of one call of an operator: write() is materialize(), done() removes them all but its result's."""

    def __init__(self) -> None:
        self.made: list[DataFrame] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.made.append(materialize(df, name))
        return self.made[-1]

    def done(self, result: DataFrame, name: str) -> DataFrame:
        out = materialize(result, name)
        for made in self.made:
            drop_table(made)
        self.made.clear()
        return out


def unused(name: str, df: DataFrame) -> str:
    """name, with underscores before it until no column of df is called so, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


#: About as many bytes of texts a batch of map_rows() has; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20


def cut(batch: pa.RecordBatch, records: int, most_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most so many rows and about so many bytes of strings, with buffers of their own."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    upto, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        room = (upto[at - 1] if at else 0) + most_bytes
        end = min(max(at + 1, int(np.searchsorted(upto, room, "right"))), at + records, batch.num_rows)
        if at == 0 and end == batch.num_rows:
            yield batch
        else:  # take() copies; some kernels misread the offset of a slice
            yield batch.take(pa.array(np.arange(at, end)))
        at = end


def map_rows(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, records: int = 256) -> DataFrame:
    """mapInArrow; rows must hold no more than a batch at once. Spark bounds its batches in bytes; they are cut further here, because single
    texts may be long. Workers live on between tasks, so a task gives back at its end what it has freed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(part for b in batches for part in cut(b, records))
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


_BITS = 1 << 25


def bloom(ids: DataFrame, column: str) -> DataFrame:
    """A one-hash Bloom filter of a long column: (slot, bits), at most 1024 rows of 4 KB whatever the number of ids, so it may be broadcast."""
    return ids.select(_place(F.col(column)).alias("s")).groupBy((F.col("s") / 32768).cast("long").alias("slot")).agg(F.expr("bitmap_construct_agg(s % 32768)").alias("bits"))


def _place(c: Column) -> Column:
    return F.pmod(F.xxhash64(c, F.lit(11)), F.lit(_BITS))


def flagged(docs: DataFrame, ids: DataFrame, column: str, hit: str, tables: Tables) -> DataFrame:
    """docs with a boolean column `hit`: false only where ids(column) surely lacks the row's doc_id, so that most texts need no shuffle."""
    place, slot, bits = unused("__place", docs), unused("__slot", docs), unused("__bits", docs)
    sieve = tables.write(bloom(ids, column), "bloom").select(F.col("slot").alias(slot), F.col("bits").alias(bits))
    marked = docs.withColumn(place, _place(F.col("doc_id"))).withColumn(slot, (F.col(place) / 32768).cast("long")).join(F.broadcast(sieve), slot, "left")
    bit = F.expr(f"shiftright(cast(conv(hex(substring({bits}, cast(({place} % 32768) div 8 as int) + 1, 1)), 16, 10) as int), cast({place} % 8 as int)) & 1")
    return marked.select(*[docs_column(c) for c in docs.columns], F.coalesce(F.col("doc_id").isNotNull() & (bit == 1), F.lit(False)).alias(hit))


def docs_column(name: str) -> Column:
    """A column by its whole name, dots and spaces in it included."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id is in gone(doc_id); rows without an id stay; same columns.

    Only rows that a Bloom filter of the gone ids lets through are shuffled, and most texts are not. The two tables that it reads
    (ids, and the filter) stay in the shared folder, because the result is not computed here.
    """
    key, hit = unused("__gone", docs), unused("__hit", docs)
    gone = materialize(gone.select(F.col("doc_id").alias(key)).filter(F.col(key).isNotNull()).distinct(), "gone")
    marked = flagged(docs, gone, key, hit, Tables())
    columns = [docs_column(c) for c in docs.columns]
    own = marked.filter(hit).select(*columns)
    return marked.filter(~F.col(hit)).select(*columns).unionByName(own.join(gone, F.col("doc_id") == F.col(key), "left_anti"))


#: A key with this share of all rows or more is hot, unless its rows fill no task anyway. There are at most 1 / HOT_SHARE such keys,
#: which bounds their broadcast.
HOT_SHARE, HOT_ROWS, SALTS = 1 / 1000, 100_000, 32


def join_skewed(rows: DataFrame, value: DataFrame, keys: list[str], total: int) -> DataFrame:
    """rows joined with value(*keys, n, ...) on keys, n being how many of `total` rows have the key; n is left out.

    The rows of a hot key are dealt to SALTS parts, and its value goes to each of them, so that no key fills a task.
    """
    limit = max(HOT_ROWS, int(total * HOT_SHARE))
    if total < limit:
        return rows.join(value.drop("n"), keys)
    hot = value.filter(F.col("n") >= limit).select(*keys, F.lit(True).alias("__hot"))
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))).otherwise(0).cast("int"))
    parts = F.when(F.col("n") >= limit, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = value.withColumn("__salt", F.explode(parts)).drop("n")
    return salted.drop("__hot").join(spread, [*keys, "__salt"]).drop("__salt")


class Recent(dict):
    """A cache in two generations of at most LIMIT short keys: when the young one is full it becomes the old one, so what is asked for
    again and again stays, and neither grows beyond that or, if that is more, one batch."""

    LIMIT, LONGEST = 100_000, 48

    def __init__(self) -> None:
        super().__init__()
        self.old: dict = {}

    def keep_all(self, new: dict) -> None:
        if len(self) + len(new) > self.LIMIT:
            self.old = dict(self)
            self.clear()
        self.update((k, v) for k, v in new.items() if len(k) <= self.LONGEST)


class WordHashes(Recent):
    """word (bytes) -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        h = self.old.get(word)
        if h is None:
            import xxhash

            h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= self.LONGEST:
            if len(self) >= self.LIMIT:
                self.keep_all({word: h})
            self[word] = h
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(text: str | None, cache: WordHashes, lower: bool) -> np.ndarray:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of a text, A-Z lower-cased on demand. Null: no words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    parts = (raw.lower() if lower else raw).split()
    return np.fromiter(map(cache.__getitem__, parts), dtype=np.uint64, count=len(parts))


_ODD = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) | 1 for i in range(256)], dtype=np.uint64)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out += words[i : i + m] * _ODD[i]
    return mix(out)
