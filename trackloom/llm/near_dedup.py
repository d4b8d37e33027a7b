"""MinHash near-dedup with odd sketches.

1. Each text becomes its set of word shingles (64-bit hashes), MinHash bands, and an odd sketch: each MinHash sample toggles
   one bit of a bitmap, so the XOR of two bitmaps has about two set bits for each sample that differs, and its
   population count tells high similarities apart precisely.
2. Texts with equal sets are one class from here on; their number costs nothing further.
3. Classes that share a band are candidates; odd sketches verify them. What passes forms candidate components.
4. Inside a candidate component full sets decide, exactly: 100 * |intersection| >= percent * |union|.
5. Components of the confirmed links.

No step emits all pairs of a group. A group of classes (bucket or candidate component) beyond one task's size is cut into
chunks that share a few pivots; what the pivots leave unconnected is then compared against the whole group in blocks,
so nothing is lost (see resolve()).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import Tables, WordHashes, gram_hashes, map_rows, mix, text_of, without, word_hashes
from trackloom.llm.components import components

#: Bands of ROWS samples: a pair of similarity 0.8 shares none with probability (1 - 0.8**ROWS)**BANDS, about 7e-6.
BANDS, ROWS, ODD_BITS = 30, 5, 512
#: An estimate this far under the threshold is over five standard deviations away.
SLACK = 0.18
CHUNK, PIVOTS, BLOCK, CHUNK_SHINGLES = 512, 16, 256, 1_000_000

_RNG = np.random.default_rng(20240607)
_MUL = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_XOR = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)


def shingle_set(text: str | None, n: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of a text's n-word shingles; of its whole word sequence if it has fewer words; empty without words."""
    words = word_hashes(text, cache, lower=True)
    if 0 < len(words) < n:
        return mix(gram_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(gram_hashes(words, n))


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """(set, sample) minima of all sets at once; every set has a member."""
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    low = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), len(_MUL)), np.uint32)
    for i in range(len(_MUL)):
        out[:, i] = np.minimum.reduceat((low ^ _XOR[i]) * _MUL[i], starts)
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """(set, word) uint64 parity bitmaps of (set, sample) MinHash values."""
    which = np.arange(samples.shape[1], dtype=np.uint64) << np.uint64(32)
    bit = mix(samples.astype(np.uint64) | which) % np.uint64(ODD_BITS)
    counts = np.zeros((len(samples), ODD_BITS), np.uint8)
    np.add.at(counts, (np.arange(len(samples))[:, None], bit.astype(np.int64)), 1)
    return np.packbits(counts & 1, axis=1, bitorder="little").view(np.uint64)


def odd_similarity(differing: np.ndarray, samples: int = BANDS * ROWS) -> np.ndarray:
    """Jaccard estimate from the XOR's population count."""
    left = 1 - 2 * np.minimum(differing, ODD_BITS / 2 - 0.5) / ODD_BITS
    return 1 + ODD_BITS / (4 * samples) * np.log(left)


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, fingerprint of the set, band keys, odd sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            at = 0
            while at < len(texts):  # some two hundred thousand shingles at a time
                end, chars = at + 1, len(texts[at])
                while end < len(texts) and chars < 1_000_000:
                    chars += len(texts[end])
                    end += 1
                yield _sketch(ids[at:end], [shingle_set(t, n, cache) for t in texts[at:end]])
                at = end

    return map_rows(docs.select("doc_id", text_of()), run, "doc_id long, n_shingles long, print binary, bands array<long>, odd binary", 512)


def _sketch(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
    import xxhash

    full = [k for k, s in enumerate(sets) if len(s)]
    bands, odd = [None] * len(ids), [None] * len(ids)
    if full:
        samples = minhash([sets[k] for k in full])
        wide = samples.astype(np.uint64).reshape(len(full), BANDS, ROWS)
        keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(full), BANDS)).copy()
        for r in range(ROWS):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, r] + np.uint64(1))
        parity = odd_sketch(samples)
        for row, k in enumerate(full):
            bands[k], odd[k] = keys[row].view(np.int64), parity[row].tobytes()
    prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(odd, pa.binary())], names=["doc_id", "n_shingles", "print", "bands", "odd"])


class _Union:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric boolean matrix, by breadth-first search over its rows."""
    m, out = len(linked), []
    left = np.ones(m, bool)
    for s in range(m):
        if left[s]:
            left[s], queue = False, [s]
            while queue:
                i = queue.pop()
                new = np.flatnonzero(linked[i] & left)
                left[new] = False
                out += [(i, j) for j in new.tolist()]
                queue += new.tolist()
    return out


def _alike(odd: np.ndarray, least: float) -> np.ndarray:
    """(i, j) whether the sketches allow a similarity of least."""
    m = len(odd)
    differing = np.zeros((m, m), np.uint16)
    for w in range(odd.shape[1]):
        differing += np.bitwise_count(odd[:, w][:, None] ^ odd[:, w][None, :])
    return odd_similarity(differing) >= least


def sketch_kernel(percent: int) -> Callable[[list[tuple]], list[tuple[int, int]]]:
    """Candidate verification: a forest of the members whose odd sketches agree."""
    least = percent / 100 - SLACK

    def run(members: list[tuple]) -> list[tuple[int, int]]:
        odd = np.frombuffer(b"".join(m[1] for m in members), np.uint64).reshape(len(members), -1)
        ids = [m[0] for m in members]
        first = odd_similarity(np.bitwise_count(odd ^ odd[0]).sum(1)) >= least
        if first.all():
            return [(i, ids[0]) for i in ids[1:]]
        return [(ids[i], ids[j]) for i, j in _forest(_alike(odd, least))]

    return run


def set_kernel(percent: int, n: int) -> Callable[[list[tuple]], list[tuple[int, int]]]:
    """Confirmation on full sets: a forest of the links among the members."""
    cache, least = WordHashes(), percent / 100 - SLACK

    def run(members: list[tuple]) -> list[tuple[int, int]]:
        may = _alike(np.frombuffer(b"".join(m[1] for m in members), np.uint64).reshape(len(members), -1), least)
        np.fill_diagonal(may, False)
        keep = np.flatnonzero(may.any(1))
        if not len(keep):
            return []
        may, ids = may[np.ix_(keep, keep)], [members[k][0] for k in keep]
        sets = [shingle_set(members[k][2], n, cache) for k in keep]
        size = np.array([len(s) for s in sets])
        shared = _intersections(sets)
        linked = may & (100 * shared >= percent * (size[:, None] + size[None, :] - shared))
        return [(ids[i], ids[j]) for i, j in _forest(linked)]

    return run


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from the members that at least two sets have."""
    m = len(sets)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    several = counts > 1
    column = np.cumsum(several) - 1
    on = several[inverse]
    owner, column = owner[on], column[inverse[on]]
    out = np.zeros((m, m), np.float64)
    width = max(1, 2_000_000 // m)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for lo in range(0, int(several.sum()), width):
        a, b = np.searchsorted(column, [lo, lo + width])
        block = np.zeros((m, min(width, int(several.sum()) - lo)), np.float32)
        block[owner[a:b], column[a:b] - lo] = 1
        out += block @ block.T
    return np.rint(out).astype(np.int64)


def sketch_sieve(percent: int) -> Callable[[list[tuple]], list[int]]:
    """The members whose sketch agrees with another member's."""
    least = percent / 100 - SLACK

    def run(members: list[tuple]) -> list[int]:
        may = _alike(np.frombuffer(b"".join(m[1] for m in members), np.uint64).reshape(len(members), -1), least)
        np.fill_diagonal(may, False)
        return [members[k][0] for k in np.flatnonzero(may.any(1)).tolist()]

    return run


def _groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """((g, c), its (node, payload...) rows, each node once) from rows sorted by (g, c, node), one group at a time."""
    key, members = None, []
    for b in batches:
        keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        rows = list(zip(*(c.to_pylist() for c in b.columns[2:]), strict=True))
        for k, row in zip(keys, rows, strict=True):
            if k != key:
                if len(members) > 1:
                    yield key, members
                key, members = k, []
            if not members or members[-1][0] != row[0]:
                members.append(row)
    if len(members) > 1:
        yield key, members


def _by_group(kernel: Callable[[list[tuple]], list[tuple[int, int]]]):
    """mapInArrow over rows sorted by (g, c, node): the links that kernel finds in each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for _, members in _groups_of(batches):
            out += kernel(members)
            if len(out) > 10_000:
                yield _edges(out)
                out.clear()
        yield _edges(out)

    return run


def _by_block(sieve: Callable[[list[tuple]], list[int]]):
    """mapInArrow over rows sorted by (g, c, node): the (g, c, node) that sieve leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (g, c), members in _groups_of(batches):
            nodes = sieve(members)
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(nodes), pa.int64()), pa.array([c] * len(nodes), pa.int64()), pa.array(nodes, pa.int64())], names=["g", "c", "node"])

    return run


def _edges(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _compared(rows: DataFrame, payload: DataFrame, kernel: Callable) -> DataFrame:
    """Links that kernel finds inside each (g, c) of rows(g, c, node)."""
    full = rows.join(payload, "node").select("g", "c", *payload.columns)
    return map_rows(full.repartition("g", "c").sortWithinPartitions("g", "c", "node"), _by_group(kernel), "a long, b long", 256).distinct()


def resolve(groups: DataFrame, payload: DataFrame, kernel: Callable, name: str, tables: Tables, sieve: tuple[DataFrame, Callable] | None = None) -> DataFrame:
    """Links (a, b) with the same components as all links that kernel accepts between members of a group.

    groups: (g, node, chunks), chunks being the number of tasks that a group needs. payload: (node, ...) that kernel gets.
    A group of one chunk is compared whole. Larger ones are dealt to their chunks by a hash, each chunk with the group's
    PIVOTS pivots. Members that end outside the group's largest component are then compared with all
    of the group, in blocks of BLOCK against CHUNK; those inside it can gain nothing from each other.
    sieve, (payload, kernel) of small rows, names the members of a block that can have a link there at all, so that
    the blocks of large groups copy the large rows of these alone.
    """
    dealt = groups.select("g", "node", F.when(F.col("chunks") == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64("node", "g"), F.col("chunks"))).cast("long").alias("c"), "chunks")
    large = groups.filter("chunks > 1")
    if large.isEmpty():
        return tables.write(_compared(dealt.drop("chunks"), payload, kernel), name)

    def sifted(blocks: DataFrame, step: str) -> DataFrame:
        if sieve is None:
            return blocks
        small, may = sieve
        full = blocks.join(small, "node").select("g", "c", *small.columns)
        return tables.write(map_rows(full.repartition("g", "c").sortWithinPartitions("g", "c", "node"), _by_block(may), "g long, c long, node long", 256), f"{name}-{step}")

    pivots = large.groupBy("g", F.pmod(F.xxhash64("node"), F.lit(PIVOTS)).alias("p")).agg(F.min("node").alias("node"), F.max("chunks").alias("chunks"))
    pivots = pivots.select("g", "node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1)).alias("c"))
    blocks = sifted(dealt.filter("chunks > 1").drop("chunks").unionByName(pivots).distinct(), "blocks")
    links = tables.write(_compared(dealt.filter("chunks = 1").drop("chunks").unionByName(blocks), payload, kernel), name)
    state = large.join(components(links, tables), "node", "left").select("g", "node", F.coalesce("component", "node").alias("part"))
    state = tables.write(state, f"{name}-parts")
    parts = state.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n"))
    whole = parts.groupBy("g").agg(F.max(F.struct("n", "part")).alias("main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    whole = tables.write(whole.select(F.col("g").alias("gg"), F.col("main.part").alias("main"), F.ceil((F.col("n") - F.col("main.n")) / BLOCK).cast("long").alias("few"), F.ceil(F.col("n") / CHUNK).cast("long").alias("all")), f"{name}-open")
    if whole.isEmpty():
        return links
    open_rows = state.join(whole, F.col("g") == F.col("gg")).withColumn("rest", F.col("part") != F.col("main"))
    steps = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    own_few, own_all = F.pmod(F.xxhash64("node"), F.col("few")), F.pmod(F.xxhash64("node", F.lit(5)), F.col("all"))
    mine = open_rows.filter("rest").select("g", "node", (own_few * F.col("all")).alias("base"), F.explode(steps("all")).alias("step")).select("g", "node", (F.col("base") + F.col("step")).alias("c"))
    theirs = open_rows.select("g", "node", "all", own_all.alias("own"), F.explode(steps("few")).alias("step")).select("g", "node", (F.col("step") * F.col("all") + F.col("own")).alias("c"))
    return links.unionByName(tables.write(_compared(sifted(mine.unionByName(theirs).distinct(), "rest-blocks"), payload, kernel), f"{name}-rest"))


def size_band(n_shingles: Column, percent: int) -> Column:
    """Number of a size's band; two sets that reach percent lie in one band or in neighbouring ones."""
    return F.floor(F.log(n_shingles.cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("long")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs(doc_id, text, ...), as a table in the shared folder.

    Words are lower-cased in A-Z. Texts of fewer than n words are one shingle, their whole sequence; null texts and those without
    words have none and are alone. component_id is the smallest doc_id that links reach. Rows that repeat a doc_id share its result;
    a row with a null doc_id has a null component_id and is not kept. Very long texts count whole. Other columns are not read, and an
    empty table gives an empty result.
    """
    tables = Tables()
    sketched = tables.write(sketches(docs, n), "sketches")
    classes = tables.write(sketched.filter("doc_id is not null and print is not null").groupBy("print").agg(F.min("doc_id").alias("node")), "classes")
    found = sketched.select(F.col("doc_id").alias("node"), "n_shingles", "bands", "odd").join(classes.select("node"), "node", "left_semi").dropDuplicates(["node"])
    found = tables.write(found, "representatives")

    keyed = found.select("node", F.explode("bands").alias("g"))
    buckets = keyed.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g", F.ceil(F.col("n") / CHUNK).cast("long").alias("chunks"))
    members = tables.write(keyed.join(buckets, "g"), "buckets")
    candidates = components(resolve(members, found.select("node", "odd"), sketch_kernel(percent), "candidates", tables), tables)

    sized = tables.write(candidates.join(found.select("node", "n_shingles"), "node").select(F.col("component").alias("g"), "node", "n_shingles"), "candidate-sizes")
    counted = lambda df: df.groupBy("g").agg(F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK), F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES)).cast("long").alias("chunks"))
    chunks = tables.write(counted(sized), "candidate-chunks")
    whole = sized.join(chunks.filter("chunks = 1"), "g").select("g", "node", "chunks")
    #: Components beyond one task: only sets of about one size can be alike, so each member joins its own size band and the next.
    wide = sized.join(chunks.filter("chunks > 1").select("g"), "g", "left_semi")
    band = size_band(F.col("n_shingles"), percent)
    wide = wide.select(F.explode(F.array(F.xxhash64("g", band), F.xxhash64("g", band + 1))).alias("g"), "node", "n_shingles")
    groups = tables.write(whole.unionByName(wide.join(counted(wide), "g").select("g", "node", "chunks")), "candidate-groups")
    texts = docs.select(F.col("doc_id").alias("node"), text_of().alias("t")).join(sized.select("node"), "node", "left_semi").dropDuplicates(["node"])
    odd = found.select("node", "odd")
    linked = components(resolve(groups, odd.join(texts, "node"), set_kernel(percent, n), "links", tables, (odd, sketch_sieve(percent))), tables)

    labels = tables.write(classes.join(linked, "node", "left").select(F.col("print").alias("p"), F.coalesce("component", "node").alias("label")), "labels")
    rows = sketched.select("doc_id", "n_shingles", F.coalesce("print", F.col("doc_id").cast("string").cast("binary")).alias("print"))
    rows = rows.join(labels, F.col("print") == F.col("p"), "left")
    #: A null doc_id belongs to no component, whatever its text.
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    rows = rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    return tables.done(rows, "near-duplicates")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """docs with the row of the smallest doc_id of each group of near duplicates; same columns, whatever their names.

    Rows without a doc_id, and texts that are null or have no words, stay. Rows that repeat a doc_id stay or go together. Very
    long texts are compared whole; an empty table stays empty.
    """
    return without(docs, near_duplicates(docs, n, percent).filter("doc_id is not null and not kept"))
