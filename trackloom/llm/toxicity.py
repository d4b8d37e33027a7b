"""Toxicity: averaged subword embeddings under a linear softmax, both trained jointly in numpy.

A bag is one word's character n-grams (with word-boundary marks) and the word itself. Its embedding is the mean of their
vectors, so a misspelt or inflected word that training never saw shares most vectors with its relatives. A text is
as toxic as its most toxic bag: a mean over a whole text would drown a few words of abuse in a long one. Labels
mark whole texts, so training alternates: pick each toxic text's likeliest bags and the clean texts' most suspicious
ones, fit embeddings and softmax on them, pick again.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import map_rows, mix, text_of

BUCKETS, DIM, SHORTEST, LONGEST, WORD_CHARS = 1 << 16, 8, 3, 6, 40
_ODD = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(WORD_CHARS + 4)], np.uint64)
#: Bound of the training sample: at most so many labelled texts of either class, by a hash of their ids.
SAMPLE = {1: 1500, 0: 3000}
_EDGE = " .,;:!?\"'()[]{}<>*#$%&-_/\\|~`^+=«»“”‘’¿¡…"


class _Spaced(dict):
    """Code point -> itself, or a space for white space and punctuation."""

    def __missing__(self, point: int) -> int:
        self[point] = 32 if unicodedata.category(chr(point))[0] in "PZ" else point
        return self[point]


_SPACED = _Spaced()


def bare(word: str) -> str:
    """A lower-cased word without punctuation at its ends. Empty if it has no letter."""
    word = word.strip(_EDGE)
    return word if any(map(str.isalpha, word)) else ""


def bags_of(run: str) -> Iterator[str]:
    """The words of a lower-cased run between white space, parted at punctuation, each a bag. One of over WORD_CHARS characters is cut into
    windows of WORD_CHARS that overlap by half, so that every character is in a bag; what stands beside a word never changes its bag.
    """
    for part in map(bare, run.translate(_SPACED).split()):
        if part:
            yield from (part[k : k + WORD_CHARS] for k in range(0, max(1, len(part) - WORD_CHARS // 2), WORD_CHARS // 2))


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, how many of them each word has): of all n-grams of every word between its marks, word by word, and of the word itself.

    The hash of a stretch is a sum of its code points by odd factors, so numpy makes those of all words at once.
    """
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    own, place = np.repeat(np.arange(len(words)), sizes), np.arange(len(codes))
    left = np.repeat(ends, sizes) - place
    factors = _ODD[np.minimum(place - np.repeat(ends - sizes, sizes), len(_ODD) - 1)]
    found, owner = [mix(np.add.reduceat(codes * factors, ends - sizes))], [np.arange(len(words))]
    sums = np.zeros(len(codes), np.uint64)
    for n in range(1, LONGEST + 1):
        sums[: len(codes) - n + 1] += codes[n - 1 :] * _ODD[n]
        if n >= SHORTEST:
            at = np.flatnonzero(left >= n)
            found.append(mix(sums[at] + np.uint64(n)))
            owner.append(own[at])
    owner, found = np.concatenate(owner), (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int32)
    return found[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


def misspelt(word: str, rng: np.random.Generator) -> str:
    """word with one random edit: a letter dropped, doubled, swapped with the next, replaced, or put in."""
    if len(word) < 4:
        return word
    i, kind = int(rng.integers(0, len(word) - 1)), int(rng.integers(0, 5))
    other = "abcdefghijklmnopqrstuvwxyz0134"[int(rng.integers(0, 30))]
    middle = ["", word[i] * 2, word[i + 1] + word[i], other, other + word[i]][kind]
    return word[:i] + middle + word[i + 1 + (kind == 2) :]


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


@dataclass
class Model:
    """Logit of a bag = mean of weights[its buckets] * scale + bias; weights are embeddings times the difference of the softmax rows."""

    weights: np.ndarray
    scale: float = 1.0
    bias: float = -4.0

    def bags(self, words: list[str], at_once: int = 20_000) -> np.ndarray:
        """Mean weight of each bag."""
        out = np.empty(len(words))
        for lo in range(0, len(words), at_once):
            buckets, sizes = subwords(words[lo : lo + at_once])
            out[lo : lo + at_once] = np.add.reduceat(self.weights[buckets], np.cumsum(sizes) - sizes, dtype=np.float64) / sizes
        return out

    def runs(self, runs: pa.Array) -> np.ndarray:
        """Of each lower-cased run between white space, its most toxic bag; -inf where it has no letter. A run that is one short word is its own bag."""
        words = pc.utf8_trim(runs, characters=_EDGE)
        out = np.full(len(runs), -np.inf)
        lettered = pc.match_substring_regex(words, r"\p{L}").to_numpy(zero_copy_only=False)
        parted = pc.or_(pc.greater(pc.utf8_length(words), WORD_CHARS), pc.match_substring_regex(words, r"[\p{P}\p{Z}]")).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(~parted & lettered)
        out[at] = self.bags(words.take(pa.array(at)).to_pylist())
        at = np.flatnonzero(parted & lettered)
        bags = [list(bags_of(run)) for run in runs.take(pa.array(at)).to_pylist()]
        sizes = np.fromiter(map(len, bags), np.int64, len(bags))
        at, starts = at[sizes > 0], (np.cumsum(sizes) - sizes)[sizes > 0]
        if len(at):
            out[at] = np.maximum.reduceat(self.bags([w for own in bags for w in own]), starts)
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of each text, from its most toxic bag; texts without words get the bias alone. Each distinct run is looked at once."""
        split = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
        coded = split.flatten().dictionary_encode()
        of_all = np.append(np.append(self.runs(coded.dictionary), -np.inf)[coded.indices.to_numpy(zero_copy_only=False)], -np.inf)
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        best = np.maximum.reduceat(of_all, np.minimum(offsets[:-1], len(of_all) - 1)) if len(texts) else np.empty(0)
        best[offsets[1:] == offsets[:-1]] = -np.inf
        logit = np.where(np.isinf(best), self.bias, best * self.scale + self.bias)
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def train(texts: list[str], labels: np.ndarray, rounds: int = 14, steps: int = 6, rate: float = 0.05, seed: int = 1) -> Model:
    """Fit on whole texts. Without both classes nothing can be learned, and the model calls every text clean.

    Each picked bag is also shown misspelt at random, toxic or not, so that the n-grams carry the weight and not the word.
    """
    labels = np.asarray(labels, np.int64)
    words: dict[str, int] = {}
    docs = [np.unique(np.array([words.setdefault(w, len(words)) for w in {b for r in t.lower().split() for b in bags_of(r)}], np.int64)) for t in texts]
    full = np.array([len(d) > 0 for d in docs], bool)
    if not (labels[full] == 1).any() or not (labels[full] == 0).any():
        return Model(np.zeros(BUCKETS, np.float32))
    names = list(words)
    made = [subwords(names[lo : lo + 20_000]) for lo in range(0, len(names), 20_000)]
    flat, sizes = (np.concatenate(part) for part in zip(*made, strict=True))
    starts = np.cumsum(sizes) - sizes
    y, member = labels[full], [d for d, f in zip(docs, full, strict=True) if f]
    bags = np.concatenate(member)
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in member])])

    def mean_of(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values[flat], starts) / sizes

    # First guess: which n-grams are commoner in toxic texts, by texts that have them.
    has = np.zeros((2, BUCKETS))
    for own, label in zip(member, y, strict=True):
        has[label, np.unique(_gather(flat, starts, sizes, own)[0])] += 1
    odds = np.log((has[1] + 0.5) / ((y == 1).sum() + 1)) - np.log((has[0] + 0.5) / ((y == 0).sum() + 1))
    guess = mean_of(odds * np.sqrt(has[1] + 1))

    rng = np.random.default_rng(seed)
    table, soft = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32), rng.normal(0, 0.1, (2, DIM)).astype(np.float32)
    shift = np.zeros(2, np.float32)
    adam = [[np.zeros_like(x), np.zeros_like(x)] for x in (table, soft, shift)]
    step = 0
    for _ in range(rounds):
        chosen, target = [], []
        for k in range(len(member)):
            own = member[k]
            top = own[np.argsort(-guess[own], kind="stable")[: 2 if y[k] else 4]]
            more = own[rng.integers(0, len(own), 0 if y[k] else 4)]
            chosen += [top, more]
            target += [np.full(len(top) + len(more), y[k])]
        picked, target = np.concatenate(chosen), np.concatenate(target)
        index, first = _gather(flat, starts, sizes, picked)
        count = sizes[picked]
        again = np.concatenate([np.flatnonzero(target == 1), np.flatnonzero(target == 0)[::3]])
        noisy, noisy_count = subwords([misspelt(names[w], rng) for w in picked[again]])
        first = np.concatenate([first, len(index) + np.cumsum(noisy_count) - noisy_count])
        index, count, target = np.concatenate([index, noisy]), np.concatenate([count, noisy_count]), np.concatenate([target, target[again]])
        weight = np.where(target == 1, 0.5 / max(1, (target == 1).sum()), 0.5 / max(1, (target == 0).sum()))
        for _ in range(steps):
            step += 1
            mean = np.add.reduceat(table[index], first) / count[:, None].astype(np.float32)
            logits = mean @ soft.T + shift
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(p)), target] -= 1
            d = (p * weight[:, None]).astype(np.float32)
            spread = np.repeat((d @ soft) / count[:, None].astype(np.float32), count, axis=0)
            grads = [np.stack([np.bincount(index, spread[:, j], BUCKETS) for j in range(DIM)], 1).astype(np.float32), d.T @ mean.astype(np.float32), d.sum(0)]
            for x, g, (m, v) in zip((table, soft, shift), grads, adam, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        guess = mean_of(table @ (soft[1] - soft[0]))
    best = np.maximum.reduceat(guess[bags], bounds[:-1])
    return Model((table @ (soft[1] - soft[0])).astype(np.float32), *_calibrated(best, y))


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = sizes[rows]
    first = np.cumsum(n) - n
    return flat[np.repeat(starts[rows] - first, n) + np.arange(n.sum())], first


def _calibrated(best: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(scale, bias) that put the cut of highest balanced accuracy at probability 1/2, in the middle of its gap."""
    order = np.argsort(best, kind="stable")
    v, t = best[order], y[order]
    rate = np.cumsum(t == 0) / (t == 0).sum() + (1 - np.cumsum(t == 1) / (t == 1).sum())
    k = int(np.argmax(rate))
    cut = (v[k] + v[min(k + 1, len(v) - 1)]) / 2
    scale = 4 / max(float(np.median(best[y == 1]) - cut), 1e-3)
    return scale, -cut * scale


def labelled_sample(docs: DataFrame, labels: DataFrame, bounds: dict[int, int] | None = None) -> tuple[list[str], np.ndarray]:
    """Texts and labels of a bounded sample of the rows outside the held-out fold, alike whatever the corpus's size."""
    marks = labels.select("doc_id", "toxic").dropna().filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = None
    for label, n in (bounds or SAMPLE).items():
        part = marks.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(n)
        ids = part if ids is None else ids.unionByName(part)
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(ids), "doc_id").toPandas().drop_duplicates("doc_id").sort_values("doc_id")
    return rows["text"].tolist(), rows["toxic"].to_numpy()


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    return train(*labelled_sample(docs, labels))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts get the model's prior, below 0.5. Rows that repeat are scored alike; null ids keep their row and
    are not held out; other columns are not read. Very long texts are scored whole: their most toxic bag counts wherever it stands.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return map_rows(docs.select("doc_id", held_out(F.col("doc_id")), text_of()), run, "doc_id long, held_out boolean, score double, predicted int", 512)


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """docs without the rows that the model calls toxic; same columns, whatever their names.

    Null and empty texts stay, and so do rows without a doc_id that aren't toxic. Rows that repeat go or stay together; an empty
    table stays empty. Very long texts are scored whole.
    """
    column = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.score(b.column(column)) < 0.5))

    return map_rows(docs, run, docs.schema, 512)
