"""Token ids of whole texts with a public word-level BPE file, with every word's ids computed once per worker.

The file's normaliser and splitter never look across ASCII white space, so a text's ids are those of its white-space
separated words, one after another. The strings of special tokens inside a text are those tokens, as the tokenizer
reads them; what lies between them is split into words.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from trackloom.llm.common import Recent

END_ID = 2
_TAILS = b".,;:!?*#$%&()-"


def _values(array: pa.LargeStringArray) -> list[bytes]:
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1].tolist()
    raw = data.to_pybytes() if data else b""
    return [raw[lo:hi] for lo, hi in zip(at[:-1], at[1:], strict=True)]


class WordTokens(Recent):
    """Lower-cased word (bytes) -> its ids as little-endian uint32 bytes."""

    def __init__(self, path: str, words: int = 150_000) -> None:
        super().__init__()
        self.LIMIT = words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # texts() takes special tokens out first, and lower-casing must not make new ones
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.special = {t: np.array([i], np.uint32) for t, i in special.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    @staticmethod
    def _core(word: bytes) -> tuple[bytes, bytes] | None:
        """(letters, punctuation after them) if the word is just that and lower-casing it is plain; else None."""
        core = word.rstrip(_TAILS)
        if core.isalpha():  # ASCII letters alone
            return core, word[len(core) :]
        letters = core.decode("utf-8", "replace")
        if not letters.isalpha():
            return None
        low = letters.lower()
        if "Σ" in letters or not low.isalpha() or not unicodedata.is_normalized("NFC", letters) or not unicodedata.is_normalized("NFC", low):
            return None
        return low.encode(), word[len(core) :]

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of these distinct words; those not seen lately are encoded, the plain ones many at a time."""
        out = list(map(self.get, words))
        todo = [k for k, ids in enumerate(out) if ids is None]
        new: dict[bytes, bytes] = {}
        fresh, old = [], self.old.get
        for k in todo:
            if (ids := old(words[k])) is None:
                fresh.append(k)
            else:
                new[words[k]] = out[k] = ids
        split = [self._core(words[k]) for k in fresh]
        cores = {both[0] for both in split if both}
        parts = {part: self.get(part) or old(part) for part in cores | {both[1] for both in split if both and both[1]}}
        plain = [p for p in cores if parts[p] is None]
        for lo in range(0, len(plain), 4000):
            some = plain[lo : lo + 4000]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, np.uint32)
            cuts = [0, *((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()]
            raw = ids.tobytes()
            if len(cuts) == len(some) + 1:  # one run of letters each
                parts.update((w, raw[cuts[i] : cuts[i + 1]]) for i, w in enumerate(some))
        parts |= {part: self._encode(part.decode()) for part, ids in parts.items() if ids is None}
        for k, both in zip(fresh, split, strict=True):
            out[k] = self._encode(words[k].decode()) if not both else parts[both[0]] + parts[both[1]] if both[1] else parts[both[0]]
            new[words[k]] = out[k]
        self.keep_all(parts | new)
        return out

    def texts(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text with the end id after them, as the tokenizer gives them: the strings of special tokens are those tokens."""
        texts, end = pc.fill_null(texts.cast(pa.large_string()), ""), np.array([END_ID], np.uint32)
        out = self._plain(texts)
        if self.split:
            rows = np.flatnonzero(pc.match_substring_regex(texts, self.split.pattern).to_numpy(zero_copy_only=False))
            for k in rows.tolist():
                parts = self.split.split(texts[k].as_py())
                between = iter(self._plain(pa.array(parts[::2], pa.large_string())))
                out[k] = np.concatenate([self.special[p] if i % 2 else next(between) for i, p in enumerate(parts)])
        return [np.concatenate([ids, end]) for ids in out]

    def _plain(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts that hold no special token. Arrow splits the words and numbers the distinct ones of the batch."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = split.flatten().dictionary_encode()
        ids = self.ids_of(_values(coded.dictionary))
        lens = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(lens) - lens
        flat = np.frombuffer(b"".join(ids), np.uint32)
        at = coded.indices.to_numpy(zero_copy_only=False)
        n = lens[at]
        ends = np.cumsum(n)
        out = flat[np.repeat(starts[at] - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)]
        offsets = split.offsets.to_numpy()
        cuts = np.concatenate([[0], ends])[offsets - offsets[0]]
        return [out[cuts[i] : cuts[i + 1]] for i in range(len(texts))]


_OPEN: dict[tuple[str, int], WordTokens] = {}


def word_tokens(path: str, words: int = 150_000) -> WordTokens:
    """The worker's table for this file, which keeps `words` words in each of two generations; workers live on between tasks."""
    if (path, words) not in _OPEN:
        _OPEN[path, words] = WordTokens(path, words)
    return _OPEN[path, words]


def places(seen: Counter, doc_ids: list[int | None], starts: list[int], checksums: list[int]) -> list[int]:
    """A 64-bit place to deal each piece by: what the piece is, and how many of its like the task has dealt before (seen).

    A task that runs again on the same rows in another order deals the same places, so no piece is lost or doubled; and rows that repeat get
    places of their own, so they don't meet in a group.
    """
    out = []
    for piece in zip(doc_ids, starts, checksums, strict=True):
        key = hash(piece)
        out.append(hash((*piece, seen[key])))
        seen[key] += 1
    return out
