"""Byte-pair encoding and decoding with a contiguous rank array per word.

A text is cut at the vocabulary's special strings, then into words, and every word is encoded for
itself: it starts as its bytes, held as an array of parts beside the array of the ranks of adjacent
parts. The least rank is looked up by a scan, the boundary under it is deleted, the two ranks next to it
are refreshed, until no adjacent pair has a rank. Words of one length go through these steps together, as
rows of one matrix: a step deletes one boundary per row, so the rows that are still open stay equally
long. Words of over ``SHORT`` bytes, for which scans would cost the square of the length, take their merges
from a heap over linked parts instead.

Rows: a NULL text counts as empty and has no ids. NULL, repeated or missing doc_id are kept, one row
out per row in. Empty tables give no rows. Other columns are not read. Texts are worked off in slices of
bounded size; one very long text is a slice of its own. No shuffle, so no key can gather rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import pre_tokenizers

from clinflow.llm.common import pick, slices

#: Longest word, in bytes, that the scans of the rank array take on.
SHORT = 128
#: Remembered words of a Python worker; past it all are forgotten, which bounds memory only.
CACHE_WORDS = 600_000
_NONE = np.int32(np.iinfo(np.int32).max)

# Fixed value: the word pattern of byte-level vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file: printable bytes stand for
    themselves, the others take the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    """Encoder and decoder of a byte-level BPE vocabulary file.

    Refuses files with features that it does not carry out (normalizers, prefix spaces, dropout, special
    strings that take white space along), rather than giving other ids.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        special = spec["added_tokens"]
        if (model["type"] != "BPE" or spec["normalizer"] or pre.get("type") != "ByteLevel"
                or pre.get("add_prefix_space") or not pre.get("use_regex", True)
                or any(model.get(k) for k in (
                    "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback",
                    "ignore_merges"))
                or any(t[k] for t in special for k in ("single_word", "lstrip", "rstrip", "normalized"))):
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        letters = _byte_letters()
        vocabulary = model["vocab"]
        self.special = {t["content"]: t["id"] for t in special}
        self.bytes_of: dict[int, bytes] = {
            i: bytes(letters[c] for c in token) for token, i in vocabulary.items()
            if all(c in letters for c in token)}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        self.text_of = {i: str(i) for i in self.bytes_of}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.size = 1 + max([*vocabulary.values(), *self.special.values()])
        left = np.array([vocabulary[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], dtype=np.int64)
        keys = left * self.size + right
        order = np.argsort(keys)
        #: Sorted pairs with their ranks, and the id that the pair of a rank becomes.
        self.pairs, self.rank = keys[order], order.astype(np.int32)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int32)
        self.of_byte = np.zeros(256, dtype=np.int32)
        for letter, byte in letters.items():
            self.of_byte[byte] = vocabulary[letter]
        both = np.arange(256)
        #: Ranks of pairs of single bytes, the first step of every word.
        self.first = self.ranks(
            np.repeat(self.of_byte[both], 256), np.tile(self.of_byte[both], 256)).reshape(256, 256)
        self.lookup = {int(k): int(r) for k, r in zip(self.pairs, self.rank)}
        self.cut_special = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
        ) if self.special else None
        self.find_words = regex.compile(WORDS).findall
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.words: dict[str, bytes] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, ``_NONE`` for pairs that are never merged."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, keys), self.pairs.size - 1)
        return np.where(self.pairs[at] == keys, self.rank[at], _NONE)

    def merge_together(self, raw: np.ndarray) -> list[np.ndarray]:
        """Ids of words of one length, given as rows of bytes."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(raw)
        parts = self.of_byte[raw]
        ranks = self.first[raw[:, :-1], raw[:, 1:]]
        rows = np.arange(len(raw))
        while rows.size:
            if parts.shape[1] == 1:
                best = np.full(rows.size, _NONE)
                at = np.zeros(rows.size, dtype=np.int64)
            else:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(rows.size), at]
            done = best == _NONE
            if done.any():
                for row, ids in zip(rows[done].tolist(), parts[done]):
                    out[row] = ids
                rows, parts, ranks, at, best = (x[~done] for x in (rows, parts, ranks, at, best))
                if not rows.size:
                    break
            each = np.arange(rows.size)
            parts[each, at] = self.merged[best]
            left = np.ones(parts.shape, dtype=bool)
            left[each, at + 1] = False
            width = parts.shape[1] - 1
            parts = parts[left].reshape(rows.size, width)
            gone = np.ones(ranks.shape, dtype=bool)
            gone[each, at] = False
            ranks = ranks[gone].reshape(rows.size, width - 1)
            has = at > 0
            ranks[each[has], at[has] - 1] = self.ranks(
                parts[each[has], at[has] - 1], parts[each[has], at[has]])
            has = at < width - 1
            ranks[each[has], at[has]] = self.ranks(
                parts[each[has], at[has]], parts[each[has], at[has] + 1])
        return out

    def merge_long(self, raw: bytes) -> np.ndarray:
        """Ids of one long word: the same merges in the same order, from a heap of (rank, place)."""
        parts: list[int | None] = self.of_byte[np.frombuffer(raw, np.uint8)].tolist()
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = lambda i, j: self.lookup.get(parts[i] * self.size + parts[j])
        heap = [(r, i) for i in range(n - 1) if (r := rank(i, i + 1)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or rank(i, j) != r:
                continue
            parts[i], parts[j] = int(self.merged[r]), None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(i, k)) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := rank(h, i)) is not None:
                heapq.heappush(heap, (r, h))
        return np.array([p for p in parts if p is not None], dtype=np.int32)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
        sizes = np.array([len(w) for w in words])
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size).tolist()
            if size > SHORT:
                found: Iterable[np.ndarray] = (self.merge_long(words[i]) for i in at)
            elif size:
                raw = np.frombuffer(b"".join([words[i] for i in at]), np.uint8)
                found = self.merge_together(raw.reshape(-1, size))
            else:
                continue
            for i, ids in zip(at, found):
                out[i] = ids
        return out

    def split(self, text: str) -> list[str]:
        """The words of a text without special strings."""
        if text.isascii() or max(text) < "Ԁ":
            return self.find_words(text)
        # Later letters depend on the Unicode version, and the library's is the one that counts.
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def units(self, text: str) -> list[str]:
        """Parts that can be encoded apart: what stands between two spaces, each with the space before
        it. A space next to other white space may belong to a longer run of it, so texts that have
        such spaces are cut into words at once."""
        if _CLOSE_SPACES(text):
            return self.split(text)
        first, *rest = text.split(" ")
        return [first, *[" " + w for w in rest]] if rest else [first]

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts. Words not seen before are encoded together."""
        cut: list[list[str]] = []
        for text in texts:
            if self.cut_special and any(s in text for s in self.special):
                pieces = self.cut_special.split(text)
                cut.append([u for p in pieces if p
                            for u in ([p] if p in self.special else self.units(p))])
            else:
                cut.append(self.units(text) if text else [])
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        known = self.words
        for token, i in self.special.items():
            known[token] = np.array([i], np.int32).tobytes()
        new = list({u for units in cut for u in units if u not in known})
        words = [self.split(u) for u in new]
        distinct = list({w for ws in words for w in ws})
        ids = dict(zip(distinct, (
            a.tobytes() for a in self.merge([w.encode() for w in distinct]))))
        known.update((u, b"".join([ids[w] for w in ws])) for u, ws in zip(new, words))
        out = [np.frombuffer(b"".join([known[u] for u in units]), np.int32) for units in cut]
        for unit in new:
            if len(unit) > 64:
                del known[unit]
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids; ids that the vocabulary lacks are left out, broken UTF-8 is marked U+FFFD."""
        got = self.bytes_of
        return b"".join([got[i] for i in ids if i in got]).decode("utf-8", "replace")

    def written(self, ids: list[int]) -> bytes:
        """Decimal ids, joined by commas."""
        return ",".join([self.text_of[i] for i in ids]).encode()


_CLOSE_SPACES = re.compile(r"\s (?:\s|$)|\s $|^ (?:\s|$)").search
_loaded: dict[str, Bpe] = {}


def vocabulary(path: str) -> Bpe:
    """One per Python worker and file."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


_TOKENS = "doc_id bigint, ids array<int>"
_DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every text. ``path`` is a vocabulary file that every executor has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for part in slices(batch, 1, 8 << 20):
                found = bpe.encode_batch([t or "" for t in part.column(1).to_pylist()])
                ends = np.cumsum([0, *[a.size for a in found]], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(
                        pa.array(ends), pa.array(np.concatenate(found)))], ["doc_id", "ids"])

    return pick(docs, doc_id="doc_id:bigint", text="text:string").mapInArrow(run, _TOKENS)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of ``encode``'s rows; NULL ids give a NULL text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            texts = [None if ids is None else bpe.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Per text: number of ids, sha256 of the decimal ids joined by commas, and sha256 of the text that
    the ids decode to. Ids stay in the task that made them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for part in slices(batch, 1, 8 << 20):
                rows = []
                for found in bpe.encode_batch([t or "" for t in part.column(1).to_pylist()]):
                    ids = found.tolist()
                    rows.append((
                        len(ids), hashlib.sha256(bpe.written(ids)).hexdigest(),
                        hashlib.sha256(bpe.decode(ids).encode()).hexdigest()))
                counts, written, texts = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(written), pa.array(texts)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return pick(docs, doc_id="doc_id:bigint", text="text:string").mapInArrow(run, _DIGEST)
