"""Benchmark decontamination by latent semantic retrieval.

Documents are seen through the vocabulary of the benchmark: the content terms of its items. A first
pass over the texts keeps, for each document, where which of these terms stand; all later steps
read that table, a small part of the corpus. Passages of ``step`` words are rows of a TF-IDF matrix, whose
leading right singular vectors come from a distributed randomised SVD. Windows as long as the items and
the items are compared by cosine in that space, in every document that holds enough of an item's rarest terms, its
answer, in one place: no other can match. A window above the cosine counts if the longest common subsequence
of its content terms with the item's is long enough and the answer is there.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import pick, row_key, slices, value
from clinflow.operators.storage import materialize

#: A benchmark is a stated set of questions; its vectors are sent to every task. More are refused.
MAX_ITEMS = 50_000
STEP = 16
RANK = 96
ANSWER_TERMS = 5
#: Cosines are taken in tiles of this many windows and items, so their matrix stays below 32 MB.
WINDOWS_AT_ONCE = 8192
ITEMS_AT_ONCE = 1024


def split_words(text: str) -> list[str]:
    """Lower-cased words; ASCII marks separate them like white space."""
    text = text.lower()
    for mark in string.punctuation:
        text = text.replace(mark, " ")
    return text.split()


@dataclass
class Items:
    ids: list[int]
    terms: list[list[int]]  # content terms of each item, in order
    lengths: list[int]  # words of each item
    numbers: dict[str, int]
    content: int  # numbers from here on are words that only items of few content terms are told by
    plain: list[bool]  # told by all words


def read_items(benchmark: DataFrame, common: float = 0.1) -> Items:
    """Items with their content terms: words that at most ``common`` of the items hold, or two.

    An item with fewer content terms than an answer has is told by all its words. Items without
    an id or without words are no questions and never match.
    """
    rows = pick(benchmark, item_id="item_id:bigint", text="text:string").where(
        "item_id is not null and text is not null").limit(MAX_ITEMS + 1).collect()
    if len(rows) > MAX_ITEMS:
        raise ValueError(f"more than {MAX_ITEMS} benchmark items")
    rows = sorted({(r[0], r[1]) for r in rows})
    words = [split_words(t) for _, t in rows]
    df = Counter(w for ws in words for w in set(ws))
    most = max(2.0, common * len(rows))
    numbers = {w: i for i, w in enumerate(sorted(w for w in df if df[w] <= most))}
    content = len(numbers)
    plain = [len({w for w in ws if df[w] <= most}) < ANSWER_TERMS for ws in words]
    for w in sorted({w for ws, p in zip(words, plain) if p for w in ws} - set(numbers)):
        numbers[w] = len(numbers)
    kept = [(r[0], [numbers[w] for w in ws if p or df[w] <= most], len(ws), p)
            for r, ws, p in zip(rows, words, plain) if ws]
    ids, terms, lengths, plain = map(list, zip(*kept)) if kept else ([], [], [], [])
    return Items(ids, terms, lengths, numbers, content, plain)


def term_places(docs: DataFrame, numbers: dict[str, int]) -> DataFrame:
    """(doc_id, n_words, pos, term): the content terms of every whole text, as packed int32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.get
        for batch in batches:
            for part in slices(batch, 1):
                sizes, pos, term = [], [], []
                for text in part.column(1):
                    words = split_words(text.as_py() or "")
                    found = np.fromiter(
                        [number(w, -1) for w in words], dtype=np.int32, count=len(words))
                    at = np.flatnonzero(found >= 0).astype(np.int32)
                    sizes.append(len(words))
                    pos.append(at.tobytes())
                    term.append(found[at].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(pos, pa.binary()),
                     pa.array(term, pa.binary())], ["doc_id", "n_words", "pos", "term"])

    return pick(docs, doc_id="doc_id:bigint", text="text:string").mapInArrow(
        run, "doc_id bigint, n_words bigint, pos binary, term binary")


def _passages(part: pa.RecordBatch, n_terms: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all term places of a batch: row, passage number counted over the batch (a free number
    after each row's last), position, term; only terms below ``n_terms`` if that is given."""
    sizes = np.asarray(part.column(1))
    pos = [np.frombuffer(x.as_py(), np.int32) for x in part.column(2)]
    row = np.repeat(np.arange(part.num_rows), [p.size for p in pos])
    pos = np.concatenate(pos) if pos else np.zeros(0, np.int32)
    term = np.frombuffer(b"".join(x.as_py() for x in part.column(3)), np.int32)
    if n_terms is not None and term.size and term.max() >= n_terms:
        row, pos, term = row[term < n_terms], pos[term < n_terms], term[term < n_terms]
    base = np.concatenate([[0], np.cumsum(sizes // STEP + 2)])
    return row, base[row] + pos // STEP, pos, term


def _weights(passage: np.ndarray, term: np.ndarray, n_terms: int) -> tuple[np.ndarray, ...]:
    """(passage, term, count) of each distinct pair, sorted by passage."""
    pair, count = np.unique(passage.astype(np.int64) * n_terms + term, return_counts=True)
    return pair // n_terms, pair % n_terms, count


def document_frequencies(places: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """Passages that hold each term, and the number of passages, over the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(n_terms, dtype=np.int64), 0
        for batch in batches:
            _, passage, _, term = _passages(batch)
            df += np.bincount(_weights(passage, term, n_terms)[1], minlength=n_terms)
            n += int((-(-np.asarray(batch.column(1)) // STEP)).sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, n_terms)), pa.array(np.append(df[some], n))], ["t", "n"])

    rows = places.mapInArrow(run, "t bigint, n bigint").groupBy("t").agg(F.sum("n")).collect()
    out = np.zeros(n_terms + 1)
    for t, n in rows:
        out[t] = n
    return out[:-1], int(out[-1])


def _tfidf(passage: np.ndarray, term: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first index of each passage's run, term, weight) with unit passages."""
    passage, term, count = _weights(passage, term, idf.size)
    weight = (1 + np.log(count)) * idf[term]
    starts = np.flatnonzero(np.diff(passage, prepend=-1))
    norm = np.sqrt(np.add.reduceat(weight * weight, starts)) if starts.size else weight
    sizes = np.diff(np.append(starts, passage.size))
    return starts, sizes, term, (weight / np.repeat(np.maximum(norm, 1e-9), sizes)).astype(np.float32)


def latent_terms(places: DataFrame, idf: np.ndarray, rank: int, seed: int = 4) -> np.ndarray:
    """Terms x rank: right singular vectors of the TF-IDF passages, by a one-pass randomised SVD.

    With A the unit passages and W random, the corpus gives Y = A'(AW); tasks add up their share
    and send it once, and the sum over tasks is a combined aggregation by term. Y and W determine a
    Nystroem approximation of A'A, whose eigenvectors these are.
    """
    n, over = idf.size, min(idf.size, rank + 16)
    w = np.random.default_rng(seed).standard_normal((n, over)).astype(np.float32)
    w = np.linalg.qr(w)[0].astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y = np.zeros((n, over), dtype=np.float32)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                _, passage, _, term = _passages(batch.slice(at, 256), n)
                starts, sizes, term, weight = _tfidf(passage, term, idf)
                if not starts.size:
                    continue
                aw = np.add.reduceat(w[term] * weight[:, None], starts, axis=0)
                share = np.repeat(aw, sizes, axis=0) * weight[:, None]
                order = np.argsort(term, kind="stable")
                firsts = np.flatnonzero(np.diff(term[order], prepend=-1))
                y[term[order][firsts]] += np.add.reduceat(share[order], firsts, axis=0)
        some = np.flatnonzero(np.abs(y).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.FixedSizeListArray.from_arrays(
                pa.array(y[some].ravel()), over).cast(pa.list_(pa.float32()))], ["t", "v"])

    rows = places.mapInArrow(run, "t bigint, v array<float>").groupBy("t").agg(
        F.array(*[F.sum(F.col("v")[i]) for i in range(over)]).alias("v")).collect()
    y = np.zeros((n, over))
    for t, v in rows:
        y[t] = v
    shift = 1e-6 * max(1e-9, float(np.linalg.norm(y)))
    y = y + shift * w
    middle = w.T.astype(np.float64) @ y
    vals, vecs = np.linalg.eigh((middle + middle.T) / 2)
    keep = vals > 1e-12
    root = vecs[:, keep] / np.sqrt(vals[keep])
    u = np.linalg.svd(y @ root, full_matrices=False)[0]
    return u[:, :rank].astype(np.float32)


def common_length(masks: dict[int, int], sequence: list[int]) -> int:
    """Length of the longest common subsequence, 64 and more steps at once: a bit of the row for
    each element of the item, ``masks`` has the places of each term in it."""
    row = 0
    for t in sequence:
        x = row | masks.get(t, 0)
        row = x & ~(x - ((row << 1) | 1))
    return row.bit_count()


def windows(near: np.ndarray, number: np.ndarray, row: np.ndarray, length: int) -> np.ndarray:
    """Unit sums of the passages from each on that are in the ``length`` passages of its window."""
    last = len(near) - 1
    out = near.copy()
    for k in range(1, min(length, last + 1)):
        at = np.minimum(np.arange(len(near)) + k, last)
        inside = (number[at] < number + length) & (row[at] == row) & (at >= np.arange(len(near)) + k)
        if not inside.any():
            break
        out[inside] += near[at[inside]]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def window_length(words: int) -> int:
    """Passages of the window for an item: two at least, else its own length, rounded up to one of few."""
    length = 2
    while length * STEP < words:
        length = length * 3 // 2 if length & (length - 1) == 0 else length // 3 * 4
    return length


@dataclass
class Index:
    items: Items
    idf: np.ndarray
    terms: np.ndarray  # terms x rank, weighted by idf
    vectors: np.ndarray  # items x rank, of unit length, or zero
    answers: list[set[int]]
    pairs: np.ndarray  # item * terms + term, sorted
    told: np.ndarray  # (term, item) of the answers, sorted by term

    @cached_property
    def bare(self) -> np.ndarray:
        """Items without a vector: latent space cannot hold them."""
        return ~self.vectors.any(axis=1)

    def needed(self, answer: float) -> np.ndarray:
        """Answer terms that the share ``answer`` takes, for each item."""
        sizes = np.array([len(a) for a in self.answers])
        return np.maximum(1, np.ceil(answer * sizes - 1e-9).astype(np.int64))

    def holds(self, item: np.ndarray, term: np.ndarray) -> np.ndarray:
        key = item.astype(np.int64) * self.idf.size + term
        at = np.searchsorted(self.pairs, key)
        return self.pairs[np.minimum(at, self.pairs.size - 1)] == key

    def overlaps(self, row: np.ndarray, pos: np.ndarray, term: np.ndarray,
                 answer: float) -> tuple[np.ndarray, np.ndarray]:
        """(index into the terms, item) wherever enough answer terms of an item stand together that
        some place of the item's reach can hold the share ``answer`` of them."""
        first = np.searchsorted(self.told[:, 0], term)
        n = np.searchsorted(self.told[:, 0], term, "right") - first
        at = np.repeat(np.arange(term.size), n)
        item = self.told[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum()), 1]
        order = np.lexsort((at, item, row[at]))
        at, item = at[order], item[order]
        need = self.needed(answer)[item]
        last = np.arange(at.size) + need - 1
        inside = last < at.size
        other = np.where(inside, last, 0)
        length = np.array(self.items.lengths)[item]
        reach = np.array([window_length(x) for x in self.items.lengths])[item] * STEP + 2 * length
        inside &= (item[other] == item) & (row[at[other]] == row[at])
        inside &= pos[at[other]] - pos[at] <= reach
        # All the terms of such a group, not only the first.
        step = np.zeros(at.size + 1, dtype=np.int64)
        np.add.at(step, np.flatnonzero(inside), 1)
        np.add.at(step, last[inside] + 1, -1)
        some = np.cumsum(step[:-1]) > 0
        return at[some], item[some]

    def compare(self, item: int, pos: np.ndarray, found: np.ndarray, common: float,
                answer: float) -> tuple[float, float] | None:
        """The largest (common share, answer share) of the place that reaches both."""
        own = self.items.terms[item]
        masks: dict[int, int] = {}
        for j, t in enumerate(own):
            masks[t] = masks.get(t, 0) | 1 << j
        parts = [found]
        if self.items.plain[item]:  # common words are everywhere: only as many words as the item has
            starts = [k for k, t in enumerate(found.tolist()) if t in masks]
            ends = np.searchsorted(pos, pos[starts] + self.items.lengths[item])
            parts = [found[a:b] for a, b in zip(starts, ends)]
        best = None
        for part in parts:
            part = part.tolist()
            share = common_length(masks, part) / len(own)
            told = len(self.answers[item] & set(part)) / len(self.answers[item])
            if share >= common and told >= answer:
                best = max(best or (0.0, 0.0), (share, told))
        return best

    def search(self, part: pa.RecordBatch, cosine: float, common: float, answer: float,
               seen: list[int]) -> list[tuple]:
        """(row of the batch, item_id, cosine, common share, answer share) of the best window for
        each item and row; counts candidates in ``seen``.

        A match needs the item's answer terms in one place, so rows and items without such a place
        are out before any cosine is taken; of all other windows the cosine decides. Items without a vector
        are compared wherever their answer terms stand together.
        """
        row, passage, pos, term = _passages(part)
        told_at, told_item = self.overlaps(row, pos, term, answer)
        if not told_at.size:
            return []
        keep = np.isin(row, np.unique(row[told_at]))
        told_at = np.cumsum(keep)[told_at] - 1
        row, passage, pos, term = row[keep], passage[keep], pos[keep], term[keep]
        starts = np.flatnonzero(np.diff(passage, prepend=-1))
        near = np.add.reduceat(self.terms[term], starts, axis=0)
        number, at_row = passage[starts], row[starts]
        best: dict[tuple[int, int], tuple] = {}
        lengths, sizes = np.array(self.items.lengths), np.array([len(t) for t in self.items.terms])
        need = self.needed(answer)
        passages = np.array([window_length(n) for n in self.items.lengths])
        far = int(pos.max()) + 2 * int(lengths.max()) + 2 * STEP * (int(passages.max()) + 2)
        place = row.astype(np.int64) * far + pos
        width = (int(row.max()) + 2) * far
        told = np.sort(told_item * width + place[told_at])
        window_of = np.searchsorted(starts, told_at, "right") - 1
        for size in np.unique(passages[told_item]):
            window = windows(near, number, at_row, int(size))
            middle = at_row * far + pos[starts] // STEP * STEP + size * STEP // 2
            some = np.unique(told_item[passages[told_item] == size])
            bare = self.bare[told_item] & (passages[told_item] == size)
            pairs = [np.unique(window_of[bare] * lengths.size + told_item[bare])]
            some = some[~self.bare[some]]
            for left in range(0, some.size, ITEMS_AT_ONCE):
                items = some[left:left + ITEMS_AT_ONCE]
                mine = np.isin(told_item, items)
                open_ = np.zeros((part.num_rows, items.size), dtype=bool)
                open_[row[told_at[mine]], np.searchsorted(items, told_item[mine])] = True
                for lo in range(0, len(window), WINDOWS_AT_ONCE):
                    cut = slice(lo, lo + WINDOWS_AT_ONCE)
                    like = window[cut] @ self.vectors[items].T
                    w, i = np.nonzero((like >= cosine) & open_[at_row[cut]])
                    pairs.append((w + lo) * lengths.size + items[i])
            pair = np.concatenate(pairs)
            w, i = pair // lengths.size, pair % lengths.size
            # The item may begin before and end after the window, by its own length.
            reach = lengths[i] + size * STEP // 2
            low = np.maximum(middle[w] - reach, at_row[w] * far)
            high = middle[w] + reach
            answers = np.searchsorted(told, i * width + high) - np.searchsorted(told, i * width + low)
            some = answers >= need[i]
            w, i, low, high = w[some], i[some], low[some], high[some]
            seen[0] += w.size
            first, last = np.searchsorted(place, low), np.searchsorted(place, high)
            # No common subsequence is longer than the number of the item's terms in the place.
            for at in range(0, w.size, 16_384):
                cut = slice(at, at + 16_384)
                n = last[cut] - first[cut]
                where = np.repeat(first[cut] - np.cumsum(n) + n, n) + np.arange(n.sum())
                own = self.holds(np.repeat(i[cut], n), term[where])
                total = np.add.reduceat(own, np.cumsum(n) - n, dtype=np.int64)
                for k in np.flatnonzero(total >= common * sizes[i[cut]]) + at:
                    r, item = int(at_row[w[k]]), int(i[k])
                    span = slice(first[k], last[k])
                    shares = self.compare(item, pos[span], term[span], common, answer)
                    if shares:
                        hit = (*shares, float(window[w[k]] @ self.vectors[item]))
                        if hit > best.get((r, item), (0,)):
                            best[r, item] = hit
        return [(r, self.items.ids[i], h[2], h[0], h[1]) for (r, i), h in sorted(best.items())]


def build(places: DataFrame, items: Items, rank: int = RANK, answer_terms: int = ANSWER_TERMS) -> Index:
    n = len(items.numbers)
    df, passages = document_frequencies(places, n)
    idf = np.log((1 + passages) / (1 + df)) + 0.1
    v = np.zeros((n, 1), dtype=np.float32)
    if items.content:
        own = idf[:items.content]
        latent = latent_terms(places, own, min(rank, items.content)) * own[:, None].astype(np.float32)
        v = np.concatenate([latent, np.zeros((n - items.content, latent.shape[1]), np.float32)])
    vectors = np.stack([v[ts].sum(axis=0) * (not p) for ts, p in zip(items.terms, items.plain)])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    answers = [set(sorted(set(ts), key=lambda t: (-idf[t], t))[:answer_terms]) for ts in items.terms]
    pairs = np.unique([i * n + t for i, ts in enumerate(items.terms) for t in ts])
    told = np.array(sorted((t, i) for i, a in enumerate(answers) for t in a))
    return Index(items, idf, v, vectors, answers, pairs, told)


MATCH = "doc_id bigint, item_id bigint, cosine double, common double, answer double"


def matches(
    docs: DataFrame, benchmark: DataFrame, cosine: float = 0.2, common: float = 0.6,
    answer: float = 0.6, rank: int = RANK,
) -> DataFrame:
    """(doc_id, item_id, cosine, common, answer): documents that hold an item or a paraphrase of it.

    ``common`` is the least share of the item's content terms in the longest common subsequence,
    ``answer`` the least share of its five rarest terms that the place must hold. All items are
    looked for in all windows of all documents that hold the answer; ``cosine`` opens a window. Items that
    latent space cannot hold, told by all their words, have cosine 0, are opened by their answer
    and must be found within their own length. NULL and empty texts, an empty benchmark or an empty
    table give no rows; repeated documents and ids give theirs again; several items with one id and
    different texts are several questions, each with a row of its own.
    """
    spark = docs.sparkSession
    items = read_items(benchmark)
    if not items.ids:
        return spark.range(0).selectExpr(*[
            f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in MATCH.split(", ")])
    places = materialize(term_places(docs, items.numbers), "places")
    index = build(places, items, rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = index.search(part, cosine, common, answer, [0])
                if found:
                    ids = part.column(0).take(pa.array([f[0] for f in found]))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([f[1] for f in found], pa.int64()),
                         *[pa.array([float(f[k]) for f in found]) for k in (2, 3, 4)]],
                        [c.split()[0] for c in MATCH.split(", ")])

    return places.mapInArrow(run, MATCH)


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark item, with the columns they came with.

    Rows are judged by their own text: a clean row that shares its id with another stays, and a row without
    an id goes like any other. Repeated rows stay or go together. An empty table or benchmark takes nothing away.
    """
    key = row_key(docs)
    keyed = docs.select(key.alias("doc_id"), value(docs, "text", "string").alias("text"))
    bad = materialize(matches(keyed, benchmark).select(
        F.col("doc_id").alias("key")).distinct(), "contaminated")
    return docs.select(F.struct("*").alias("kept"), key.alias("key")).join(
        bad, "key", "left_anti").select("kept.*")
