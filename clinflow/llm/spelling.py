"""Spelling variant grouping by dense prefix-suffix tiles.

Two words are near if one inserted, deleted or replaced code point makes them equal, which holds exactly
when their common prefix and common suffix together reach the longer length minus one. Words are held as
padded code-point matrices, aligned left and right, and compared as blocks: the first column that differs
gives the prefix, the last one the suffix.

Which words meet: for a longer length m, a word is cut into pieces of about ``PIECE`` code points. One edit
lies in one piece, so near words agree before and behind some piece, and share the bucket of (m, piece,
what stands around it). A bucket holds words of m and m - 1 letters that differ within one piece. Words
of a bucket of over ``TILE`` words are dealt to tiles, and pairs of tiles are compared, in blocks, by
tasks of their own; nothing is left out. A pair may meet in several buckets; it counts in that of its first
shared piece, so links are found once and need no distinct. Only the number of near words and the best of
them leave a block, not the pairs.

Rows: a NULL text has no words; a NULL doc_id is written as an empty text. Rows with one id and one text
count each for itself, as do rows with one id and different texts. Empty tables give no rows. Very long texts
are worked off alone; counts are combined in the task before they are shuffled. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import parallel, pick, slices
from clinflow.operators.storage import materialize

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A word's form occurs at least this many times as often.
RATIO = 10
#: Code points in a piece, and pieces of a word at most.
PIECE, PIECES = 3, 16
#: Words of a tile; code points held and compared at once.
TILE, CELLS = 4096, 1 << 24
_HELD = 400_000


def counted(docs: DataFrame, one_in: int = 31, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n): words of at least ``least_length`` code points with their number of occurrences.

    A run whose crc32 together with its document's id ``one_in`` divides loses one code point, which
    plants variants as misspellings would; 0 leaves all runs as they are.
    """
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_length).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for part in slices(batch, 1):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if not text:
                        continue
                    # Bytes are lower-cased, which leaves all letters but A to Z as they are.
                    found = Counter(runs(text.encode().lower().decode()))
                    if one_in:
                        start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                        for word in [w for w in found
                                     if not (h := zlib.crc32(w.encode(), start)) % one_in]:
                            n, at = found.pop(word), zlib.crc32(word.encode(), start) % len(word)
                            if len(word) > least_length:
                                held[word[:at] + word[at + 1:]] += n
                    held.update(found)
                    if len(held) > _HELD:
                        yield flush()
        if held:
            yield flush()

    parts = pick(docs, doc_id="doc_id:bigint", text="text:string").mapInArrow(
        run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _pieces(m: Column) -> Column:
    return F.least(F.ceil(m / PIECE), F.lit(PIECES)).cast("int")


def bucketed(words: DataFrame) -> DataFrame:
    """(m, piece, before, behind, key, word, n): every word once for each piece of either length m."""
    longer = words.withColumn("length", F.char_length("word")).select(
        "word", "n", "length", F.explode(F.array("length", F.col("length") + 1)).alias("m"))
    cut = longer.select("*", _pieces(F.col("m")).alias("pieces"))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    edge = lambda i: F.floor(F.col("m") * i / F.col("pieces")).cast("int")
    cut = cut.withColumns({
        "before": edge(F.col("piece")), "behind": F.col("m") - edge(F.col("piece") + 1)})
    around = F.concat(
        F.expr("left(word, before)"), F.lit("|"), F.expr("right(word, behind)"))
    return cut.select(
        "m", "piece", "before", "behind", F.xxhash64("m", "piece", around).alias("key"), "word", "n")


def _matrix(words: list[bytes], m: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points aligned left and aligned right; the padding differs from every letter."""
    left = np.frombuffer(b"".join([w.ljust(m, b"\0") for w in words]), np.uint8).reshape(-1, m)
    right = np.frombuffer(b"".join([w.rjust(m, b"\0") for w in words]), np.uint8).reshape(-1, m)
    return left, right


class _Block:
    """Rows of buckets with one m and piece, and which pairs of them are near."""

    def __init__(self, m: int, piece: int, before: int, behind: int, words: list[str]):
        self.m, self.before, self.behind = m, before, behind
        pieces = min(-(-m // PIECE), PIECES)
        #: With a common suffix as long as this, the pair has met at an earlier piece.
        self.met = m - m * piece // pieces if piece else m + 1
        raw = [w.encode("latin-1") for w in words]
        self.size = np.array([len(r) for r in raw])
        self.left, self.right = _matrix(raw, m)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of row numbers: are they near, and is this their first common bucket?"""
        out = np.zeros(a.size, dtype=bool)
        step = max(1, CELLS // self.m)
        for at in range(0, a.size, step):
            i, j = a[at:at + step], b[at:at + step]
            prefix = _run(self.left[i] != self.left[j], self.m)
            suffix = _run((self.right[i] != self.right[j])[:, ::-1], self.m)
            shorter = np.minimum(self.size[i], self.size[j])
            longer = np.maximum(self.size[i], self.size[j])
            prefix, suffix = np.minimum(prefix, shorter), np.minimum(suffix, shorter)
            out[at:at + step] = (
                (longer == self.m) & (prefix + suffix >= self.m - 1)
                & (prefix >= self.before) & (suffix >= self.behind) & (suffix < self.met))
        return out


def _run(differs: np.ndarray, m: int) -> np.ndarray:
    """Columns before the first that differs."""
    return np.where(differs.any(axis=1), differs.argmax(axis=1), m)


_BEST = "word string, n_near bigint, best_n bigint, best string"


def near_counts(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) of the words that have near ones: how many, and the one with the
    largest n (ties: the smallest)."""
    rows = bucketed(words)
    # Few buckets are large, so this is small; its size is known before the join that uses it.
    large = materialize(
        rows.groupBy("key").count().where(F.col("count") > TILE)
        .select("key", F.ceil(F.col("count") / TILE).cast("int").alias("tiles")), "large_buckets")
    tile = F.pmod(F.xxhash64("word", F.lit(1)), "tiles").cast("int")
    dealt = rows.join(large, "key", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    dealt = dealt.withColumn("tile", tile).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select(
        "m", "piece", "before", "behind", "key", F.least("tile", "other").alias("t"),
        F.greatest("tile", "other").alias("u"), "tile", "word", "n")
    by = ["m", "piece", "key", "t", "u"]
    dealt = dealt.repartition(parallel(words), *by).sortWithinPartitions(*by, "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            yield from _best(table)

    found = dealt.mapInArrow(run, _BEST)
    # The order of (-n, word): the largest count first, then the smallest word.
    least = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("b")).select(
        "word", "n_near", (-F.col("b.minus")).alias("form_n"), F.col("b.form").alias("form"))


def _blocks(batches: Iterator[pa.RecordBatch], cells: int = CELLS // 16) -> Iterator[pa.Table]:
    """Tables of whole buckets with one m and piece, of about ``cells`` code points: buckets are bounded
    by two tiles, so a table is too."""
    held: list[pa.RecordBatch] = []
    last, size = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kind = [np.asarray(batch.column(c)) for c in ("m", "piece")]
        bucket = [np.asarray(batch.column(c)) for c in ("key", "t", "u")]
        new_kind = np.zeros(batch.num_rows, dtype=bool)
        for c in kind:
            new_kind[1:] |= c[1:] != c[:-1]
        new_bucket = new_kind.copy()
        for c in bucket:
            new_bucket[1:] |= c[1:] != c[:-1]
        first = tuple(int(c[0]) for c in [*kind, *bucket])
        new_bucket[0] = last is not None and first != last
        new_kind[0] = last is not None and first[:2] != last[:2]
        start = 0
        for at in np.flatnonzero(new_bucket).tolist():
            if new_kind[at] or (size + at - start) * int(kind[0][at - 1]) >= cells:
                if at > start:
                    held.append(batch.slice(start, at - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, size = [], at, 0
        held.append(batch.slice(start))
        size += batch.num_rows - start
        last = tuple(int(c[-1]) for c in [*kind, *bucket])
    if held:
        yield pa.Table.from_batches(held)


def _best(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Number of near words and the best of them, for every word of the buckets that has any."""
    words = table.column("word").to_pylist()
    one = lambda c: int(table.column(c)[0].as_py())
    block = _Block(one("m"), one("piece"), one("before"), one("behind"), words)
    key, t, u, tile, n = (table.column(c).to_numpy() for c in ("key", "t", "u", "tile", "n"))
    starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (t[1:] != t[:-1]) | (u[1:] != u[:-1])])
    sizes = np.diff(np.r_[starts, key.size])
    pairs = []
    # Small buckets together: row r with row r + shift, as long as both are in one bucket.
    ends = np.repeat(starts + sizes, sizes)
    rows = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= 64), sizes))
    shift = 1
    while rows.size:
        rows = rows[rows + shift < ends[rows]]
        # Tiles t and u of a large bucket are compared with each other; within themselves where t is u.
        meet = rows[(t[rows] == u[rows]) | (tile[rows] != tile[rows + shift])]
        near = block.near(meet, meet + shift)
        pairs.append(np.stack([meet[near], meet[near] + shift]))
        shift += 1
    # Large ones each for itself, in blocks of rows against the rows behind them.
    for start, size in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist()):
        step = max(1, (1 << 20) // size)
        for at in range(start, start + size, step):
            top = np.arange(at, min(at + step, start + size))
            a, b = (x.reshape(-1) for x in np.meshgrid(
                top, np.arange(at + 1, start + size), indexing="ij"))
            ok = (a < b) & ((t[a] == u[a]) | (tile[a] != tile[b]))
            a, b = a[ok], b[ok]
            near = block.near(a, b)
            pairs.append(np.stack([a[near], b[near]]))
    if not pairs:
        return
    a, b = np.concatenate(pairs, axis=1)
    if not a.size:
        return
    # Every link both ways; the best by (n falling, word rising), the number by bincount.
    own, other = np.concatenate([a, b]), np.concatenate([b, a])
    place = np.empty(len(words), dtype=np.int64)
    place[np.array(sorted(range(len(words)), key=words.__getitem__))] = np.arange(len(words))
    order = np.lexsort((place[other], -n[other], own))
    own, other = own[order], other[order]
    heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    counts = np.diff(np.r_[heads, own.size])
    yield pa.RecordBatch.from_arrays([
        pa.array([words[i] for i in own[heads].tolist()], pa.string()), pa.array(counts, pa.int64()),
        pa.array(n[other[heads]], pa.int64()),
        pa.array([words[i] for i in other[heads].tolist()], pa.string())],
        ["word", "n_near", "best_n", "best"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: the end of the chain word, form, form's form, ...

    A form occurs at least ``RATIO`` times as often as its word, so chains are short and have no circle;
    every round doubles the steps taken. Links are few per round and joined as tables, and the links into
    one frequent form are split by adaptive execution.
    """
    at = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        step = at.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        moved = materialize(
            at.join(step, F.col("root") == F.col("_at"), "left").select(
                "word", F.coalesce("_next", "root").alias("root"),
                F.col("_next").isNotNull().alias("moved")), "forms")
        if not moved.where("moved").take(1):
            return moved.select("word", "root")
        at = moved.select("word", "root")


def variants(docs: DataFrame, one_in: int = 31, least_length: int = LEAST_LENGTH,
             least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word that occurs often enough."""
    words = materialize(
        counted(docs, one_in, least_length).where(F.col("n") >= least_count), "words")
    near = materialize(near_counts(words), "near_words")
    joined = words.join(near, "word", "left")
    formed = F.col("form_n") >= ratio * F.col("n")
    found = materialize(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(formed, F.col("form")).alias("form"),
        F.when(formed, F.col("form_n")).alias("form_n")), "near_forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
