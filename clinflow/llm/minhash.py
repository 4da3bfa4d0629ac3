"""MinHash fingerprints of word shingles, and near-duplicates found by bands.

A shingle's 32-bit hash x goes through universal hash permutations, (a * x + b) in 64 bits with the
high half kept; the least value of each makes the signature. The share of equal components
estimates the Jaccard similarity of two texts.

Near-duplicates share a band, a run of components. In each bucket, the texts of an equal band, all are
compared with one of them; only where that leaves some apart do all of the bucket meet. What
is compared are the whole sets of shingle hashes; texts with equal sets are one point from the start.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import parallel, pick, runs, slices
from clinflow.llm.components import connected_components
from clinflow.llm.order import id_splitters, range_of
from clinflow.operators.storage import materialize

WIDTH = 5
HASHES = 64
BANDS = 16
EMPTY = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)


def permutations(count: int = HASHES, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(1, 1 << 63, count, dtype=np.uint64) | np.uint64(1),
            rng.integers(0, 1 << 63, count, dtype=np.uint64))


A, B = permutations()


def shingle_hashes(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Distinct 32-bit hashes of the word shingles of a whole text, letters A-Z lower-cased; a text
    with fewer words has one shingle, a text without words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint32)
    h = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))
    # Multiply-add over the window, in 64 bits, then the high half: order of words counts.
    mixed = np.zeros(max(1, len(words) - width + 1), dtype=np.uint64)
    for i in range(min(width, len(words))):
        part = h[i:i + mixed.size] + np.uint64(1)
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + part * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
    return np.unique((mixed >> np.uint64(32)).astype(np.uint32))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Least permuted value of each permutation; all ones for no shingles. Long texts go in parts.

    (a * x + b) >> 32 in 64-bit arithmetic with odd a is a universal family on 32-bit x.
    """
    out = EMPTY.copy()
    for at in range(0, hashes.size, 4096):
        x = hashes[at:at + 4096].astype(np.uint64)
        values = (A[:, None] * x + B[:, None]) >> np.uint64(32)
        out = np.minimum(out, values.min(axis=1).astype(np.uint32))
    return out


def set_key(hashes: np.ndarray) -> int:
    """A 64-bit number of a set of shingle hashes, signed; texts with equal sets are one point."""
    return int(np.array(xxhash.xxh64_intdigest(hashes.tobytes()), dtype=np.uint64).view(np.int64))


def bands(sig: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bands of a signature, the number of the band in each."""
    return np.array([xxhash.xxh64_intdigest(part.tobytes(), i) for i, part in enumerate(
        sig.reshape(BANDS, -1))], dtype=np.uint64).view(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays without repeats; two empty ones are equal."""
    both = np.intersect1d(a, b, assume_unique=True).size
    return both / (a.size + b.size - both) if a.size + b.size else 1.0


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text, tie): NULL texts as empty ones, ``tie`` tells rows with one id apart."""
    rows = pick(docs, doc_id="doc_id:bigint", text="text:string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("tie", F.xxhash64("text"))


def band_marks(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, key, bands) of each row; a text without words has no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                sets = [shingle_hashes(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2), pa.array([set_key(s) for s in sets], pa.int64()),
                    pa.array([bands(signature(s)) if s.size else [] for s in sets],
                             pa.list_(pa.int64()))], ["doc_id", "tie", "key", "bands"])

    return texts_of(docs).mapInArrow(run, "doc_id bigint, tie bigint, key bigint, bands array<bigint>")


def spots(chosen: DataFrame, bits: int = 26) -> np.ndarray:
    """A map of ``2 ** bits`` bits (8 MB) with those of the rows (key, first) set, however many they are."""
    at = F.col("key").bitwiseXOR(F.coalesce("first", F.lit(0))).bitwiseAND((1 << bits) - 1)
    words = chosen.select(at.alias("at")).select(
        F.shiftright("at", 6).alias("word"),
        F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit")).groupBy("word").agg(
        F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[np.asarray(words.column("word"))] = np.asarray(words.column("bit"))
    return out


def shingle_sets(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(key, hashes) of the rows whose spot is set: every wanted row, and others that share a spot.
    The hashes are packed uint32, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                keys, sets = [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                    hashes = shingle_hashes(text.as_py())
                    key = set_key(hashes)
                    at = (key ^ (doc_id or 0)) & (wanted.size * 64 - 1)
                    if int(wanted[at >> 6]) >> (at & 63) & 1:
                        keys.append(key)
                        sets.append(hashes.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["key", "hashes"])

    return pick(docs, doc_id="doc_id:bigint", text="text:string").mapInArrow(
        run, "key bigint, hashes binary")


def star_links(pairs: DataFrame, sets: DataFrame, least: float, tile_rows: int) -> DataFrame:
    """Those of the pairs (key, hub) whose sets are at least ``least`` alike.

    A hub's pairs are dealt to tasks in tiles of about ``tile_rows``, its set with each tile; a task holds
    one hub's set and one batch of others at a time.
    """
    tiles = materialize(pairs.groupBy("hub").agg(
        F.ceil(F.count("*") / tile_rows).cast("bigint").alias("tiles")), "hubs")
    spokes = pairs.join(tiles, "hub").join(sets, "key").select(
        "hub", F.pmod(F.xxhash64("key"), "tiles").alias("t"), F.lit(1).alias("spoke"), "key", "hashes")
    hubs = tiles.join(sets, F.col("hub") == F.col("key")).select(
        "hub", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)).alias("t"),
        F.lit(0).alias("spoke"), "key", "hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            found = []
            for hub, spoke, key, packed in zip(*[batch.column(i).to_pylist() for i in (0, 2, 3, 4)]):
                values = np.frombuffer(packed, np.uint32)
                if not spoke:
                    own = values
                elif jaccard(own, values) >= least:
                    found.append((key, hub))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return hubs.union(spokes).repartition(parallel(pairs), "hub", "t").sortWithinPartitions(
        "hub", "t", "spoke").mapInArrow(run, "a bigint, b bigint")


def forest(sets: list[np.ndarray], label: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Index pairs of sets at least ``least`` alike that join what has different labels: one fewer
    than the labels they bring together."""
    label, found = label.copy(), []
    sizes = np.array([s.size for s in sets])
    for i, own in enumerate(sets):
        if (label == label[0]).all():
            break
        other = np.flatnonzero(
            (label != label[i]) & (sizes >= least * own.size) & (own.size >= least * sizes))
        if not other.size or not own.size:
            continue
        flat = np.concatenate([sets[j] for j in other])
        at = np.minimum(np.searchsorted(own, flat), own.size - 1)
        starts = np.cumsum(sizes[other]) - sizes[other]
        both = np.add.reduceat((own[at] == flat).astype(np.int64), starts)
        for j in other[both >= least * (own.size + sizes[other] - both)]:
            if label[j] != label[i]:
                found.append((i, int(j)))
                label[label == label[j]] = label[i]
    return found


def bucket_links(members: DataFrame, sets: DataFrame, least: float, tile_rows: int) -> DataFrame:
    """Links within buckets of (h, key, label), beside those that equal labels stand for.

    A bucket with more than ``tile_rows`` members is cut into tiles and every two tiles meet in a task
    of their own: no pair is lost, and no task holds more than two tiles.
    """
    tiles = materialize(members.groupBy("h").agg(
        F.ceil(F.count("*") / tile_rows).cast("bigint").alias("tiles")), "buckets")
    dealt = members.join(tiles, "h").withColumn("t", F.pmod(F.xxhash64("key"), "tiles"))
    others = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1), lambda o: o != F.col("t"))
    dealt = dealt.withColumn("o", F.explode(F.when(
        F.col("tiles") > 1, others).otherwise(F.array(F.col("t")))))
    keys = ["h", "p", "q"]
    dealt = dealt.join(sets, "key").select(
        "h", F.least("t", "o").alias("p"), F.greatest("t", "o").alias("q"), "key", "label", "hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in runs(batches, keys):
            values = [np.frombuffer(x.as_py(), np.uint32) for x in shard.column("hashes")]
            key = np.asarray(shard.column("key"))
            found = np.array(forest(values, np.asarray(shard.column("label")), least))
            if found.size:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[found[:, i]]) for i in (0, 1)], ["a", "b"])

    return dealt.repartition(parallel(members), *keys).sortWithinPartitions(*keys).mapInArrow(
        run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, least: float = 0.8, tile_rows: int = 512) -> DataFrame:
    """(doc_id, tie, component_id, classed) for every row; ``tie`` is a hash of its text.

    ``component_id`` is the smallest doc_id reachable over texts whose sets of five-word shingles have a
    Jaccard similarity of ``least`` or more and that share a band; two texts at 0.8 do so with a
    probability of 0.9998. ``classed`` is true for rows in a class of two or more. Texts without words
    are one class. Rows without an id link like others but name no class; a class of such rows
    alone has the id NULL. An empty table gives no rows.
    """
    marks = materialize(band_marks(docs), "marks")
    places = marks.select("key", F.explode("bands").alias("h"))
    buckets = materialize(
        places.groupBy("h").agg(F.min("key").alias("hub"), F.max("key").alias("last"))
        .where("hub != last").select("h", "hub"), "shared_bands")
    members = materialize(
        places.join(buckets, "h").select("h", "hub", "key").distinct(), "members")
    pairs = materialize(members.where("key != hub").select("key", "hub").distinct(), "pairs")
    needed = pairs.select("key").union(pairs.select("hub")).distinct()
    # One row stands for each set: of those with the smallest doc_id any one.
    chosen = materialize(marks.select("key", "doc_id").join(needed, "key").groupBy("key").agg(
        F.min("doc_id").alias("first")), "chosen")
    # Sets of other rows that share a spot do no harm: the joins by key leave them out.
    sets = materialize(
        shingle_sets(docs, spots(chosen)).dropDuplicates(["key"]), "sets").select("key", "hashes")
    links = materialize(star_links(pairs, sets, least, tile_rows), "star_links")
    # Where a member is not linked to its hub, all of the bucket meet; buckets with the same members
    # meet once. Two members need no second look.
    linked = links.select(F.col("a").alias("key"), F.col("b").alias("hub"), F.lit(True).alias("linked"))
    seen = members.join(linked, ["key", "hub"], "left").select(
        "h", "hub", "key", (F.col("linked").isNotNull() | (F.col("key") == F.col("hub"))).alias("same"))
    left = materialize(seen.groupBy("h").agg(
        F.count("*").alias("n"), F.bool_and("same").alias("closed"),
        F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("who"))
        .where("not closed and n > 2").groupBy("n", "who").agg(F.min("h").alias("h")), "open_buckets")
    apart = materialize(seen.join(left.select("h"), "h").select(
        "h", "key", F.when(F.col("same"), F.col("hub")).otherwise(F.col("key")).alias("label")),
        "open_members")
    links = links.union(bucket_links(apart, sets, least, tile_rows))
    nodes = materialize(connected_components(links), "components")
    points = marks.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    rooted = materialize(points.join(nodes.withColumnRenamed("node", "key"), "key", "left")
                         .where("n > 1 or root is not null")
                         .select("key", "first", F.coalesce("root", "key").alias("root")), "rooted")
    least_id = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least_id, "root").select("key", "component_id", F.lit(True).alias("classed"))
    return marks.select("doc_id", "tie", "key").join(named, "key", "left").select(
        "doc_id", "tie", F.when(F.col("classed"), F.col("component_id")).otherwise(F.col("doc_id"))
        .alias("component_id"), F.coalesce("classed", F.lit(False)).alias("classed"))


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as many first code points of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """For each row its signature, the edited text's, and the likenesses, next in descending id.

    With ``classes``, as ``near_duplicates`` returns them, each row gets its ``component_id`` too: they come
    along in the same shuffle, ahead of their rows. Otherwise every row is a class of its own.

    One shuffle of compressed texts: rows go to ranges of doc_id (bounds from a size-weighted
    sample), and the first row of a range goes along to the range whose last row it follows, as does the
    very first one to the end. Rows without an id come last; repeated ids are ordered by text, descending.
    NULL texts count as empty; a single row follows itself. An empty table gives no rows.
    """
    rows = texts_of(docs)
    parts = parallel(docs)
    splitters = id_splitters(
        rows.select("doc_id", F.octet_length("text").alias("size")), parts)
    top = len(splitters)
    # Ranges in descending order of id: number 0 has the largest ids, the last one those without.
    number = F.when(F.col("doc_id").isNull(), F.lit(top + 1)).otherwise(top - range_of(splitters))
    # The greatest row of each range: an id and, among rows with that id, a hash of the text.
    heads = rows.select(number.alias("r"), "doc_id", "tie").groupBy("r").agg(
        F.max(F.struct("doc_id", "tie")).alias("h")).select("r", "h.*").sort("r").collect()
    if not heads:
        return _empty(docs)
    order = [h[0] for h in heads]
    goes = {order[i]: order[i - 1] for i in range(len(order))}  # the first one's row to the last
    is_head = F.lit(False)
    for h in heads:
        same = F.col("doc_id").eqNullSafe(F.lit(h[1]).cast("bigint"))
        is_head = is_head | (same & (F.col("r") == h[0]) & (F.col("tie") == h[2]))
    to = F.element_at(F.create_map(*[F.lit(x) for kv in goes.items() for x in kv]), F.col("r"))

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part in slices(batch, 1):
                texts = [t.as_py() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([squeeze(t.encode("utf-8", "surrogatepass")) for t in texts]),
                    *part.columns[2:],
                    pa.array([signature(shingle_hashes(t)).tobytes() for t in texts], pa.binary())],
                    ["doc_id", "body", "r", "tie", "sig"])

    small = rows.select("doc_id", "text", number.cast("int").alias("r"), "tie").mapInArrow(
        shrink, "doc_id bigint, body binary, r int, tie bigint, sig binary")
    # A row that comes to a range as its follower only is a ghost; it sorts behind all others.
    dealt = small.withColumn("ghost", F.explode(F.when(
        is_head, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    dealt = dealt.withColumn("r", F.when(F.col("ghost"), to).otherwise(F.col("r")))
    dealt = dealt.select(
        "r", "ghost", "doc_id", "tie", F.lit(None).cast("bigint").alias("component_id"), "body", "sig")
    if classes is not None:  # rows without a body
        dealt = dealt.union(classes.where("classed").select(
            number.cast("int"), F.lit(False), "doc_id", "tie", "component_id",
            F.lit(None).cast("binary"), F.lit(None).cast("binary")).distinct())
    dealt = dealt.repartitionById(parts, "r").sortWithinPartitions(
        "r", "ghost", F.col("doc_id").desc_nulls_last(), F.col("tie").desc(),
        F.col("body").isNotNull())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor().decompress
        held, named, out = None, None, []

        def emit(now: tuple, after: tuple) -> None:
            doc_id, text, sig = now[1:4]
            changed = edited(text, after[2])
            other = signature(shingle_hashes(changed))
            out.append((doc_id, len(text), changed, sig, other, after[3], now[4]))

        for batch in batches:
            for r, ghost, doc_id, tie, component, body, sig in zip(
                    *[c.to_pylist() for c in batch.columns]):
                if body is None:
                    named = (doc_id, tie, component)
                    continue
                if named is None or named[:2] != (doc_id, tie):
                    named = (doc_id, tie, doc_id)
                row = (r, doc_id, grow(body).decode("utf-8", "surrogatepass"),
                       np.frombuffer(sig, np.uint32), named[2])
                if held is not None and held[0] == r:
                    emit(held, row)
                # Of several equal heads one ghost is enough, and it has no follower here.
                held = None if ghost else row
            if out:
                yield _rows(out)
                out.clear()

    return dealt.mapInArrow(walk, SCHEMA)


SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double, component_id bigint")


def _empty(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame([], SCHEMA)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    def hexed(sig: np.ndarray) -> str:
        return sig.astype(">u4").tobytes().hex()

    return pa.RecordBatch.from_arrays([
        pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
        pa.array([hashlib.sha256(o[2].encode("utf-8", "surrogatepass")).hexdigest() for o in out]),
        pa.array([hexed(o[3]) for o in out]), pa.array([hexed(o[4]) for o in out]),
        pa.array([likeness(o[3], o[4]) for o in out]),
        pa.array([likeness(o[3], o[5]) for o in out]),
        pa.array([o[6] for o in out], pa.int64())], [c.split()[0] for c in SCHEMA.split(", ")])
