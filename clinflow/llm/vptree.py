"""SimHash near-duplicates found with vantage-point trees over Hamming distance.

Two fingerprints that differ in at most ``bits`` bits differ in at most ``bits // 2`` bits in one of
their 32-bit halves. So there is one tree per half, with ``bits // 2`` as its search radius. A node
holds a vantage point and a distance: fingerprints up to that distance go inside, others outside, and
by the triangle bound a branch can hold a partner only if the distances to the vantage point differ by
no more than the radius. A fingerprint near the border therefore visits the outer branch too. Leaves are
the shards; all members and visitors of a leaf meet in one task, which compares whole fingerprints.

The trees are fitted on a bounded sample (``sample_rows``); every fingerprint is routed through them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import parallel, pick, row_key, runs, value
from clinflow.llm.components import connected_components
from clinflow.operators.storage import materialize

SEED = 42


def simhash(text: str | None, width: int = 3) -> int:
    """64-bit SimHash over word shingles; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < width:
        grams = iter([b" ".join(words)])
        total = 1
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(width)]))
        total = len(words) - width + 1
    counts = np.zeros(64, dtype=np.int64)
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype=np.uint64, count=total)
    for at in range(0, total, 8192):
        part = hashes[at:at + 8192].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(doc_id, fp), or other long columns to keep before fp: one row per row of the documents; fp is the
    unsigned value held in a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array(
                [simhash(t.as_py(), width) for t in batch.column(0)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(values.view(np.int64))], [*keep, "fp"])

    return pick(docs, text="text:string", **{c: f"{c}:bigint" for c in keep}).mapInArrow(
        run, ", ".join(f"{c} bigint" for c in [*keep, "fp"]))


class Tree:
    """Arrays of nodes; node 0 is the root, ``child`` < 0 marks leaf number -child - 1."""

    def __init__(self, points: np.ndarray, depth: int, rng: np.random.Generator):
        vantage, limit, child = [0], [0], [[0, 0]]
        self.leaves = 0
        todo = [(0, points, depth)]
        while todo:
            node, own, left = todo.pop()
            far = mu = None
            if left and own.size >= 8:
                v = own[rng.integers(own.size)]
                d = np.bitwise_count(own ^ v).astype(np.int64)
                mu = int(np.median(d))
                far = d > mu
            if far is None or not far.any():
                child[node] = [-self.leaves - 1, -self.leaves - 1]
                limit[node] = 64
                self.leaves += 1
                continue
            vantage[node], limit[node] = int(v), mu
            for side, part in enumerate((own[~far], own[far])):
                child[node][side] = len(vantage)
                vantage.append(0)
                limit.append(0)
                child.append([0, 0])
                todo.append((child[node][side], part, left - 1))
        self.vantage = np.array(vantage, dtype=np.uint32)
        self.limit = np.array(limit)
        self.child = np.array(child)

    def route(self, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(index into values, leaf) of every leaf that a value belongs to or must visit."""
        rows, nodes = np.arange(values.size), np.zeros(values.size, dtype=np.int64)
        out_rows, out_leaves = [], []
        while rows.size:
            d = np.bitwise_count(values[rows] ^ self.vantage[nodes]).astype(np.int64)
            inside = d <= self.limit[nodes]
            leaf = self.child[nodes, 0] == self.child[nodes, 1]
            visits = inside & (d + radius > self.limit[nodes]) & ~leaf
            rows_on = np.concatenate([rows, rows[visits]])
            nodes = np.concatenate([
                np.where(inside, self.child[nodes, 0], self.child[nodes, 1]),
                self.child[nodes[visits], 1]])
            done = nodes < 0
            out_rows.append(rows_on[done])
            out_leaves.append(-nodes[done] - 1)
            rows, nodes = rows_on[~done], nodes[~done]
        return np.concatenate(out_rows or [rows]), np.concatenate(out_leaves or [nodes])


def local_links(points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(point, root) index pairs that span the link graph of the points: one fewer than the members of
    each connected group, never all its pairs."""
    left = np.arange(points.size)
    if points.size <= 2048:
        near = np.bitwise_count(points[:, None] ^ points[None, :]) <= bits
        left = np.flatnonzero(near.sum(axis=1) > 1)
    members, roots = [], []
    while left.size:
        root, left = left[0], left[1:]
        front = [root]
        while front and left.size:
            near = np.bitwise_count(points[left] ^ points[front.pop()]) <= bits
            hit = left[near]
            if hit.size:
                members.append(hit)
                roots.append(np.full(hit.size, root))
                front.extend(hit.tolist())
                left = left[~near]
    if not members:
        return left[:0], left[:0]
    return np.concatenate(members), np.concatenate(roots)


def link_forest(
    points: DataFrame, bits: int = 3, leaf_rows: int = 64, sample_rows: int = 131_072,
    tile_rows: int = 100_000,
) -> DataFrame:
    """(a, b) links between distinct values of ``fp`` that keep the connectivity of all pairs within
    ``bits`` bits.

    ``leaf_rows`` sets the size of a usual leaf. The trees are fitted on at most about
    ``sample_rows`` values, taken by a hash of the value. A leaf with more than ``tile_rows`` rows is
    cut into tiles and every two tiles meet in a task of their own, so a task never holds more than
    twice that number however similar the fingerprints are, and no pair is lost.
    """
    total = points.count()
    share = min(1.0, sample_rows / max(total, 1))
    chosen = points.where(
        F.shiftrightunsigned(F.xxhash64(F.lit(7), "fp"), 11) <= int(share * (1 << 53)))
    sample = np.array([r[0] for r in chosen.sort("fp").collect()], dtype=np.int64).view(np.uint64)
    depth = max(0, int(np.ceil(np.log2(max(total, 1) / leaf_rows))))
    rng = np.random.default_rng(SEED)
    halves = [(sample >> np.uint64(s)).astype(np.uint32) for s in (0, 32)]
    trees = [Tree(np.unique(h), depth, rng) for h in halves]
    radius = bits // 2

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column(0)).view(np.uint64)
            for half, tree in enumerate(trees):
                part = (values >> np.uint64(32 * half)).astype(np.uint32)
                rows, leaves = tree.route(part, radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaves * 2 + half), pa.array(values[rows].view(np.int64))],
                    ["leaf", "fp"])

    routed = materialize(
        points.select("fp").mapInArrow(route, "leaf bigint, fp bigint"), "leaves")
    large = materialize(
        routed.groupBy("leaf").count().where(F.col("count") > tile_rows)
        .select("leaf", F.ceil(F.col("count") / tile_rows).cast("int").alias("tiles")), "large_leaves")
    tiled = routed.join(large, "leaf").withColumn("t", F.pmod(F.xxhash64("fp"), "tiles"))
    tiled = tiled.select(
        "leaf", "fp", "t",
        F.explode(F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1),
                           lambda o: o != F.col("t"))).alias("o"))
    small = routed.join(large, "leaf", "left_anti").select(
        "leaf", F.lit(0).cast("bigint").alias("p"), F.lit(0).cast("bigint").alias("q"), "fp")
    shards = small.union(tiled.select(
        "leaf", F.least("t", "o").alias("p"), F.greatest("t", "o").alias("q"), "fp"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in runs(batches, ["leaf", "p", "q"]):
            values = np.asarray(shard.column("fp")).view(np.uint64)
            members, roots = local_links(values, bits)
            if members.size:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[x].view(np.int64)) for x in (members, roots)], ["a", "b"])

    keys = ["leaf", "p", "q"]
    return shards.repartition(parallel(points), *keys).sortWithinPartitions(*keys).mapInArrow(
        meet, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, bits: int = 3, width: int = 3, **tuning) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most ``bits`` differing bits.
    Equal fingerprints (copies, texts without words, NULL texts) are collapsed before any
    comparison. A row without doc_id takes part with its text and is never named as a component;
    the component of rows that all lack an id is NULL. Repeated rows come back as often as they came.
    An empty table gives an empty result.
    """
    fps = materialize(fingerprints(docs, width), "fingerprints")
    labels = materialize(label(fps, bits, **tuning).select("fp", "component_id"), "labels")
    return fps.join(labels, "fp").select("doc_id", "fp", "component_id")


def label(fps: DataFrame, bits: int, **tuning) -> DataFrame:
    """(fp, component_id, root) for every distinct ``fp``; ``root`` names a component even where no row
    of it has an id."""
    points = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "points")
    nodes = connected_components(link_forest(points.select("fp"), bits, **tuning))
    nodes = materialize(nodes, "components")
    rooted = points.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    return rooted.join(least, "root").select("fp", "component_id", "root")


def keep_first(docs: DataFrame, bits: int = 3, width: int = 3) -> DataFrame:
    """One document of each group of near-duplicates, once: the one with the smallest doc_id, where it has one,
    else any that is always the same.

    Rows that share an id but not a group are different documents, each judged in its own group. Rows without an
    id go when a near-duplicate stays. All columns are kept, whatever their names. An empty table stays empty.
    """
    keyed = docs.select(row_key(docs).alias("key"), value(docs, "doc_id", "bigint").alias("doc_id"),
                        value(docs, "text", "string").alias("text"))
    fps = materialize(fingerprints(keyed, width, ("doc_id", "key")), "fingerprints")
    labels = materialize(label(fps, bits), "labels")
    firsts = fps.join(labels, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = materialize(firsts.groupBy("root").agg(F.min("key").alias("key")).select("key"), "kept")
    rows = docs.select(F.struct("*").alias("kept"), row_key(docs).alias("key"))
    return rows.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("kept.*")
