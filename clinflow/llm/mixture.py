"""Mixing sources to target weights from packed blocks.

The words of a source form one stream, packed into blocks of ``block_words``; a block lists the parts of
documents it holds. The mix is a list of slots, cut into output shards. Every slot of a shard draws its
source by the targets, so a shard's counts per source are one multinomial draw. The draws of a source are
numbered through all shards; those beyond the number its target allows, about the square root of it, go
to sources that were drawn too seldom, so totals are exact. A draw's number goes through the source's
own permutations of block numbers, pass after pass, so a block comes a second time only when all have come
once. Slots and packed blocks then meet by (source, block number).
"""

from __future__ import annotations

import json
import random
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflow.llm.common import WORD, parallel, pick, unit_hash, value
from clinflow.operators.storage import materialize

#: Mixing weights are given per source by a person; more sources than this are refused.
MAX_SOURCES = 10_000
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587)
#: Products modulo a number of slots stay within a long below this number (9e15 words at 128 a block).
MAX_SLOTS = 1 << 46
STEPS = "array<struct<f:bigint,s:bigint>>"


@dataclass
class Source:
    name: str | None
    size: int
    target: float
    blocks: int
    draws: int  # slots it gets
    last_words: int  # words used of its last draw


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight; none above ``most`` times its size, the excess going to the
    others by weight until none is above."""
    out, open_, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0], total
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight >= most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return out


def rounds(n: int, seed: int) -> list[dict[str, int]]:
    """Factors and shifts of a bijection of [0, n) chosen by ``seed``."""
    rng, n = random.Random(f"{seed}:{n}"), max(n, 1)
    out = []
    for prime in PRIMES:
        # A factor that shares a divisor with n would be no bijection; 1 never does.
        factor = max(1, prime % n) if n % prime else 1
        out.append({"f": factor, "s": rng.randrange(n)})
        out.append({"f": 1, "s": n - (1 << (n.bit_length() - 1))})
    return out


def affine(v: Column, f: Column, s: Column, n: Column) -> Column:
    """``(v * f + s) % n`` for ``f`` below 2**31 and ``n`` below 2**46, in two parts that fit a long."""
    high = F.shiftright(f, 16)
    low = f.bitwiseAND(F.lit(0xFFFF).cast("bigint"))
    return ((v * high) % n * 65_536 + v * low + s) % n


def permuted(x: Column, n: Column, steps: Column) -> Column:
    """``x`` under the bijection of [0, n) that ``rounds`` gives: in each step an affine map modulo
    n, then a xor of the high into the low bits on the largest power-of-two prefix of [0, n)."""
    def power(bits: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)

    near = F.floor(F.log2(n.cast("double"))).cast("int")  # may be off by one next to powers of two
    bits = near - F.when(power(near) > n, 1).otherwise(0) + F.when(power(near + 1) <= n, 1).otherwise(0)
    top = power(bits)
    half = F.greatest(F.lit(1), F.floor((bits + 1) / 2).cast("int"))

    def step(v: Column, s: Column) -> Column:
        v = affine(v, s["f"], s["s"], n)
        high = F.call_function("shiftright", v, half)
        return v.bitwiseXOR(F.when(v < top, high).otherwise(F.lit(0).cast("bigint")))

    return F.aggregate(steps, x, step)


def word_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, tie) of every row; ``tie`` orders rows with the same id."""
    rows = pick(docs, doc_id="doc_id:bigint", text="text:string", source="source:string")
    return rows.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64("text").alias("tie"))


def plan(
    sizes: DataFrame, weights: tuple[float, ...], share: float, most: float, block_words: int,
) -> list[Source]:
    """One entry per source with words, in code point order, NULL last."""
    totals = sizes.groupBy("source").agg(F.sum("size")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources to mix")
    found = sorted(((r[0], r[1]) for r in totals), key=lambda s: (s[0] is None, s[0] or ""))
    own = [weights[i % len(weights)] for i in range(len(found))]
    aims = targets([s for _, s in found], own, share * sum(s for _, s in found), most)
    out = []
    for (name, size), aim in zip(found, aims):
        blocks = -(-size // block_words)
        passes, rest = (divmod(int(round(aim)), size) if size else (0, 0))
        partial = -(-rest // block_words)
        out.append(Source(
            name, size, aim, blocks, passes * blocks + partial,
            rest - (partial - 1) * block_words if partial else block_words))
    return out


def stream_places(sizes: DataFrame, buckets: int) -> DataFrame:
    """``begin``: the words of its source before a document.

    Sources are cut into hashed buckets, so a source with most rows is no single task: totals per
    bucket are few and summed first, then each bucket runs on its own.
    """
    rows = sizes.withColumn(
        "bucket", F.floor(unit_hash("doc_id", "tie", seed=3) * buckets).cast("int"))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "tie", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    over = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    firsts = materialize(
        rows.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
        .select(F.col("source").alias("s"), F.col("bucket").alias("k"),
                (F.sum("n").over(over) - F.col("n")).alias("before")), "bucket_starts")
    run = rows.withColumn("run", F.sum("size").over(inside) - F.col("size"))
    return run.join(
        firsts, run["source"].eqNullSafe(firsts["s"]) & (run["bucket"] == firsts["k"])).select(
        "doc_id", "source", "size", "tie", (F.col("before") + F.col("run")).alias("begin"))


def alias_table(weights: list[int]) -> list[dict[str, float]]:
    """For a draw by weight in constant time: column i stands for itself up to ``keep``, else for ``other``."""
    total, k = sum(weights), len(weights)
    keep, other = [w * k / total for w in weights], list(range(k))
    low = [i for i in range(k) if keep[i] < 1]
    high = [i for i in range(k) if keep[i] >= 1]
    while low and high:
        i, j = low.pop(), high[-1]
        other[i] = j
        keep[j] -= 1 - keep[i]
        if keep[j] < 1:
            low.append(high.pop())
    return [{"keep": keep[i] if other[i] != i else 1.0, "other": other[i]} for i in range(k)]


def literal(rows: list[dict], kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{kind}>>")


def shard_draws(spark, sources: list[Source], shard_slots: int, parts: int) -> DataFrame:
    """(shard, number, n): how many slots of each shard draw each source; one multinomial draw a shard."""
    drawn = [i for i, s in enumerate(sources) if s.draws]
    table = alias_table([sources[i].draws for i in drawn])
    table = literal([{"own": drawn[i], "keep": t["keep"], "other": drawn[t["other"]]}
                     for i, t in enumerate(table)], "own:int,keep:double,other:int")
    total = sum(s.draws for s in sources)
    u = unit_hash("id", seed=41) * len(drawn)
    column = F.element_at(table, (F.floor(u) + 1).cast("int"))
    return spark.range(0, total, 1, parts).select(
        F.floor(F.col("id") / shard_slots).alias("shard"), u.alias("u"), column.alias("column")).select(
        "shard", F.when(F.col("u") - F.floor("u") < F.col("column.keep"), F.col("column.own"))
        .otherwise(F.col("column.other")).alias("number")).groupBy("shard", "number").agg(
        F.count(F.lit(1)).alias("n"))


def slots(sizes: DataFrame, sources: list[Source], shard_slots: int, block_words: int) -> DataFrame:
    """(shard, slot, number, block, words): the mix itself, one row per block taken; ``number`` is
    the source's place in the list of sources. Slots of a shard count from 0 without gaps."""
    spark, total = sizes.sparkSession, sum(s.draws for s in sources)
    if total >= MAX_SLOTS:
        raise ValueError(f"{total} slots of {block_words} words: take longer blocks")
    if not total:
        return spark.range(0).selectExpr(
            "id AS shard", "id AS slot", "int(id) AS number", "id AS block", "int(id) AS words")
    counts = materialize(shard_draws(
        spark, sources, shard_slots, max(parallel(sizes), total >> 22)), "shard_draws")
    found = Counter(dict(tuple(r) for r in counts.groupBy("number").agg(F.sum("n")).collect()))
    per_source, passes, surplus, short, gap = [], [], 0, [], 0
    for i, s in enumerate(sources):
        shuffle = rounds(max(1, found[i]), i)[0]
        per_source.append({
            "found": max(1, found[i]), "f": shuffle["f"], "s": shuffle["s"], "draws": s.draws,
            "surplus": surplus, "blocks": max(1, s.blocks), "last": s.last_words, "first": len(passes)})
        surplus += max(0, found[i] - s.draws)
        if found[i] < s.draws:
            short.append({"number": i, "at": gap, "found": found[i]})
            gap += s.draws - found[i]
        # Each pass has a permutation of its own, so the last, partial one is a fresh draw.
        passes += [{"steps": rounds(s.blocks, len(passes) + k)}
                   for k in range(-(-s.draws // max(1, s.blocks)))]
    of = literal(per_source, "found:bigint,f:bigint,s:bigint,draws:bigint,surplus:bigint,"
                             "blocks:bigint,last:int,first:bigint")
    short = literal(short, "number:int,at:bigint,found:bigint")

    # The draws before a shard's, in two steps, so that neither window holds all shards.
    groups = materialize(counts.groupBy("number", F.floor(F.col("shard") / 1024).alias("g")).agg(
        F.sum("n").alias("n")), "draws_by_group")
    groups = groups.select(F.col("number").alias("k"), F.col("g").alias("h"), (F.sum("n").over(
        Window.partitionBy("number").orderBy("g")) - F.col("n")).alias("base"))
    rows = counts.withColumn("g", F.floor(F.col("shard") / 1024)).select(
        "*",
        (F.sum("n").over(Window.partitionBy("number", "g").orderBy("shard")) - F.col("n")).alias("run"),
        (F.sum("n").over(Window.partitionBy("shard").orderBy("number")) - F.col("n")).alias("offset"))
    rows = rows.join(groups.hint("merge"), (F.col("number") == F.col("k")) & (F.col("g") == F.col("h")))
    rows = rows.repartition(parallel(sizes), "shard", "number").select(
        "shard", "number", (F.col("base") + F.col("run")).alias("before"), "offset",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("i"))

    # The place in the shard.
    length = F.least(F.lit(shard_slots).cast("bigint"), F.lit(total) - F.col("shard") * shard_slots)
    factor = F.lit(PRIMES[1]).cast("bigint") % length
    factor = F.when((length % PRIMES[1] == 0) | (factor == 0), 1).otherwise(factor).cast("bigint")
    slot = affine(F.col("offset") + F.col("i"), factor, F.pmod(F.xxhash64("shard"), length), length)

    # The number of the draw: kept when its source may have it, else of a source that came too seldom.
    own = F.element_at(of, F.col("number") + 1)
    rows = rows.select("shard", slot.alias("slot"), "number", own.alias("own"), F.col("before"), "i")
    rows = rows.select("shard", "slot", "number", "own", affine(
        F.col("before") + F.col("i"), F.col("own.f"), F.col("own.s"), F.col("own.found")).alias("draw"))
    spare = F.col("own.surplus") + F.col("draw") - F.col("own.draws")
    taker = F.element_at(short, F.size(F.filter(short, lambda t: t["at"] <= spare)))
    kept = F.col("draw") < F.col("own.draws")
    rows = rows.select(
        "shard", "slot", F.when(~kept, F.struct(
            taker["number"].alias("number"),
            (taker["found"] + spare - taker["at"]).alias("draw"))).otherwise(
            F.struct("number", "draw")).alias("d"))
    own = F.element_at(of, F.col("d.number") + 1)
    rows = rows.select("shard", "slot", F.col("d.number").alias("number"), F.col("d.draw").alias("draw"),
                       own.alias("own"))
    steps = F.element_at(literal(passes, f"steps:{STEPS}"), (
        F.col("own.first") + F.floor(F.col("draw") / F.col("own.blocks")) + 1).cast("int"))["steps"]
    return rows.select(
        "shard", "slot", "number",
        permuted(F.col("draw") % F.col("own.blocks"), F.col("own.blocks"), steps).alias("block"),
        F.when(F.col("draw") == F.col("own.draws") - 1, F.col("own.last"))
        .otherwise(F.lit(block_words)).alias("words"))


def packed(places: DataFrame, block_words: int) -> DataFrame:
    """(number, block, parts): the documents' words that each block holds, in the order of the stream.
    A block has at most ``block_words`` parts."""
    last = F.floor((F.col("begin") + F.col("size") - 1) / block_words)
    pieces = places.where("size > 0").select(
        "row", "doc_id", "number", "begin", "size",
        F.explode(F.sequence(F.floor(F.col("begin") / block_words), last)).alias("block"))
    start = F.col("block") * block_words
    at = F.greatest(F.lit(0), F.col("begin") - start)
    stop = F.least(F.lit(block_words), F.col("begin") + F.col("size") - start)
    return pieces.groupBy("number", "block").agg(F.array_sort(F.collect_list(F.struct(
        at.cast("int").alias("at"), stop.cast("int").alias("stop"), "row", "doc_id",
        (start + at - F.col("begin")).alias("first")))).alias("parts"))


def prepared(docs, weights, share, most, block_words) -> tuple[list[Source], DataFrame]:
    sizes = materialize(word_sizes(docs), "sizes")
    sources = plan(sizes, weights, share, most, block_words)
    places = stream_places(sizes, max(64, 4 * parallel(docs)))
    number = F.element_at(
        F.create_map(*[x for i, s in enumerate(sources) if s.name is not None
                       for x in (F.lit(s.name), F.lit(i))]), F.col("source")) if any(
        s.name is not None for s in sources) else F.lit(None).cast("int")
    null_at = next((i for i, s in enumerate(sources) if s.name is None), -1)
    number = F.when(F.col("source").isNull(), F.lit(null_at)).otherwise(number)
    places = places.withColumn("number", number).withColumn("row", F.monotonically_increasing_id())
    return sources, materialize(places, "places")


def filled(places, sources, shard_slots, block_words) -> DataFrame:
    """The slots with the parts of their blocks. Both sides are sorted by block whatever their size: the
    slots grow with the corpus and are never broadcast."""
    chosen = materialize(slots(places, sources, shard_slots, block_words), "slots")
    return packed(places, block_words).join(chosen.hint("merge"), ["number", "block"])


def mixed(
    docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
    block_words: int = 128, shard_slots: int = 65_536,
) -> DataFrame:
    """The mix: (shard, slot, source, block, words, parts), one row per slot.

    ``parts`` lists (doc_id, first, words): so many words of the document from its word ``first`` on (from
    0), in order; they make up the ``words`` of the slot, fewer at the end of a source.
    Rows without words are in no part; an empty table has no slots.
    """
    sources, places = prepared(docs, weights, share, most, block_words)
    parts = F.transform(
        F.filter("parts", lambda p: p["at"] < F.col("words")),
        lambda p: F.struct(p["doc_id"].alias("doc_id"), p["first"].alias("first"),
                           (F.least(p["stop"], F.col("words")) - p["at"]).alias("words")))
    names = F.array(*[F.lit(s.name).cast("string") for s in sources]) if sources else F.array(
        F.lit(None).cast("string"))
    return filled(places, sources, shard_slots, block_words).select(
        "shard", "slot", F.element_at(names, F.col("number") + 1).alias("source"), "block", "words",
        parts.alias("parts"))


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
    block_words: int = 128, shard_slots: int = 65_536,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, tie) for every row of ``docs``.

    ``size`` counts words (NULL text: 0), ``target`` belongs to the row's source (weights repeat over
    the sources in code point order, NULL last), ``taken`` is the number of its words in the slots of
    ``mixed``, repeats counted: at most ``most`` (2 or less, whole) times its size. A source takes its target
    to within one block. ``tie`` is a hash of the text. Rows with one id and text share their places in turn;
    reruns agree whatever the file layout. A row without words takes none; an empty table gives no rows.
    """
    sources, places = prepared(docs, weights, share, most, block_words)
    used = F.inline("parts")
    words = F.greatest(F.lit(0), F.least("stop", "words") - F.col("at"))
    taken = filled(places, sources, shard_slots, block_words).select("words", used).groupBy("row").agg(
        F.sum(words).alias("taken"))
    sizes_of = F.lit([s.size for s in sources] or [0]).cast("array<bigint>")
    aims = F.lit([s.target for s in sources] or [0.0]).cast("array<double>")
    return places.join(taken.hint("merge"), "row", "left").select(
        "doc_id", "size", F.element_at(sizes_of, F.col("number") + 1).alias("source_size"),
        F.element_at(aims, F.col("number") + 1).alias("target"),
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "source", "tie")


def repeat(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with each document as often as the mix takes it, with the columns it came with.

    Whole documents stand for their words: taken / size times, rounded down, and once more with the
    probability of the rest (decided by a hash of the row, so reruns agree). Documents that the mix
    does not take go, and so do those without words, ids included: there is nothing to mix. A row is known by
    its id, text and source: rows that share all three, ids missing or not, share one number. Other columns
    may have any name. An empty table stays empty.
    """
    key = ["id", "tie", "origin"]
    taken = mix(docs, **settings).where("size > 0").groupBy(
        F.col("doc_id").alias("id"), "tie", F.col("source").alias("origin")).agg(
        (F.sum("taken") / F.sum("size")).alias("times"))
    whole = F.floor("times")
    more = F.when(unit_hash(*key, seed=31) < F.col("times") - whole, 1).otherwise(0)
    copies = materialize(taken.select(
        *key, (whole + more).cast("int").alias("copies")).where("copies > 0"), "copies")
    rows = docs.select(
        value(docs, "doc_id", "bigint").alias("id_"),
        F.xxhash64(value(docs, "text", "string")).alias("tie_"),
        value(docs, "source", "string").alias("origin_"), F.struct("*").alias("kept"))
    same = (F.col("id_").eqNullSafe(F.col("id")) & (F.col("tie_") == F.col("tie"))
            & F.col("origin_").eqNullSafe(F.col("origin")))
    # One small row a document is hashed, texts are not sorted.
    return rows.join(copies.hint("shuffle_hash"), same).select(
        "kept", F.explode(F.array_repeat(F.lit(True), F.col("copies")))).select("kept.*")
