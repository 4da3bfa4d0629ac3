"""Sharding by sampled, size-weighted splitters.

Records are ordered by (hash of the text, doc_id, text length): equal texts are neighbours and no
value of a source or language can gather records. Splitters drawn from a size-weighted sample cut this
order into many ranges; ranges that turn out too large get more splitters from a sample of their own,
until none is. Exact sizes of the ranges and a running sum inside each range then give every record
its place in the order, in bytes and in rows, and shards are equal shares of the bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflow.llm.common import parallel, pick, unit_hash
from clinflow.operators.storage import materialize

KEY = ["key", "doc_id", "crc"]
Splitter = tuple[int, int, int]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, size, crc, key) of every record, without its text."""
    rows = pick(docs, doc_id="doc_id:bigint", text="text:string")
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("crc"), F.xxhash64(text).alias("key"))


def _order(row: Column | None = None) -> Column:
    """The sort key as one comparable value; a NULL id sorts first."""
    return F.struct("key", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "crc")


_TYPE = "array<struct<key:bigint,doc_id:bigint,crc:bigint>>"


def _literal(splitters: list[Splitter]) -> Column:
    return F.expr(f"cast({_text(splitters)} as {_TYPE})")


def _text(splitters: list[Splitter]) -> str:
    def number(v: int) -> str:
        return f"cast('{v}' as bigint)" if v == -(1 << 63) else f"{v}L"

    return "array({})".format(", ".join(
        f"struct({', '.join(map(number, s))})" for s in splitters))


def range_number(splitters: list[Splitter]) -> Column:
    """How many splitters a record is not below; found in two levels."""
    step = max(1, int(len(splitters) ** 0.5))
    blocks = [splitters[i:i + step] for i in range(0, len(splitters), step)] + [[]]
    me = _order()
    top = F.size(F.filter(_literal(splitters[step - 1::step]), lambda s: s <= me))
    cells = F.expr("array({})".format(
        ", ".join(f"cast({_text(b)} as {_TYPE})" for b in blocks)))
    low = F.size(F.filter(F.element_at(cells, top + 1), lambda s: s <= me))
    return top * step + low


def sample(rows: DataFrame, count: int, seed: int) -> list[Splitter]:
    """``count`` keys drawn with probabilities in proportion to size (smallest exponential waiting
    times with the size as rate), sorted."""
    wait = -F.log(F.greatest(unit_hash(*map(F.col, KEY), seed=seed), F.lit(1e-18))) / F.col("size")
    drawn = rows.orderBy(wait, *KEY).limit(count).select(_order().alias("k")).select("k.*")
    return sorted(tuple(r) for r in drawn.collect())


def splitters_for(rows: DataFrame, ranges: int, per_range: int = 8) -> tuple[list[Splitter], dict]:
    """Cuts for about ``ranges`` ranges, and (rows, bytes) of each range.

    A range with over twice its share, its largest record aside, is subdivided by a sample drawn
    inside it. That ends when every range is small enough or holds equal keys only.
    """
    drawn = sample(rows, ranges * per_range, 1)
    cuts = sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)} if drawn else set())
    seed = 2
    while True:
        number = range_number(cuts)
        found = {r[0]: tuple(r)[1:] for r in rows.groupBy(number.alias("r")).agg(
            F.count("*"), F.sum("size"), F.min(_order()) != F.max(_order()), F.max("size")
        ).collect()}
        total = sum(v[1] for v in found.values())
        over = {r: v[1] for r, v in found.items() if v[2] and v[1] - v[3] > 2 * total / ranges}
        if not over:
            return cuts, {r: v[:2] for r, v in found.items()}
        inside = rows.where(number.isin(sorted(over)))
        more = {k for k in sample(inside, len(over) * per_range * 4, seed)} - set(cuts)
        seed += 1
        # The first key of a range is no cut of it: a cut there would leave the range as it was.
        firsts = {tuple(r[0]) for r in inside.groupBy(number.alias("r")).agg(
            F.min(_order()).alias("k")).select("k").collect()}
        fresh = sorted(more - firsts)
        if not fresh:
            lasts = {tuple(r[0]) for r in inside.groupBy(number.alias("r")).agg(
                F.max(_order()).alias("k")).select("k").collect()}
            fresh = sorted(lasts - set(cuts))
        cuts = sorted({*cuts, *fresh})


def assign(docs: DataFrame, shards: int = 16, ranges: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): shards of nearly equal bytes.

    ``size`` is the UTF-8 length plus 1 (NULL text: 1). Shard s holds the records whose middle lies
    in [s, s + 1) / ``shards`` of all bytes, so a shard misses its share by less than one record. Slots count
    from 0 in each shard. ``ranges`` is the number of tasks that order the records, by default that of
    the session's shuffle partitions. Repeated rows get slots of their own. An empty table gives no rows; with
    fewer records than shards some shards stay empty.
    """
    rows = materialize(keyed(docs), "keys")
    cuts, found = splitters_for(rows, ranges or max(4 * shards, parallel(docs)))
    total = sum(v[1] for v in found.values())
    before_rows, before_bytes, n, b = [], [], 0, 0
    for r in range(len(cuts) + 1):
        before_rows.append(n)
        before_bytes.append(b)
        n, b = n + found.get(r, (0, 0))[0], b + found.get(r, (0, 0))[1]

    def at(values: list[int]) -> Column:
        return F.element_at(F.lit(values).cast("array<bigint>"), F.col("r") + 1)

    order = Window.partitionBy("r").orderBy(_order())
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("r", range_number(cuts))
    placed = placed.select(
        "doc_id", "size", "crc",
        (at(before_rows) + F.row_number().over(order) - 1).alias("row"),
        F.floor((at(before_bytes) + F.sum("size").over(until) - F.col("size") / 2)
                * F.lit(shards / max(total, 1))).cast("int").alias("shard"))
    placed = materialize(placed, "placed")
    first = {r[0]: r[1] for r in placed.groupBy("shard").agg(F.min("row")).collect()}
    starts = F.lit([first.get(s, 0) for s in range(shards)]).cast("array<bigint>")
    return placed.select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("row") - F.element_at(starts, F.col("shard") + 1)).alias("slot"))
