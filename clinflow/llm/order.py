"""Total order over a table without one task that sees it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import unit_hash


def id_splitters(sizes: DataFrame, parts: int, per_part: int = 64) -> list[int]:
    """Up to ``parts - 1`` ids that cut the ids into ranges of about equal size.

    ``sizes`` has ``doc_id`` and ``size``. A bounded sample (``parts * per_part`` ids, each taken
    with a probability that grows with its size) goes to the driver; its quantiles are the cuts.
    """
    key = -F.log(F.greatest(unit_hash(F.col("doc_id")), F.lit(1e-18))) / F.greatest("size", F.lit(1))
    taken = sizes.where("doc_id is not null").orderBy(key, "doc_id").limit(parts * per_part)
    ids = sorted(r[0] for r in taken.select("doc_id").collect())
    return sorted({ids[len(ids) * i // parts] for i in range(1, parts)}) if ids else []


def range_of(splitters: list[int], column: str = "doc_id") -> Column:
    """The number of splitters up to the id; ids of NULL come last. Two levels of comparisons, so the
    work for a row grows with the square root of the number of ranges."""
    if not splitters:
        return F.lit(0)
    step = max(1, int(len(splitters) ** 0.5))
    tops = splitters[step - 1::step]
    blocks = [splitters[i:i + step] for i in range(0, len(splitters), step)] + [[]]
    array = "array<bigint>"
    top = F.size(F.filter(F.lit(tops).cast(array), lambda s: s <= F.col(column)))
    cells = F.array(*[F.lit(b).cast(array) if b else F.expr("cast(array() as array<bigint>)")
                      for b in blocks])
    low = F.size(F.filter(F.element_at(cells, top + 1), lambda s: s <= F.col(column)))
    return F.when(F.col(column).isNull(), F.lit(len(splitters))).otherwise(top * step + low)

