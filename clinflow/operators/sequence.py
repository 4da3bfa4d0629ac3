"""Position of a row in the ordered history of its group."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinflow.operators.skew import BLOCK, border_rows, cut, in_order, join_edges


def _edges(blocked, keys, order, prev, following):
    """One row per (border group, block): the neighbours just outside, the rows in earlier blocks."""
    position = F.struct(*order)
    carried = F.struct(*sorted({*order, *prev.values(), *following.values()}))
    edges = border_rows(blocked, keys).groupBy(*keys, BLOCK).agg(
        F.max_by(carried, position).alias("last"),
        F.min_by(carried, position).alias("first"),
        F.count(F.lit(1)).alias("_n"),
    )
    group = W.partitionBy(*keys)
    along = group.orderBy(BLOCK)
    before, after = F.lag("last").over(along), F.lead("first").over(along)
    return edges.select(
        *keys, BLOCK,
        *[before.getField(old).alias(f"_edge_{new}") for new, old in prev.items()],
        *[after.getField(old).alias(f"_edge_{new}") for new, old in following.items()],
        F.sum("_n").over(along.rowsBetween(W.unboundedPreceding, -1)).alias("_offset"),
        F.sum("_n").over(group).alias("_total"),
    )


def add_history(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    prev: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    seq: str | None = None,
    total: str | None = None,
    ordered_output: bool = False,
) -> DataFrame:
    """Add previous-row values, next-row values, sequence number and group size.

    ``prev`` / ``following`` map new column -> source column. ``order`` must end in a unique id,
    which makes the result independent of partitioning. All windows of a block share one exchange and
    one sort (see ``skew``). With ``ordered_output`` the rows come back in the order of keys + order.
    """
    prev, following = prev or {}, following or {}
    blocked = cut(df, keys, order)
    block = W.partitionBy(*keys, BLOCK)
    ordered = block.orderBy(*order)
    cols = {new: F.lag(old).over(ordered) for new, old in prev.items()}
    cols |= {new: F.lead(old).over(ordered) for new, old in following.items()}
    inside = blocked.withColumns(cols | {
        "_seq": F.row_number().over(ordered).cast("bigint"),
        "_rows": F.count(F.lit(1)).over(block),
    })
    rows = join_edges(inside, _edges(blocked, keys, order, prev, following), keys)
    is_first, is_last = F.col("_seq") == 1, F.col("_seq") == F.col("_rows")
    out = {new: F.when(is_first, F.col(f"_edge_{new}")).otherwise(F.col(new)) for new in prev}
    out |= {new: F.when(is_last, F.col(f"_edge_{new}")).otherwise(F.col(new)) for new in following}
    if seq:
        out[seq] = F.col("_seq") + F.coalesce("_offset", F.lit(0))
    if total:
        out[total] = F.coalesce("_total", "_rows")
    if ordered_output:
        rows = in_order(rows, [*keys, "_seq"])
    kept = [c for c in df.columns if c not in out]
    return rows.select(*kept, *[c.alias(name) for name, c in out.items()])
