"""Exact percentiles and ranks over value counts.

Rows are first reduced to (group, value) -> count, combined map-side. Everything that follows
works on distinct values, so a group with a third of all rows costs no more than its distinct
values, and these are ranked in blocks (see ``skew``).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinflow.operators.skew import BLOCK, cut, join_edges, same_keys


def value_counts(df: DataFrame, keys: list[str], value: str, **extra: Column) -> DataFrame:
    """One row per group and distinct non-NULL value with its count ``n`` and further sums."""
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n"), *[c.alias(name) for name, c in extra.items()])
    )


def with_ranks(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Add ``_below`` (rows with a smaller value), ``_total`` and ``_mean`` of the group."""
    if not keys:
        one_group = counts.withColumn("_all", F.lit(0))
        return with_ranks(one_group, ["_all"], value).drop("_all")
    blocked = cut(counts, keys, [value])
    weighted = F.col("n") * F.col(value)
    totals = blocked.groupBy(*keys, BLOCK).agg(F.sum("n").alias("_n"), F.sum(weighted).alias("_s"))
    group = W.partitionBy(*keys)
    earlier = group.orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    # Only groups at the border of two partitions have several blocks, which bounds what is left.
    edges = totals.select(
        *keys, BLOCK,
        F.sum("_n").over(earlier).alias("_offset"),
        F.sum("_n").over(group).alias("_group_n"),
        F.sum("_s").over(group).alias("_group_s"),
        F.count(F.lit(1)).over(group).alias("_blocks"),
    ).where("_blocks > 1").drop("_blocks")
    block = W.partitionBy(*keys, BLOCK)
    before = block.orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    inside = blocked.withColumns({
        "_below": F.sum("n").over(before),
        "_block_n": F.sum("n").over(block),
        "_block_s": F.sum(weighted).over(block),
    })
    none, total = F.lit(0), F.coalesce("_group_n", "_block_n")
    return join_edges(inside, edges, keys).select(
        *counts.columns,
        (F.coalesce("_below", none) + F.coalesce("_offset", none)).alias("_below"),
        total.alias("_total"),
        (F.coalesce("_group_s", "_block_s") / total).alias("_mean"),
    )


def with_nested_ranks(counts: DataFrame, keys: list[str], inner: list[str], value: str) -> DataFrame:
    """Ranks in two groupings from one set of blocks: ``_below`` and ``_total`` in the group ``keys``, and
    ``_inner_below``, ``_inner_total``, ``_inner_mean`` in the finer group ``inner``, which includes ``keys``.

    The rows are cut along (keys, value), so the parts of an inner group are in order too. Rows of
    one value in several inner groups share their ranks in no fixed order, which no percentile depends on.
    Both kinds of windows run on one exchange. Totals per (inner group, block) are joined, not broadcast by
    hint: their number is bounded by that of the groups and blocks together only.
    """
    blocked = cut(counts, keys, [value])
    weighted = F.col("n") * F.col(value)
    totals = blocked.groupBy(*inner, BLOCK).agg(F.sum("n").alias("_n"), F.sum(weighted).alias("_s"))
    group, part = W.partitionBy(*keys), W.partitionBy(*inner)
    earlier = totals.select(
        *[F.col(k).alias(f"_edge_{k}") for k in [*inner, BLOCK]],
        F.sum("_n").over(group.orderBy(BLOCK).rangeBetween(W.unboundedPreceding, -1)).alias("_offset"),
        F.sum("_n").over(group).alias("_total"),
        F.sum("_n").over(part.orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1))
        .alias("_inner_offset"),
        F.sum("_n").over(part).alias("_inner_total"),
        F.sum("_s").over(part).alias("_inner_s"),
    )
    joined = blocked.join(earlier, same_keys(blocked, earlier, [*inner, BLOCK], "_edge_"), "left")
    before = lambda by: W.partitionBy(*by, BLOCK).orderBy(value).rowsBetween(
        W.unboundedPreceding, -1)
    none = F.lit(0)
    ranked = joined.withColumns({
        "_below": F.coalesce(F.sum("n").over(before(keys)), none) + F.coalesce("_offset", none),
        "_inner_below": F.coalesce(F.sum("n").over(before(inner)), none) + F.coalesce(
            "_inner_offset", none)})
    return ranked.select(
        *counts.columns, "_below", "_total", "_inner_below", "_inner_total",
        (F.col("_inner_s") / F.col("_inner_total")).alias("_inner_mean"))


def percentile_at(value: str, p: float, ranks: str = "_") -> Column:
    """Aggregate over ranked counts: the value at rank p * (n - 1), linear between neighbours."""
    below, total = F.col(f"{ranks}below"), F.col(f"{ranks}total")
    position = (total - 1).cast("double") * F.lit(float(p))
    lower, upper = F.floor(position), F.ceil(position)

    def at(rank):
        holds = (below <= rank) & (rank < below + F.col("n"))
        return F.max(F.when(holds, F.col(value)))

    low, high, part = at(lower), at(upper), F.max(position - lower)
    return F.when(low == high, low).otherwise(low * (1.0 - part) + high * part)


def weighted_stddev(value: str, ranks: str = "_") -> Column:
    """Aggregate over ranked counts: sample standard deviation, NULL for one row."""
    n = F.sum("n")
    spread = F.sum(F.col("n") * F.pow(F.col(value) - F.col(f"{ranks}mean"), F.lit(2.0)))
    return F.when(n > 1, F.sqrt(spread / (n - 1)))


def weighted_mean(value: str, weight: str = "n") -> Column:
    """Aggregate over value counts: mean, NULL when the weights are all zero."""
    return F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight))
