"""Mergeable statistics: counts, moments, and sketches of quantiles (KLL) and distinct values (HLL).

A sketch table has one row per group and part (a year, a load); it is stored, added to part by part, and
merged at read for any set of parts. Its size depends on the number of groups and parts alone.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameters of the two sketches; from them follow the bounds below.
KLL_K, HLL_LG = 4096, 14
_STATS = ["n", "total", "mean", "m2", "least", "largest", "value_sketch"]


def rank_error(k: int = KLL_K) -> float:
    """Bound of the normalized rank error of a KLL sketch, met with 99 % probability."""
    return 2.296 / k ** 0.9021


def distinct_error(lg: int = HLL_LG) -> float:
    """Relative standard error of an HLL estimate."""
    return 1.04 / 2 ** (lg / 2)


def sketch(
    df: DataFrame, keys: Sequence[str], value: str, distinct: str | None = None, k: int = KLL_K,
    lg: int = HLL_LG,
) -> DataFrame:
    """One row per group: n, total, mean, m2 (squared deviations), least, largest of the non-NULL values,
    with their sketch, and a sketch of the distinct values of another column. One pass; tasks send
    sketches, not values. Groups without a value keep a row, with a NULL sketch."""
    x = F.col(value)
    parts = {
        "n": F.count(x), "total": F.sum(x), "mean": F.avg(x), "m2": F.var_pop(x) * F.count(x),
        "least": F.min(x), "largest": F.max(x), "value_sketch": F.kll_sketch_agg_double(x, k)}
    if distinct:
        parts["distinct_sketch"] = F.hll_sketch_agg(distinct, lg)
    out = df.groupBy(*keys).agg(*[c.alias(name) for name, c in parts.items()])
    return out.withColumn("value_sketch", F.when(F.col("n") > 0, F.col("value_sketch")))


def merge(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same columns for coarser groups, from the sketch rows alone."""
    n = F.sum("n")
    mean = F.try_divide(F.sum("total"), n)
    parts = {
        "n": n, "total": F.sum("total"), "mean": mean,
        "m2": F.sum(F.col("m2") + F.col("n") * F.pow("mean", F.lit(2.0))) - n * F.pow(mean, F.lit(2.0)),
        "least": F.min("least"), "largest": F.max("largest"),
        "value_sketch": F.kll_merge_agg_double("value_sketch")}
    if "distinct_sketch" in sketches.columns:
        parts["distinct_sketch"] = F.hll_union_agg("distinct_sketch")
    out = sketches.groupBy(*keys).agg(*[c.alias(name) for name, c in parts.items()])
    return out.withColumn("value_sketch", F.when(F.col("n") > 0, F.col("value_sketch")))


def quantile(p: float, column: str = "value_sketch") -> Column:
    return F.kll_sketch_get_quantile_double(column, F.lit(float(p)))


def above(bound: Column, column: str = "value_sketch", steps: int = 2000) -> Column:
    """Estimated number of values above ``bound``, a column: the share of evenly spaced ranks whose value
    is above it, so half a step is added to the sketch's own error."""
    ranks = F.lit([(i + 0.5) / steps for i in range(steps)])
    higher = F.filter(F.kll_sketch_get_quantile_double(column, ranks), lambda v: v > bound)
    return F.round(F.size(higher) / steps * F.kll_sketch_get_n_double(column)).cast("bigint")


def stddev() -> Column:
    return F.when(F.col("n") > 1, F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / (F.col("n") - 1)))


def distinct_count(column: str = "distinct_sketch") -> Column:
    return F.hll_sketch_estimate(column)
