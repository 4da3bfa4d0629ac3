"""Joins and merges shared by the plans."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def star_join(
    child: DataFrame, parent: DataFrame, key: str, columns: Sequence[str], prefix: str = ""
) -> DataFrame:
    """Many-to-one left join that brings the needed parent columns.

    No broadcast hint: the planner broadcasts the parent when its size allows, and adaptive
    execution splits a skewed child partition otherwise.
    """
    needed = parent.select(key, *[F.col(c).alias(prefix + c) for c in columns])
    return child.join(needed, key, "left")


def merge_groups(keys: Sequence[str], *frames: DataFrame) -> DataFrame:
    """Bring aggregates of the same groups together, one row per group.

    Each frame holds different measures of the groups. A union and one more aggregation, so NULL
    keys match and no join (or cross join, for a grand total) is needed.
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    measures = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in measures])


def slice_rows(
    df: DataFrame, classes: Sequence[str] | None = None, years: tuple[int, int] | None = None
) -> DataFrame:
    """Dashboard slicers: encounter classes and a range of admission years, both included."""
    if classes is not None:
        df = df.filter(F.col("encounter_class").isin(list(classes)))
    if years is not None:
        df = df.filter(F.col("admit_year").between(*years))
    return df
