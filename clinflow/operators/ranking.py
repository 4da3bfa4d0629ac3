"""Top rows by a measure."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, measure: str, k: int, ties: list[str]) -> DataFrame:
    """The k rows with the largest measure. Each task keeps k rows; there is no full sort."""
    return df.orderBy(F.desc(measure), *[F.asc_nulls_last(c) for c in ties]).limit(k)
