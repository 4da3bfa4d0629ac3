"""Array expansion and de-duplication."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinflow.operators.storage import materialize

_KEY = "_key_hash"


def explode_entries(df: DataFrame, array: Column, entry: str, pos: str = "_pos") -> DataFrame:
    """One row per array element with its position; rows with an empty or NULL array are kept."""
    return df.select("*", F.posexplode_outer(array).alias(pos, entry))


def repeated_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """64-bit hashes of the keys that more than one row has; NULL is a key like any other.

    A hash aggregate of one number per row: copies are combined before the shuffle, which carries no
    row and no text, and a key with a third of all rows costs one entry per map task.
    """
    return df.groupBy(F.xxhash64(*keys).alias(_KEY)).agg(
        F.count(F.lit(1)).alias("_copies")).where("_copies > 1").select(_KEY)


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order_by``, ties broken by the other columns.

    Rows whose key occurs once, nearly all, pass as they are: they are neither sorted nor shuffled. The
    hashes of repeated keys are stored, so the planner knows their size when it joins them. Only rows
    with such a hash are put in order, key by key, and every task keeps the first of each key before
    they are shuffled. Two keys of one hash only make both take that way. The survivor does not depend
    on the partitioning.
    """
    keys = list(keys)
    rest = [*order_by, *[c for c in df.columns if c not in keys and c not in order_by]]
    if not rest:
        return df.distinct()
    repeated = materialize(repeated_hashes(df, keys), "repeated_keys")
    match = F.xxhash64(*[df[k] for k in keys]) == repeated[_KEY]
    first = F.row_number().over(W.partitionBy(*keys).orderBy(*rest))
    copies = df.join(repeated, match, "left_semi").withColumn("_row", first).where("_row = 1")
    return df.join(repeated, match, "left_anti").unionByName(copies.select(*df.columns))
