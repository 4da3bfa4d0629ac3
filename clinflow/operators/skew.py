"""Windows over groups of any size.

A window needs all rows of a group in one task, and one group may hold a large share of all rows.
So windows run on blocks: rows are range-partitioned on group + order, and a block is the part of a
group in one partition. Ties in the group are cut along its order, and the number of partitions is
the session's shuffle setting, so a block's share of the rows shrinks as partitions are added. A
border between two partitions runs through one group at most; what such groups need from their
other blocks comes from a summary with at most two rows per partition. The plan is the same at every
size: nothing is counted beforehand and no row is dropped.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.operators.storage import materialize

BLOCK = "_block"


def cut(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows with a ``_block`` number that grows along keys + order, stored.

    Range bounds come from a sample. Storing the cut rows fixes them: every later step, and every
    task repeated after a lost executor, sees the same blocks.
    """
    ranged = df.repartitionByRange(*keys, *order)
    return materialize(ranged.withColumn(BLOCK, F.spark_partition_id()), "blocks")


def in_order(blocked: DataFrame, order: list[str]) -> DataFrame:
    """The rows in the order that ``cut`` gave the blocks: every block goes straight to the partition
    of its number and is sorted there, so no range bounds are sampled again."""
    parts = int(blocked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocked.repartitionById(parts, F.col(BLOCK)).sortWithinPartitions(BLOCK, *order)


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], prefix: str = "") -> Column:
    """NULL-safe key equality: a NULL key is a group like any other."""
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[prefix + k]) for k in keys])


def border_rows(blocked: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the groups that lie in several blocks.

    In every partition such a group is the first or the last one, so the first and last group per
    partition name them all. They are fewer than the partitions, which bounds the broadcast.
    """
    key = F.struct(*keys)
    ends = blocked.groupBy(BLOCK).agg(F.array_distinct(F.array(F.min(key), F.max(key))).alias("ends"))
    wide = ends.select(F.explode("ends").alias("_key")).groupBy("_key").count()
    wide = wide.where("count > 1").select(
        *[F.col("_key").getField(k).alias(f"_wide_{k}") for k in keys])
    return blocked.join(F.broadcast(wide), same_keys(blocked, wide, keys, "_wide_"), "left_semi")


def join_edges(blocked: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Attach the summary of the border groups; NULL for all other groups.

    The summary has at most two rows per partition, whatever the number of rows and groups.
    """
    joined = [*keys, BLOCK]
    renamed = F.broadcast(edges.withColumnsRenamed({k: f"_edge_key_{k}" for k in joined}))
    return blocked.join(renamed, same_keys(blocked, renamed, joined, "_edge_key_"), "left").drop(
        *[f"_edge_key_{k}" for k in joined])
