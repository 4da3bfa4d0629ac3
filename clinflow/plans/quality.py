"""Data-quality checks. Each returns a DataFrame; nothing is raised unless asked for."""

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.schemas import KEYS, LINKS

log = logging.getLogger(__name__)


def orphan_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent. A NULL key never has one."""
    return child.join(parent.select(key), key, "left_anti")


def referential_check(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """One row (check, violations, status). Child rows are counted per key before the join, so a
    frequent key costs one row."""
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    missing = orphan_rows(per_key, parent, key)
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(
        F.lit(name).alias("check"),
        "violations",
        F.when(F.col("violations") == 0, "OK").otherwise("WARN").alias("status"),
    )


def foreign_key_checks(tables: Mapping[str, DataFrame], links=LINKS) -> DataFrame:
    """One row per declared link whose two tables are given."""
    checks = [
        referential_check(tables[child], tables[parent], key, f"{child}.{key} -> {parent}")
        for child, parent, key in links if child in tables and parent in tables
    ]
    return reduce(DataFrame.unionByName, checks)


def link_coverage(obs: DataFrame, fact: DataFrame) -> DataFrame:
    """Number of joined rows of observations and encounters, from counts per encounter: the
    joined rows themselves are never built."""
    left = obs.groupBy("encounter_id").agg(F.count(F.lit(1)).alias("_o"))
    right = fact.groupBy("encounter_id").agg(F.count(F.lit(1)).alias("_f"))
    joined = left.join(right, "encounter_id")
    return joined.agg(
        F.coalesce(F.sum(F.col("_o") * F.col("_f")), F.lit(0)).alias("linked_observations"))


def linked_rows(child: DataFrame, parent: DataFrame, key: str = "encounter_id") -> DataFrame:
    """Child rows with the columns of their parent; rows without one are left out. Tables stored
    by ``save_bucketed`` on the key meet bucket by bucket, whatever their sizes."""
    return child.join(parent.hint("merge"), key)


def key_check(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One row (table, duplicate_keys, surplus_rows, null_key_rows)."""
    null_part = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    copies = ~null_part & (F.col("_n") > 1)
    return per_key.agg(
        F.count_if(copies).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(copies, F.col("_n") - 1)), F.lit(0)).alias("surplus_rows"),
        F.coalesce(F.sum(F.when(null_part, F.col("_n"))), F.lit(0)).alias("null_key_rows"),
    ).select(F.lit(name).alias("table"), "duplicate_keys", "surplus_rows", "null_key_rows")


def key_checks(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] = KEYS) -> DataFrame:
    checks = [key_check(tables[t], keys[t], t) for t in keys if t in tables]
    return reduce(DataFrame.unionByName, checks)


def split_by_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy the key, quarantined rows). All copies of a duplicated key go to the
    second frame, and so do rows with a NULL key part."""
    null_part = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    filled = df.filter(~null_part)
    repeated = filled.groupBy(*keys).count().filter("count > 1").select(*keys)
    bad = filled.join(repeated, list(keys), "left_semi").unionByName(df.filter(null_part))
    return filled.join(repeated, list(keys), "left_anti"), bad.select(*df.columns)


def enforce_key(
    df: DataFrame, keys: Sequence[str], name: str, on_violation: str = "report"
) -> DataFrame:
    """``report`` logs violations and returns the table as it is, ``quarantine`` returns the rows that
    satisfy the key (``split_by_key`` has the others too), ``fail`` raises when there is any violation."""
    if on_violation == "quarantine":
        return split_by_key(df, keys)[0]
    found = key_check(df, keys, name).first()
    if found["duplicate_keys"] or found["null_key_rows"]:
        text = f"key {list(keys)} of {name} is violated: {found.asDict()}"
        if on_violation == "fail":
            raise ValueError(text)
        log.warning(text)
    return df


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row (table, row_count) per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table"), "row_count")
        for t, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
