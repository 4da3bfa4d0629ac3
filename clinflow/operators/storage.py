"""Intermediate tables in the shared folder of the cluster."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only for a local session that sets none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "unknown").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="clinflow-"))
    return _local_root[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path per call, so runs never overwrite each other."""
    return f"{scratch_root(spark)}/clinflow/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts lineage (a lost executor does not recompute what is above), fixes values that come
    from sampling, and gives the planner the real size for its broadcast decision.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
