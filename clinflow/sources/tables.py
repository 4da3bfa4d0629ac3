"""Scan of stored tables."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from clinflow.schemas import TABLES


def read_parquet_tables(
    spark: SparkSession, root: str, names: Iterable[str],
    schemas: Mapping[str, StructType] = TABLES,
) -> dict[str, DataFrame]:
    """``{name: scan of root/name}``, with the declared schema where there is one: no job reads
    the footers, and a partition column stands at its declared place."""
    out = {}
    for name in names:
        path = f"{root}/{name}"
        if name in schemas:
            schema = schemas[name]
            out[name] = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
        else:
            out[name] = spark.read.parquet(path)
    return out


def row_count(spark: SparkSession, path: str) -> int:
    """Row count of a stored table; an empty projection, so only Parquet footers are read."""
    return spark.read.parquet(path).count()
