"""Scan of nested resources, one JSON object per line."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clinflow.schemas import CORRUPT, RESOURCES


def read_ndjson(spark: SparkSession, src: str, resource: str) -> DataFrame:
    """All shards ``<resource>_*.ndjson`` of a folder, or a path / list of paths given as ``src``.

    The schema is explicit: no inference job, fields absent everywhere become NULL, and a line
    that cannot be parsed is kept in ``_corrupt_record``.
    """
    schema = StructType([*RESOURCES[resource].fields, StructField(CORRUPT, StringType())])
    paths = src
    if isinstance(src, str) and not src.endswith((".ndjson", ".json")):
        paths = f"{src}/{resource}_*.ndjson*"
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(paths)
    )


def parsed(raw: DataFrame) -> DataFrame:
    """The rows of lines that parsed, without the column of the others."""
    return raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in raw.columns else raw


def split_ndjson(
    spark: SparkSession, src: str, resource: str, path: str
) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, lines that did not parse), both stored under ``path`` by one pass over the input.

    The lines are parsed once and written to one partition or the other; whatever reads the rows more
    than once reads them as Parquet. A bad line is kept as it stands, with the file it came from. A line
    counts as bad, too, when a field has a value of another type than declared.
    """
    raw = read_ndjson(spark, src, resource)
    bad = F.col(CORRUPT).isNotNull()
    staged = raw.select(
        "*", F.when(bad, F.col("_metadata.file_path")).alias("_file"), (~bad).alias("_parsed"))
    staged.write.mode("overwrite").partitionBy("_parsed").parquet(path)
    both = spark.read.schema(staged.schema).parquet(path)
    fields = [c for c in raw.columns if c != CORRUPT]
    return both.where("_parsed").select(*fields), both.where("NOT _parsed").select(
        F.col("_file").alias("file"), F.col(CORRUPT).alias("line"))


def corrupt_lines(raw: DataFrame) -> DataFrame:
    """One row: number of lines, of lines that did not parse, and of lines that fill each field.

    The parser only looks at requested fields, so every field is counted: a value of the wrong
    type is then found in any of them.
    """
    fields = [c for c in raw.columns if c != CORRUPT]
    return raw.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count(F.col(CORRUPT)).alias("n_corrupt"),
        *[F.count(F.col(c)).alias(f"n_{c}") for c in fields],
    )
