"""Writers. All of them overwrite, so a repeated run gives the same tables."""

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clinflow.schemas import TABLES

# An empty text is written as "" and a missing one as nothing: the defaults.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',  # quotes inside a field are doubled
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another, which goes last.

    Two renames; what a run that ended between them left behind is put back by the next one.
    """
    target, fresh = _at(spark, path), _at(spark, new)
    previous = _at(spark, path + ".previous")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(previous):
        if files.exists(target):
            files.delete(previous, True)
        else:
            files.rename(previous, target)
    if files.exists(target) and not files.rename(target, previous):
        raise OSError(f"cannot move {path}")
    if not files.rename(fresh, target):
        files.rename(previous, target)
        raise OSError(f"cannot move {new} to {path}")
    files.delete(previous, True)


def _at(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), bloom: Sequence[str] = ()
) -> int:
    """Full refresh of a folder; returns the row count, taken during the write (no second scan).

    The rows are written beside the folder and take its place when they are complete: a job that fails
    half-way leaves the old rows readable, and a plan may read the folder it refreshes.
    With ``partition_by`` the rows are first gathered per partition value, so that there are few
    files; adaptive execution cuts a large value into several tasks. Columns in ``bloom`` get bloom filters,
    with which a filter on one value skips row groups whatever the order of the rows.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    counted, seen = _counted(df)
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in bloom}
    counted.write.options(**blooms).partitionBy(*partition_by).parquet(beside)
    swap_in(df.sparkSession, beside, path.rstrip("/"))
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> int:
    """CSV folder with a header per file. ``single_file`` puts all rows in one file, through one
    task: only for small results such as the per-class statistics."""
    counted, seen = _counted(df)
    out = counted.coalesce(1) if single_file else counted
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return seen.get["rows"]


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read such a folder back. Quoted line breaks are part of a field; the null marker is a text
    that cannot occur, so that an empty text does not count as missing."""
    return spark.read.schema(schema).options(
        **CSV_OPTIONS, multiLine="true", nullValue="\u0000").csv(path)


def create_tables(
    spark: SparkSession, database: str = "default", tables: Mapping[str, StructType] = TABLES,
    root: str | None = None,
) -> None:
    """Create the star schema where it is absent. Keys are checked by the quality plans: Parquet
    tables take no constraints."""
    for name, schema in tables.items():
        where = f" LOCATION '{root}/{name}'" if root else ""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{where}")


def save_table(
    df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()
) -> int:
    """Full refresh of a catalog table; columns are matched by name when the table is known.

    Every refresh is a version: a folder of its own under the table's root. The catalog's location is the
    pointer and is switched when the version is complete, so a job that fails half-way leaves the table as it
    was, readers keep the version they began with, and an external table keeps its root. The root is ``path``,
    else that of the table as it stands, else a folder in the database's location. Older versions stay until
    ``drop_versions``. Partitioned tables are entered anew, because the catalog knows their folders.
    """
    spark = df.sparkSession
    known = spark.catalog.tableExists(name)
    schema = TABLES.get(name.split(".")[-1])
    if schema is not None:
        df = df.select(*schema.fieldNames())
    root = (path or _root(spark, name, known)).rstrip("/")
    version = f"{root}/{VERSION}{uuid.uuid4().hex}"
    counted, seen = _counted(df)
    counted.write.partitionBy(*partition_by).parquet(version)
    same = known and not partition_by and [
        (f.name, f.dataType) for f in spark.table(name).schema] == [
        (f.name, f.dataType) for f in df.schema]
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        by = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION '{version}'")
        if partition_by:
            spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return seen.get["rows"]


def save_bucketed(
    df: DataFrame, name: str, key: str, buckets: int = 64, path: str | None = None
) -> int:
    """Full refresh of a catalog table stored in buckets of ``key``: joins and aggregations on the key with
    tables of as many buckets need no shuffle.

    Refreshed by versions as in ``save_table``. The rows are dealt to the buckets once, at the write, where a key
    with many rows is split over several files of its bucket. A later join reads a bucket in one task,
    so take as many buckets as the largest table needs: about its size divided by 512 MB.
    """
    spark = df.sparkSession
    known = spark.catalog.tableExists(name)
    root = (path or _root(spark, name, known)).rstrip("/")
    version, beside = f"{root}/{VERSION}{uuid.uuid4().hex}", f"{name}_{uuid.uuid4().hex}"
    counted, seen = _counted(df.hint("rebalance", buckets, key))
    counted.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", version).saveAsTable(beside)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"DROP TABLE {beside}")  # its files stay, they are at a path
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{version}'")
    spark.catalog.refreshTable(name)
    return seen.get["rows"]


VERSION = "version-"


def location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _root(spark: SparkSession, name: str, known: bool) -> str:
    if known:
        place = location(spark, name)
        return place.rsplit(f"/{VERSION}", 1)[0] if f"/{VERSION}" in place else f"{place}-versions"
    database, _, table = name.rpartition(".")
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{home}/{table}-versions"


def drop_versions(spark: SparkSession, name: str) -> int:
    """Remove all versions of a table but the one it points to; returns how many went."""
    place = location(spark, name)
    if f"/{VERSION}" not in place:
        return 0
    root, current = place.rsplit("/", 1)
    files = _at(spark, root).getFileSystem(spark._jsc.hadoopConfiguration())
    old = [f.getPath() for f in files.listStatus(_at(spark, root))
           if f.getPath().getName().startswith(VERSION) and f.getPath().getName() != current]
    return sum(files.delete(p, True) for p in old)


def publish(df: DataFrame, name: str, materialized: str = "table", path: str | None = None) -> None:
    """``view`` keeps the plan and runs it on each use; ``table`` stores the rows."""
    if materialized == "view":
        df.createOrReplaceTempView(name)
    else:
        save_table(df, name, path)
