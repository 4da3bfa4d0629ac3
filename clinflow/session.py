"""Session with the settings the plans rely on. Sizes and core counts are left to the cluster."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Run-time planning: merges small shuffle partitions, splits skewed ones, and turns joins into
    # broadcasts by measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Timestamps with statistics, so that range filters skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def session(app_name: str = "clinflow", master: str | None = None, **extra: str) -> SparkSession:
    """``extra`` takes settings with dots written as two underscores."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
