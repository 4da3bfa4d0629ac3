"""The four stages: ingest, load, models, export. Tables pass between stages as Parquet."""

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from clinflow.operators.storage import scratch_path
from clinflow.plans import models, quality, warehouse
from clinflow.plans.flatten import FLATTENERS
from clinflow.schemas import EXPORTS, FLAT, KEYS, LINKS, TABLES
from clinflow.sinks.writers import write_csv, write_parquet
from clinflow.sources.ndjson import split_ndjson
from clinflow.sources.tables import read_parquet_tables

log = logging.getLogger(__name__)

#: Columns that measures look single values up in.
LOOKUPS = {"dim_clinical_observations": ("loinc_code",)}


def ingest(spark: SparkSession, src: str, out: str) -> dict[str, int]:
    """NDJSON folder -> five flat tables under ``out``; returns row counts.

    Every line is parsed once (see ``split_ndjson``). Lines that did not parse are in no table: they are
    written to ``bad_lines/<resource>`` with their file, counted and logged.
    """
    counts = {}
    for table, (resource, flatten) in FLATTENERS.items():
        raw, bad = split_ndjson(spark, src, resource, scratch_path(spark, resource))
        counts[table] = write_parquet(flatten(raw), f"{out}/{table}")
        log.info("%s: %d rows", table, counts[table])
        lost = write_parquet(bad, f"{out}/bad_lines/{resource}")
        if lost:
            log.warning("%s: %d lines did not parse", resource, lost)
    return counts


def build(flat: Mapping[str, DataFrame], ranges: DataFrame | None = None, tz: str = "UTC") -> dict[str, DataFrame]:
    """Star schema as plans. ``ranges`` may be a stored range table; otherwise it is derived."""
    obs = flat["dim_observations"]
    patients = warehouse.build_patients(flat["dim_patients"])
    if ranges is None:
        ranges = warehouse.reference_ranges(obs)
    return {
        "dim_patients": patients,
        "dim_loinc_reference": ranges,
        "dim_diagnoses": warehouse.build_diagnoses(flat["dim_diagnoses"]),
        "dim_clinical_observations": warehouse.flag_abnormal(obs, ranges).select(
            *TABLES["dim_clinical_observations"].fieldNames()),
        "dim_episodes": warehouse.build_episodes(flat["dim_episodes"]),
        "fact_patient_encounters": warehouse.build_encounters(
            flat["fact_encounters"], patients, tz),
    }


def load(
    spark: SparkSession, parquet: str, out: str, tz: str = "UTC", fact_by_year: bool = False,
    on_violation: str = "report",
) -> dict[str, int]:
    """Flat tables -> star schema under ``out``. The ranges are stored first, so the flag joins a
    table of known size. ``fact_by_year`` partitions the fact by admission year: the year slicer
    then reads only the years it needs. ``on_violation`` is applied to the keys of each table, see
    ``quality.enforce_key``; ``quarantine`` writes the other rows to ``<table>_quarantine``."""
    flat = read_parquet_tables(spark, parquet, FLAT, FLAT)
    name = "dim_loinc_reference"
    counts = {name: write_parquet(
        warehouse.reference_ranges(flat["dim_observations"]), f"{out}/{name}")}
    ranges = read_parquet_tables(spark, out, [name])[name]
    for table, df in build(flat, ranges, tz).items():
        if table != name:
            if on_violation == "quarantine":
                df, bad = quality.split_by_key(df, KEYS[table])
                counts[f"{table}_quarantine"] = write_parquet(bad, f"{out}/{table}_quarantine")
            else:
                df = quality.enforce_key(df, KEYS[table], table, on_violation)
            by_year = fact_by_year and table == "fact_patient_encounters"
            counts[table] = write_parquet(
                df, f"{out}/{table}", ["admit_year"] if by_year else [], LOOKUPS.get(table, ()))
    return counts


def run_models(spark: SparkSession, root: str) -> dict[str, int]:
    """Star schema -> analytics tables, next to it. Staging stays a plan that each model inlines."""
    t = read_parquet_tables(spark, root, TABLES)
    stg = models.stg_encounters(t["fact_patient_encounters"])
    results = {
        "mart_los_kpis": models.los_kpis(stg),
        "analytics_readmissions": models.readmissions(stg),
        "analytics_throughput": models.throughput(t["dim_episodes"], stg),
        "analytics_lab_kpis": models.lab_kpis(t["dim_clinical_observations"]),
    }
    return {name: write_parquet(df, f"{root}/{name}") for name, df in results.items()}


def export(
    spark: SparkSession, root: str, out: str, names: Iterable[str] = EXPORTS,
    single_file: Iterable[str] = ("mart_los_kpis",),
) -> dict[str, int]:
    """Stored tables -> CSV folders for the dashboard; returns row counts. Tables named in
    ``single_file`` go through one task: the LOS mart has one row per encounter class."""
    tables = read_parquet_tables(spark, root, names)
    return {
        name: write_csv(df, f"{out}/{name}.csv", name in set(single_file))
        for name, df in tables.items()
    }


def validate(spark: SparkSession, root: str, with_models: bool = False) -> dict[str, DataFrame]:
    """Checks over the stored tables: links, coverage, keys, row counts. ``with_models`` includes
    the links of the analytics tables, which must have been built."""
    t = read_parquet_tables(spark, root, TABLES)
    children = {child for child, _, _ in LINKS} - set(t) if with_models else set()
    linked = {**t, **read_parquet_tables(spark, root, children)}
    return {
        "links": quality.foreign_key_checks(linked),
        "coverage": quality.link_coverage(
            t["dim_clinical_observations"], t["fact_patient_encounters"]),
        "keys": quality.key_checks(t),
        "counts": quality.table_counts(t),
    }


def run(spark: SparkSession, src: str, work: str) -> dict[str, dict]:
    """All stages under one working folder, and the checks at the end, a row per link or table."""
    done = {
        "ingest": ingest(spark, src, f"{work}/parquet"),
        "load": load(spark, f"{work}/parquet", f"{work}/warehouse"),
        "models": run_models(spark, f"{work}/warehouse"),
        "export": export(spark, f"{work}/warehouse", f"{work}/dashboard"),
    }
    checks = validate(spark, f"{work}/warehouse", with_models=True)
    done["checks"] = {k: [r.asDict() for r in df.collect()] for k, df in checks.items()}
    return done
