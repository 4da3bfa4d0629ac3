"""Named queries over the driver tables: one per operator, each reads its whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from clinflow import roles
from clinflow.functions import round_bin
from clinflow.operators import (
    add_history, dedup_first, materialize, merge_groups, percentile_at, scratch_path, star_join,
    value_counts, with_ranks,
)
from clinflow.operators import sketches
from clinflow.operators.skew import same_keys
from clinflow.plans import flatten, labcube, measures, models, quality, reports, warehouse
from clinflow.schemas import TABLES
from clinflow.sinks import writers
from clinflow.sources import corrupt_lines, read_ndjson, read_parquet_tables, row_count, split_ndjson

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _tidy(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC, so that results do not depend on the reader's zone."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def query(run: Query) -> Query:
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _tidy(run(spark, sf_dir))

    QUERIES[run.__name__.removesuffix("_query")] = wrapped
    return run


def _rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: round_bin(F.col(c), digits) for c in columns})


# Star-schema inputs

def _fact_events(spark, d):
    known = roles.table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("patient_id"))
    return warehouse.build_encounters(roles.encounters_from_events(spark, d), known)


def _fact_orders(spark, d):
    return warehouse.build_encounters(
        roles.encounters_from_orders(spark, d), roles.patients_from_customers(spark, d))


def _fact_known(spark, d):
    return warehouse.build_encounters(
        roles.encounters_from_orders(spark, d),
        roles.patients_from_customers(spark, d, known_only=True))


def _stg_events(spark, d):
    return models.stg_encounters(_fact_events(spark, d))


def _stg_orders(spark, d):
    return models.stg_encounters(_fact_orders(spark, d))


def _readmissions(spark, d, **options):
    """Staged rows are stored first: cutting them into blocks samples them and then reads them."""
    stg = materialize(_stg_orders(spark, d).select(*models.READMISSION_INPUT), "stg_encounters")
    return models.readmissions(stg, **options)


def _results(spark, d):
    """Results are stored first, as after the ingest: the range and lab plans read them often."""
    obs = roles.observations_from_lineitems(spark, d)
    return materialize(obs.select(*models.LAB_KEYS, "patient_id", "result_value"), "results")


def _cube(spark, d, patients=True):
    return labcube.value_cube(roles.observations_from_lineitems(spark, d), patients)


def _ranges(cube):
    """Stored as well, so the planner of the join to it knows its size."""
    return materialize(labcube.cohort_ranges(cube), "dim_loinc_reference")


def _flagged_results(spark, d):
    results = _results(spark, d)
    return warehouse.flag_abnormal(results, _ranges(labcube.value_cube(results, patients=False)))


def _throughput(spark, d):
    """Staged rows are stored first, as for the readmissions."""
    episodes = warehouse.build_episodes(roles.episodes_from_orders(spark, d))
    return models.throughput(episodes, materialize(_stg_orders(spark, d), "stg_encounters"))


# Scan and flatten

@query
def ndjson_flatten_encounter(spark, d):
    return flatten.flatten_encounters(
        read_ndjson(spark, roles.encounter_lines(spark, d), "Encounter"))


@query
def ndjson_flatten_patient(spark, d):
    return flatten.flatten_patients(read_ndjson(spark, roles.patient_lines(spark, d), "Patient"))


@query
def explode_conditions(spark, d):
    return flatten.flatten_conditions(
        read_ndjson(spark, roles.condition_lines(spark, d), "Condition"))


@query
def explode_filter_observations(spark, d):
    return flatten.flatten_observations(
        read_ndjson(spark, roles.observation_lines(spark, d), "Observation"))


@query
def flatten_episodes(spark, d):
    return flatten.flatten_episodes(
        read_ndjson(spark, roles.episode_lines(spark, d), "EpisodeOfCare"))


@query
def ndjson_line_counts(spark, d):
    return corrupt_lines(read_ndjson(spark, roles.encounter_lines(spark, d), "Encounter"))


@query
def bad_lines(spark, d):
    """Lines that did not parse, per file: kept aside by the pass that stores the others."""
    bad = split_ndjson(
        spark, roles.encounter_lines(spark, d), "Encounter", scratch_path(spark, "Encounter"))[1]
    folder = F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)
    return bad.groupBy(folder.alias("file")).agg(
        F.count(F.lit(1)).alias("lines"), F.max(F.char_length("line")).alias("longest"))


@query
def dedup_first_query(spark, d):
    return dedup_first(
        roles.observations_from_lineitems(spark, d), ["observation_id", "loinc_code"])


# Star schema

@query
def fact_encounters(spark, d):
    return _fact_known(spark, d)


@query
def episode_los(spark, d):
    return warehouse.build_episodes(roles.episodes_from_orders(spark, d))


@query
def reference_ranges(spark, d):
    return labcube.cohort_ranges(_cube(spark, d, patients=False))


@query
def reference_ranges_by_unit(spark, d):
    return warehouse.reference_ranges(
        roles.observations_from_lineitems(spark, d), by=("loinc_code", "result_unit"))


@query
def flag_abnormal(spark, d):
    ranges = _ranges(_cube(spark, d, patients=False))
    return warehouse.flag_abnormal(roles.observations_from_lineitems(spark, d), ranges)


@query
def fill_readmissions(spark, d):
    return warehouse.fill_readmissions(_fact_orders(spark, d), _readmissions(spark, d)).select(
        "encounter_id", "patient_id", "is_readmission_30d", "days_since_last_enc")


# Models

@query
def stg_encounters(spark, d):
    flat = roles.encounters_from_shipping(spark, d)
    return models.stg_encounters(
        warehouse.build_encounters(flat, roles.patients_from_customers(spark, d)))


@query
def los_kpis(spark, d):
    return models.los_kpis(_stg_events(spark, d))


#: Twice the bound that a sketch keeps with 99 % probability.
_RANK_ERROR = 2 * sketches.rank_error()


def _percentiles_in_bound(found, rows, keys, value, at, digits, error=1e-4):
    """Replace sketched percentiles by flags: is the rank of the value within the sketch's error, a part of
    the rows (and one row), of the wanted rank? Half a unit of the last digit allows for its rounding."""
    half, x = F.lit(0.51 * 10 ** -digits), F.col(value)
    sketched = found.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *at)
    met = rows.where(x.isNotNull()).join(sketched, same_keys(rows, sketched, keys, "_of_"))
    n = F.count(F.lit(1))
    flags = met.groupBy(*keys).agg(*[
        ((F.count_if(x < F.col(c) - half) <= n * F.lit(p) + n * F.lit(error) + 1)
         & (F.count_if(x <= F.col(c) + half) >= n * F.lit(p) - n * F.lit(error) - 1)).alias(f"{c}_in_bound")
        for c, p in at.items()])
    return merge_groups(keys, found.drop(*at), flags)


@query
def los_kpis_approx(spark, d):
    stg = materialize(_stg_events(spark, d), "stg_encounters")
    n = F.col("encounter_count")
    found = models.los_kpis(stg, approx=True).withColumn(
        "long_stay_outlier_count_in_bound",
        F.col("long_stay_outlier_count") <= n * F.lit(0.1) + n * F.lit(2 * _RANK_ERROR) + 1)
    return _percentiles_in_bound(
        found.drop("long_stay_outlier_count"), stg, ["encounter_class", "encounter_class_label"],
        "los_hours", {"median_los_hours": 0.5, "p25_los_hours": 0.25, "p75_los_hours": 0.75,
                      "p90_los_hours": 0.9}, 2, _RANK_ERROR)


@query
def los_from_yearly_sketches(spark, d):
    """Sketches stored per year, merged at read; each sketched value is checked against its bound."""
    stg = materialize(_stg_events(spark, d), "stg_encounters")
    stored = materialize(models.los_sketches(stg), "los_sketches")
    keys = ["encounter_class", "encounter_class_label"]
    found = models.los_from_sketches(stored)
    patients = stg.select(*keys, "patient_id").distinct().groupBy(*keys).agg(
        F.count("patient_id").alias("_patients"))
    close = F.abs(F.col("patient_count") - F.col("_patients")) <= (
        F.col("_patients") * F.lit(4 * sketches.distinct_error()) + 1)
    n = F.col("encounter_count")
    found = merge_groups(keys, found, patients).withColumns({
        "patient_count_in_bound": close,
        "long_stays_in_bound": F.abs(F.col("long_stays") - n * F.lit(0.1))
        <= n * F.lit(2 * _RANK_ERROR) + 1}).drop("patient_count", "_patients", "long_stays")
    return _percentiles_in_bound(
        found, stg, keys, "los_hours", {"median_los_hours": 0.5, "p90_los_hours": 0.9}, 2, _RANK_ERROR)


@query
def readmissions(spark, d):
    return _readmissions(spark, d)


@query
def readmissions_events(spark, d):
    """Long overlapping histories: a few users hold all rows."""
    stg = _stg_events(spark, d).select(*models.READMISSION_INPUT)
    return models.readmissions(materialize(stg, "stg_encounters"))


@query
def readmissions_all_classes(spark, d):
    return _readmissions(
        spark, d, classes=("IMP", "EMER", "AMB", "HH"), window_days=60, buckets=(14, 60)).select(
            "encounter_id", "prev_encounter_id", "is_60d_readmission", "readmission_type")


@query
def episode_throughput(spark, d):
    return _throughput(spark, d)


@query
def lab_kpis(spark, d):
    return labcube.lab_kpis(_cube(spark, d))


@query
def lab_kpis_approx(spark, d):
    results = materialize(_flagged_results(spark, d), "flagged_results")
    found = models.lab_kpis(results, approx=True)
    patients = results.where("result_value IS NOT NULL").groupBy(*models.LAB_KEYS).agg(
        F.count_distinct("patient_id").alias("_patients"))
    # Three times the relative deviation of the distinct count's sketch, 0.05.
    close = F.abs(F.col("patient_count") - F.col("_patients")) <= F.col("_patients") * 0.15 + 1
    found = merge_groups(models.LAB_KEYS, found, patients).withColumn(
        "patient_count_in_bound", close).drop("patient_count", "_patients")
    return _percentiles_in_bound(
        found, results, models.LAB_KEYS, "result_value",
        {"median_value": 0.5, "p2_5": 0.025, "p97_5": 0.975}, 3)


@query
def lab_kpis_with_ranges(spark, d):
    return labcube.lab_kpis(_cube(spark, d), with_ranges=True).select(
        *models.LAB_KEYS, "total_observations", "abnormal_count", "normal_low", "normal_high")


# Few groups, so that each of them lies in several blocks

@query
def history_in_blocks(spark, d):
    stays = roles.encounters_from_events(spark, d).select(
        "service_provider", "admit_timestamp", "discharge_timestamp", "encounter_id")
    return add_history(
        materialize(stays, "stays"), ["service_provider"], ["admit_timestamp", "encounter_id"],
        prev={"prev_encounter_id": "encounter_id", "prev_discharge": "discharge_timestamp"},
        following={"next_encounter_id": "encounter_id"},
        seq="seq", total="total")


@query
def percentiles_in_blocks(spark, d):
    items = roles.table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice")
    counts = value_counts(items, ["l_returnflag"], "l_extendedprice")
    ranked = with_ranks(counts, ["l_returnflag"], "l_extendedprice")
    return _rounded(
        ranked.groupBy("l_returnflag").agg(
            F.sum("n").alias("n"),
            percentile_at("l_extendedprice", 0.025).alias("p2_5"),
            percentile_at("l_extendedprice", 0.5).alias("p50"),
            percentile_at("l_extendedprice", 0.975).alias("p97_5")),
        "p2_5", "p50", "p97_5")


# Quality

@query
def orphan_encounters(spark, d):
    return quality.referential_check(
        roles.encounters_from_orders(spark, d),
        roles.patients_from_customers(spark, d, known_only=True), "patient_id", "encounter patients")


@query
def linked_observations(spark, d):
    """Only the links are read: two scans, and counts per encounter meet in one join."""
    return quality.link_coverage(
        roles.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("encounter_id")),
        roles.table(spark, d, "orders").select(F.col("o_orderkey").alias("encounter_id")))


@query
def linked_by_class(spark, d):
    """Results of each encounter class, from tables stored in buckets of the encounter: the rows meet
    bucket by bucket, nothing is shuffled for the join."""
    root = scratch_path(spark, "bucketed")
    database = "clinflow_" + root.split("/")[-2][:12]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    writers.save_bucketed(_fact_orders(spark, d).select(
        "encounter_id", "encounter_class"), f"{database}.encounters", "encounter_id")
    writers.save_bucketed(roles.table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("encounter_id"), F.col("l_quantity").alias("result_value")),
        f"{database}.results", "encounter_id")
    found = quality.linked_rows(
        spark.table(f"{database}.results"), spark.table(f"{database}.encounters"))
    result = materialize(found.groupBy("encounter_class").agg(
        F.count(F.lit(1)).alias("results"), F.sum("result_value").alias("total_value")), "linked")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return result


@query
def key_violations(spark, d):
    return quality.key_checks({
        "dim_clinical_observations": roles.observations_from_lineitems(spark, d),
        "fact_patient_encounters": roles.encounters_from_orders(spark, d),
        "dim_episodes": roles.episodes_from_orders(spark, d),
    })


@query
def key_quarantine(spark, d):
    obs = roles.observations_from_lineitems(spark, d)
    return quality.split_by_key(obs, ["observation_id", "loinc_code"])[1].select(
        "observation_id", "loinc_code", "result_value")


@query
def foreign_keys(spark, d):
    return quality.foreign_key_checks({
        "dim_patients": roles.patients_from_customers(spark, d, known_only=True),
        "fact_patient_encounters": roles.encounters_from_orders(spark, d),
        "dim_clinical_observations": roles.observations_from_lineitems(spark, d),
    })


@query
def table_counts(spark, d):
    return quality.table_counts({
        "fact_encounters": roles.encounters_from_events(spark, d),
        "dim_patients": roles.patients_from_customers(spark, d),
        "dim_episodes": roles.episodes_from_orders(spark, d),
    })


@query
def star_join_query(spark, d):
    joined = star_join(
        roles.encounters_from_orders(spark, d),
        roles.patients_from_customers(spark, d, known_only=True),
        "patient_id", ["marital_status", "state"], prefix="patient_")
    return joined.groupBy("patient_marital_status", "patient_state").agg(
        F.count(F.lit(1)).alias("encounters"), F.sum("los_hours").alias("los_hours"))


# Measures

@query
def core_kpis(spark, d):
    return _rounded(
        measures.core_kpis(_fact_orders(spark, d)), "avg_los_hours", "avg_los_days",
        "median_los_hours")


@query
def core_kpis_by_class(spark, d):
    return _rounded(
        measures.core_kpis(_fact_events(spark, d), ["encounter_class"]), "avg_los_hours",
        "avg_los_days", "median_los_hours")


@query
def los_by_class_measures(spark, d):
    return _rounded(
        measures.los_by_class(_fact_events(spark, d), ["service_provider"]),
        "avg_los_inpatient", "avg_los_emergency", "avg_los_home_health")


@query
def los_outliers_global(spark, d):
    return _rounded(measures.long_stay_outliers(_fact_events(spark, d)), "los_p90")


@query
def los_outliers_by_provider(spark, d):
    return _rounded(
        measures.long_stay_outliers(_fact_events(spark, d), ["service_provider"]), "los_p90")


@query
def avg_days_to_readmission(spark, d):
    return _rounded(
        measures.avg_days_to_readmission(_readmissions(spark, d), ["encounter_class"]),
        "avg_days_to_readmission")


@query
def readmission_rate(spark, d):
    found = _readmissions(spark, d)
    return _rounded(
        measures.readmission_rate_30d(found, ["service_provider"], index_classes=["IMP"]),
        "readmission_rate_30d_pct")


@query
def readmission_windows(spark, d):
    """Four windows from one history."""
    return _rounded(
        measures.readmission_windows(_readmissions(spark, d), by=["encounter_class"]),
        "readmission_rate_pct", "avg_days_to_readmission")


@query
def peak_hours(spark, d):
    return measures.peak_hours(_fact_events(spark, d))


@query
def peak_hour_top1(spark, d):
    return measures.busiest(_fact_events(spark, d), "admit_hour", "admissions")


@query
def weekend_night_share(spark, d):
    stg = _stg_events(spark, d)
    both = measures.merge_groups(
        ["encounter_class"], measures.weekend_share(stg, ["encounter_class"]),
        measures.night_share(stg, ["encounter_class"]))
    return _rounded(both, "weekend_admissions_pct", "night_admissions_pct")


@query
def abnormal_rate(spark, d):
    return _rounded(
        labcube.abnormal_rate(_cube(spark, d, patients=False), ["obs_category"]), "abnormal_rate_pct")


@query
def avg_result_for_code(spark, d):
    obs = roles.observations_from_lineitems(spark, d)
    return _rounded(measures.avg_result(obs, "Brand#7", ["result_unit"]), "avg_result")


# Report datasets

@query
def avg_los_by_class(spark, d):
    return reports.avg_los_by_class(models.los_kpis(_stg_events(spark, d)), ["IMP", "EMER"])


@query
def los_tier_unpivot(spark, d):
    return reports.los_tier_distribution(models.los_kpis(_stg_events(spark, d)))


@query
def los_weekend_split(spark, d):
    return reports.los_weekend_split(models.los_kpis(_stg_events(spark, d)))


@query
def readmission_rate_by_year_class(spark, d):
    return _rounded(
        reports.readmission_rate_by_year_class(
            _readmissions(spark, d), classes=["IMP", "AMB"], years=(1996, 2000)),
        "readmission_rate_30d_pct")


@query
def readmission_type_breakdown(spark, d):
    return reports.readmission_type_breakdown(_readmissions(spark, d))


@query
def readmission_type_wide(spark, d):
    return reports.readmission_type_wide(_readmissions(spark, d))


@query
def patient_sequence(spark, d):
    return reports.patient_sequence(_readmissions(spark, d, ordered_output=True), in_order=True)


@query
def monthly_volume(spark, d):
    return reports.monthly_volume(_fact_orders(spark, d))


@query
def hourly_admissions(spark, d):
    return reports.hourly_admissions(
        _fact_events(spark, d), bands={"red": 430, "amber": 410})


@query
def gantt_feed(spark, d):
    return reports.gantt_feed(_throughput(spark, d))


@query
def top_codes(spark, d):
    return reports.top_codes(labcube.lab_kpis(_cube(spark, d)), 15)


@query
def lab_kpis_by_volume(spark, d):
    """The stored table has no order; readers ask for it."""
    kpis = materialize(labcube.lab_kpis(_cube(spark, d)), "analytics_lab_kpis")
    return models.by_volume(kpis).select(*models.LAB_KEYS, "total_observations")


@query
def lab_page_tables(spark, d):
    kpis = materialize(labcube.lab_kpis(_cube(spark, d)), "analytics_lab_kpis")
    return reports.lab_stats(kpis).join(
        reports.mean_vs_p97_5(kpis).groupBy("loinc_code").agg(F.max("p97_5").alias("code_p97_5")),
        "loinc_code")


@query
def provider_comparison(spark, d):
    return _rounded(reports.provider_comparison(_fact_orders(spark, d)), "avg_los_hours")


@query
def page_cards(spark, d):
    fact = materialize(_fact_events(spark, d), "fact_patient_encounters")
    stg = models.stg_encounters(fact)
    cards = measures.merge_groups(
        [], reports.los_cards(fact), reports.readmission_cards(models.readmissions(stg)),
        reports.throughput_cards(fact),
        reports.provider_cards(fact).withColumnRenamed("encounters", "provider_encounters"),
        labcube.lab_cards(_cube(spark, d, patients=False), "Brand#7"))
    doubles = [f.name for f in cards.schema.fields if f.dataType.typeName() == "double"]
    return _rounded(cards, *doubles)


# Sinks

@query
def written_counts(spark, d):
    """Rows counted during the write beside those the stored files' footers tell."""
    root = scratch_path(spark, "star").rsplit("/", 1)[0]
    tables = {"dim_patients": roles.patients_from_customers(spark, d),
              "dim_episodes": warehouse.build_episodes(roles.episodes_from_orders(spark, d)),
              "fact_patient_encounters": _fact_events(spark, d)}
    found = [(name, writers.write_parquet(df, f"{root}/{name}"), row_count(spark, f"{root}/{name}"))
             for name, df in tables.items()]
    return spark.createDataFrame(found, "`table` string, written bigint, stored bigint")


@query
def parquet_roundtrip(spark, d):
    path = scratch_path(spark, "fact_patient_encounters")
    writers.write_parquet(_fact_events(spark, d), path, partition_by=["admit_year"])
    stored = read_parquet_tables(spark, path.rsplit("/", 1)[0], ["fact_patient_encounters"])
    return stored["fact_patient_encounters"].select(
        *[c for c in TABLES["fact_patient_encounters"].fieldNames() if c != "days_since_last_enc"])


@query
def csv_roundtrip(spark, d):
    path = scratch_path(spark, "dim_episodes.csv")
    writers.write_csv(warehouse.build_episodes(roles.episodes_from_orders(spark, d)), path)
    return writers.read_csv(spark, path, TABLES["dim_episodes"])


@query
def table_roundtrip(spark, d):
    """Created empty, loaded in full, read by name; the view keeps its plan."""
    root = scratch_path(spark, "tables")
    database = "clinflow_" + root.split("/")[-2][:12]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    writers.create_tables(spark, database, {"dim_diagnoses": TABLES["dim_diagnoses"]})
    conditions = flatten.flatten_conditions(
        read_ndjson(spark, roles.condition_lines(spark, d), "Condition"))
    writers.save_table(warehouse.build_diagnoses(conditions), f"{database}.dim_diagnoses")
    view = database + "_resolved"
    writers.publish(
        spark.table(f"{database}.dim_diagnoses").filter("is_resolved"), view, "view")
    counts = spark.table(view).groupBy("coding_system", "clinical_status").agg(
        F.count(F.lit(1)).alias("conditions"),
        F.count("abatement_date").alias("with_date"))
    result = materialize(counts, "resolved_conditions")
    spark.catalog.dropTempView(view)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return result
