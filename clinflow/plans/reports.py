"""Datasets behind the dashboard pages. ``classes`` and ``years`` are the page slicers."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.functions import month_start
from clinflow.operators.combine import merge_groups, slice_rows
from clinflow.operators.ranking import top_k
from clinflow.plans import measures as M
from clinflow.plans.models import TIER_COLUMNS

Classes = Sequence[str] | None
Years = tuple[int, int] | None

# Admission years offered by the year slicer.
YEARS = (2010, 2023)

# An hour with more admissions than this is marked, the highest mark first.
HOUR_BANDS = {"red": 600, "amber": 400}


# Page: length of stay

def avg_los_by_class(mart: DataFrame, classes: Classes = None) -> DataFrame:
    return slice_rows(mart, classes).select(
        "encounter_class", "encounter_class_label", "avg_los_hours")


def los_tier_distribution(mart: DataFrame, classes: Classes = None) -> DataFrame:
    long = slice_rows(mart, classes).unpivot(
        ["encounter_class", "encounter_class_label"], list(TIER_COLUMNS), "los_tier", "encounters")
    return long.replace(TIER_COLUMNS, subset=["los_tier"])


def los_weekend_split(mart: DataFrame, classes: Classes = None) -> DataFrame:
    return slice_rows(mart, classes).select(
        "encounter_class", "encounter_class_label", "avg_los_weekday", "avg_los_weekend")


def los_cards(fact: DataFrame, classes: Classes = None, years: Years = None) -> DataFrame:
    rows = slice_rows(fact, classes, years)
    averages = M.los_by_class(rows).select("avg_los_inpatient", "avg_los_emergency")
    return merge_groups([], averages, M.long_stay_outliers(rows))


# Page: readmissions

def readmission_rate_by_year_class(
    readm: DataFrame, classes: Classes = None, years: Years = None,
    index_classes: Classes = None,
) -> DataFrame:
    rows = slice_rows(readm, classes, years)
    return M.readmission_rate_30d(rows, ["admit_year", "encounter_class_label"], index_classes)


def readmission_type_breakdown(
    readm: DataFrame, classes: Classes = None, years: Years = None
) -> DataFrame:
    rows = slice_rows(readm, classes, years)
    return rows.groupBy("encounter_class_label", "readmission_type").agg(
        F.count(F.lit(1)).alias("encounters"))


def readmission_type_wide(
    readm: DataFrame, classes: Classes = None, years: Years = None, buckets=(7, 30, 90)
) -> DataFrame:
    """One column per type. The types are listed, so no extra job looks for them."""
    types = ["Initial admission", *[f"{d}-day readmission" for d in buckets], "Not a readmission"]
    counts = readmission_type_breakdown(readm, classes, years)
    wide = counts.groupBy("encounter_class_label").pivot("readmission_type", types).agg(
        F.sum("encounters"))
    return wide.na.fill(0, types)


def patient_sequence(
    readm: DataFrame, classes: Classes = None, years: Years = None, in_order: bool = False
) -> DataFrame:
    """By patient and sequence number. ``in_order`` tells that the rows come so already (from
    ``readmissions(..., ordered_output=True)``) and need no sort of their own."""
    rows = slice_rows(readm, classes, years).select(
        "patient_id", "admit_timestamp", "encounter_class", "encounter_seq_num",
        "is_30d_readmission",
    )
    return rows if in_order else rows.orderBy("patient_id", "encounter_seq_num")


def readmission_cards(
    readm: DataFrame, classes: Classes = None, years: Years = None
) -> DataFrame:
    rows = slice_rows(readm, classes, years)
    return merge_groups(
        [], M.readmission_rate_30d(rows), M.readmission_count_7d(rows),
        M.avg_days_to_readmission(rows))


# Page: throughput

def monthly_volume(
    fact: DataFrame, classes: Classes = None, years: Years = None, tz: str = "UTC"
) -> DataFrame:
    month = month_start(F.col("admit_timestamp"), tz).alias("month_start")
    return slice_rows(fact, classes, years).groupBy(month).agg(
        F.count(F.lit(1)).alias("encounters"))


def hourly_admissions(
    fact: DataFrame, classes: Classes = None, years: Years = None, bands: dict = HOUR_BANDS
) -> DataFrame:
    counts = M.admissions_by_hour(slice_rows(fact, classes, years))
    band = F.lit("normal")
    for name, bound in sorted(bands.items(), key=lambda b: b[1]):
        band = F.when(F.col("admissions") > bound, name).otherwise(band)
    return counts.withColumn("band", band)


def gantt_feed(through: DataFrame, classes: Classes = None) -> DataFrame:
    return slice_rows(through, classes).select(
        F.col("encounter_class_label").alias("task"),
        F.col("admit_timestamp").alias("start"),
        F.col("discharge_timestamp").alias("end"),
        F.col("episode_type").alias("legend"),
    )


def throughput_cards(fact: DataFrame, classes: Classes = None, years: Years = None) -> DataFrame:
    rows = slice_rows(fact, classes, years)
    peak = M.busiest(rows, "admit_hour", "peak_hour_admissions").withColumnRenamed(
        "admit_hour", "peak_hour")
    return merge_groups([], peak, M.night_share(rows))


# Page: laboratory

def top_codes(kpis: DataFrame, k: int = 10) -> DataFrame:
    ranked = top_k(kpis, "total_observations", k, ["loinc_code", "result_unit", "observation_name",
                                                   "obs_category"])
    return ranked.select("loinc_code", "observation_name", "result_unit", "total_observations")


def mean_vs_p97_5(kpis: DataFrame) -> DataFrame:
    return kpis.select("loinc_code", "observation_name", "result_unit", "mean_value", "p97_5")


def lab_stats(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        "observation_name", "loinc_code", "total_observations", "mean_value", "p2_5", "p97_5",
        "abnormal_rate_pct")


def lab_cards(obs: DataFrame, code: str = M.PAIN_SCORE) -> DataFrame:
    """Volume, abnormal rate and the mean of one code (the pain score by default)."""
    rate = M.abnormal_rate(obs).select("total_observations", "abnormal_rate_pct")
    return merge_groups([], rate, M.avg_result(obs, code, name="avg_score"))


# Page: providers

def provider_comparison(
    fact: DataFrame, classes: Classes = None, years: Years = None
) -> DataFrame:
    """Encounters, distinct patients and mean LOS per provider."""
    rows = slice_rows(fact, classes, years)
    totals = M.per_patient_totals(rows, ["service_provider"], ["los_hours"])
    return totals.withColumnsRenamed({"rows": "encounters", "patients": "unique_patients"})


def provider_cards(fact: DataFrame, classes: Classes = None, years: Years = None) -> DataFrame:
    return M.busiest(slice_rows(fact, classes, years), "service_provider", "encounters")
