"""Flat tables -> star schema."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.functions import (
    episode_hours, out_of_range, round_bin, wall_clock, weekday_name,
)
from clinflow.operators.combine import merge_groups
from clinflow.plans import labcube
from clinflow.schemas import TABLES
def build_patients(flat: DataFrame) -> DataFrame:
    return flat.select(*TABLES["dim_patients"].fieldNames())


def build_diagnoses(flat: DataFrame) -> DataFrame:
    """A full copy, matched by name."""
    return flat.select(*TABLES["dim_diagnoses"].fieldNames())


def build_episodes(flat: DataFrame) -> DataFrame:
    hours = episode_hours(F.col("episode_start"), F.col("episode_end"))
    return flat.withColumn("episode_los_hours", hours).select(*TABLES["dim_episodes"].fieldNames())


def reference_ranges(
    obs: DataFrame,
    low: float = 0.025,
    high: float = 0.975,
    by: Sequence[str] = ("loinc_code",),
    approx: bool = False,
) -> DataFrame:
    """Cohort ranges per code: exact interpolated percentiles of the results, from a stored cube of value
    counts (see ``labcube``), so that the results are read once.

    ``by=("loinc_code", "result_unit")`` keeps units apart. ``approx`` takes the percentiles from
    a mergeable sketch in one pass.
    """
    by = list(by)
    if not approx:
        return labcube.cohort_ranges(labcube.value_cube(obs, patients=False), low, high, by)
    valid = obs.filter(F.col("loinc_code").isNotNull() & F.col("result_value").isNotNull())
    attributes = [a for a in labcube.RANGE_LABELS if a not in by]
    labels = labcube.most_frequent(
        valid.groupBy(*by, *attributes).agg(F.count(F.lit(1)).alias("n")), by, attributes)
    pair = F.percentile_approx("result_value", [low, high], 10_000)
    bounds = valid.groupBy(*by).agg(pair.alias("_p")).select(
        *by, F.get("_p", F.lit(0)).alias("normal_low"), F.get("_p", F.lit(1)).alias("normal_high"))
    return merge_groups(by, labels, bounds).select(*TABLES["dim_loinc_reference"].fieldNames())


def flag_abnormal(
    obs: DataFrame, ranges: DataFrame, by: Sequence[str] = ("loinc_code",)
) -> DataFrame:
    """Left join to the ranges, then the out-of-range flag.

    Pass ``ranges`` as a stored table (see ``materialize``): its size is then known and the
    planner broadcasts it when it is small; past that, adaptive execution splits the partitions
    of frequent codes.
    """
    by = list(by)
    bounds = ranges.select(*by, "normal_low", "normal_high")
    if by == ["loinc_code"]:
        joined = obs.join(bounds, by, "left")
    else:
        right = bounds.withColumnsRenamed({k: f"_range_{k}" for k in by})
        match = F.lit(True)
        for k in by:
            match = match & obs[k].eqNullSafe(right[f"_range_{k}"])
        joined = obs.join(right, match, "left")
    flag = out_of_range(F.col("result_value"), F.col("normal_low"), F.col("normal_high"))
    kept = [c for c in obs.columns if c != "is_abnormal"]
    return joined.select(*[obs[c] for c in kept], flag.alias("is_abnormal"))


def build_encounters(flat: DataFrame, patients: DataFrame, tz: str = "UTC") -> DataFrame:
    """Encounters of known patients with calendar parts (in ``tz``) and class flags.

    ``is_readmission_30d`` and ``days_since_last_enc`` stay constant placeholders;
    ``fill_readmissions`` fills them when wanted.
    """
    local = wall_clock(F.col("admit_timestamp"), tz)
    known = flat.join(patients.select("patient_id"), "patient_id", "left_semi")
    return known.withColumns({
        "los_days": round_bin(F.col("los_hours") / 24.0, 2),
        "admit_year": F.year(local),
        "admit_month": F.month(local),
        "admit_hour": F.hour(local),
        "admit_dow": weekday_name(local),
        "is_inpatient": F.col("encounter_class") == "IMP",
        "is_emergency": F.col("encounter_class") == "EMER",
        "is_readmission_30d": F.lit(False),
        "days_since_last_enc": F.lit(None).cast("double"),
    }).select(*TABLES["fact_patient_encounters"].fieldNames())


def fill_readmissions(fact: DataFrame, readmissions: DataFrame) -> DataFrame:
    """Optional: put the readmission results into the two placeholder columns of the fact."""
    found = readmissions.select(
        "encounter_id",
        F.col("is_30d_readmission").alias("_flag"),
        F.col("days_since_prev_discharge").alias("_days"),
    )
    return (
        fact.join(found, "encounter_id", "left")
        .withColumns({
            "is_readmission_30d": F.coalesce("_flag", F.lit(False)),
            "days_since_last_enc": F.col("_days"),
        })
        .select(*fact.columns)
    )
