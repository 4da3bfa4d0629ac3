"""Laboratory statistics from one stored cube of value counts.

The results are read once: one aggregation over two grouping sets leaves, per code, name, category and
unit, the distinct values with their counts and the distinct patients. Reference ranges, their labels, the
abnormal flag and all statistics are rolled up from there. The flag is taken per distinct value, so no row
is joined to a range.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.functions import out_of_range, percent, round_bin
from clinflow.operators.combine import merge_groups
from clinflow.operators.quantiles import (
    percentile_at, weighted_mean, weighted_stddev, with_nested_ranks, with_ranks,
)
from clinflow.operators.storage import materialize
from clinflow.schemas import TABLES

LAB_KEYS = ["loinc_code", "observation_name", "obs_category", "result_unit"]
RANGE_LABELS = ("observation_name", "obs_category", "result_unit")


def value_cube(obs: DataFrame, patients: bool = True) -> DataFrame:
    """(LAB_KEYS, result_value, patient_id, of_patient, n), stored.

    Rows with ``of_patient`` false count the results of a value, NULL values included; the others name the
    patients of the results that have a value. Results are combined before the one shuffle, and a
    frequent code is spread by its values and patients. Ranges need no patients.
    """
    patient = F.when(F.col("result_value").isNotNull(), F.col("patient_id"))
    rows = obs.select(*LAB_KEYS, "result_value", patient.alias("patient_id"))
    sets = [[*LAB_KEYS, "result_value"], [*LAB_KEYS, "patient_id"]]
    counted = rows.groupingSets(
        sets if patients else sets[:1], *LAB_KEYS, "result_value", "patient_id").agg(F.grouping("result_value").alias("of"), F.count(F.lit(1)).alias("n"))
    return materialize(counted.select(
        *LAB_KEYS, "result_value", "patient_id", (F.col("of") == 1).alias("of_patient"), "n"),
        "value_cube")


def counts_of(cube: DataFrame) -> DataFrame:
    """(LAB_KEYS, result_value, n) of the results with a value."""
    return cube.where(~F.col("of_patient") & F.col("result_value").isNotNull()).select(
        *LAB_KEYS, "result_value", "n")


def most_frequent(
    counted: DataFrame, by: Sequence[str], attributes: Sequence[str], n: str = "n"
) -> DataFrame:
    """Most frequent non-NULL value of each attribute per group, the smallest one on ties, from rows
    that stand for ``n`` rows each."""
    votes = (
        counted.select(*by, n, F.posexplode(F.array(*attributes)).alias("_attr", "_value"))
        .filter(F.col("_value").isNotNull())
        .groupBy(*by, "_attr", "_value")
        .agg(F.sum(n).alias("_c"))
    )
    best = F.struct(-F.col("_c"), F.col("_value").alias("_value"))
    return votes.groupBy(*by).agg(*[
        F.min(F.when(F.col("_attr") == i, best)).getField("_value").alias(a)
        for i, a in enumerate(attributes)
    ])


def cohort_ranges(
    cube: DataFrame, low: float = 0.025, high: float = 0.975, by: Sequence[str] = ("loinc_code",)
) -> DataFrame:
    """Reference ranges per code with their most frequent labels."""
    by = list(by)
    counts = counts_of(cube).filter(F.col("loinc_code").isNotNull())
    labels = most_frequent(counts, by, [a for a in RANGE_LABELS if a not in by])
    per_value = counts.groupBy(*by, "result_value").agg(F.sum("n").alias("n"))
    bounds = with_ranks(per_value, by, "result_value").groupBy(*by).agg(
        percentile_at("result_value", low).alias("normal_low"),
        percentile_at("result_value", high).alias("normal_high"))
    return merge_groups(by, labels, bounds).select(*TABLES["dim_loinc_reference"].fieldNames())


def flagged_values(
    cube: DataFrame, low: float = 0.025, high: float = 0.975
) -> DataFrame:
    """The distinct values with their ranks in the code and in the group, the range of the code, and the
    flag. One set of blocks serves both kinds of ranks. A NULL code has no range and no flag."""
    ranked = with_nested_ranks(counts_of(cube), ["loinc_code"], LAB_KEYS, "result_value")
    bounds = ranked.where("loinc_code is not null").groupBy("loinc_code").agg(
        percentile_at("result_value", low).alias("normal_low"),
        percentile_at("result_value", high).alias("normal_high"))
    flag = out_of_range(F.col("result_value"), F.col("normal_low"), F.col("normal_high"))
    return ranked.join(bounds, "loinc_code", "left").withColumn("is_abnormal", flag)


def lab_kpis(cube: DataFrame, with_ranges: bool = False) -> DataFrame:
    """Statistics per code, name, category and unit: values and patients meet in one aggregation."""
    x, n = F.col("result_value"), F.col("n")
    patients = cube.where("of_patient").select(*LAB_KEYS, "patient_id")
    rows = flagged_values(cube).withColumn(
        "n_abnormal", F.when(F.col("is_abnormal"), n).otherwise(0))
    stats = rows.unionByName(patients, allowMissingColumns=True).groupBy(*LAB_KEYS).agg(
        F.sum(n).alias("total_observations"),
        F.count("patient_id").alias("patient_count"),
        round_bin(weighted_mean("result_value"), 3).alias("mean_value"),
        round_bin(percentile_at("result_value", 0.5, "_inner_"), 3).alias("median_value"),
        round_bin(weighted_stddev("result_value", "_inner_"), 3).alias("stddev_value"),
        round_bin(F.min(x), 3).alias("min_value"),
        round_bin(F.max(x), 3).alias("max_value"),
        round_bin(percentile_at("result_value", 0.025, "_inner_"), 3).alias("p2_5"),
        round_bin(percentile_at("result_value", 0.975, "_inner_"), 3).alias("p97_5"),
        F.sum("n_abnormal").alias("abnormal_count"),
        F.max("normal_low").alias("normal_low"), F.max("normal_high").alias("normal_high"),
    ).where(F.col("total_observations").isNotNull())
    rate = percent(F.col("abnormal_count"), F.col("total_observations"))
    return stats.withColumn("abnormal_rate_pct", round_bin(rate, 1)).select(
        *LAB_KEYS, "total_observations", "patient_count", "mean_value", "median_value",
        "stddev_value", "min_value", "max_value", "p2_5", "p97_5", "abnormal_count",
        "abnormal_rate_pct", *(["normal_low", "normal_high"] if with_ranges else []))


def abnormal_rate(cube: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Abnormal results among all; results without a value or a range stay in the denominator."""
    flagged = flagged_values(cube).select(
        *LAB_KEYS, "n", F.when(F.col("is_abnormal"), F.col("n")).otherwise(0).alias("n_abnormal"))
    empty = cube.where("NOT of_patient AND result_value IS NULL").select(
        *LAB_KEYS, "n", F.lit(0).cast("bigint").alias("n_abnormal"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    abnormal = F.coalesce(F.sum("n_abnormal"), F.lit(0))
    return flagged.unionByName(empty).groupBy(*by).agg(
        total.alias("total_observations"), abnormal.alias("abnormal_count"),
        percent(abnormal, total).alias("abnormal_rate_pct"))


def lab_cards(cube: DataFrame, code: str) -> DataFrame:
    """Volume, abnormal rate and the mean of one code, in one aggregation."""
    of_code = F.col("loinc_code") == code
    flagged = flagged_values(cube).select("loinc_code", "result_value", "n", "is_abnormal")
    empty = cube.where("NOT of_patient AND result_value IS NULL").select("loinc_code", "n")
    total = F.coalesce(F.sum("n"), F.lit(0))
    return flagged.unionByName(empty, allowMissingColumns=True).agg(
        total.alias("total_observations"),
        percent(F.coalesce(F.sum(F.when(F.col("is_abnormal"), F.col("n"))), F.lit(0)), total)
        .alias("abnormal_rate_pct"),
        F.try_divide(
            F.sum(F.when(of_code, F.col("result_value") * F.col("n"))),
            F.sum(F.when(of_code & F.col("result_value").isNotNull(), F.col("n"))))
        .alias("avg_score"))
