"""Analytics models over the star schema."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.functions import (
    admit_shift, class_label, gap_seconds, is_weekend, los_tier, percent, readmission_bucket,
    remove_text, round_bin, within_days,
)
from clinflow.functions.clinical import DAY, LAST_TIER, LOS_TIERS, READMISSION_CLASSES
from clinflow.operators import sketches
from clinflow.operators.combine import merge_groups
from clinflow.operators.quantiles import (
    percentile_at, value_counts, weighted_mean, weighted_stddev, with_ranks,
)
from clinflow.operators.sequence import add_history
from clinflow.plans.labcube import LAB_KEYS
from clinflow.schemas import STAGED_COLUMNS

# Longest stay kept (hours), and the rank above which a stay is a long one.
MAX_LOS_HOURS = 8760
OUTLIER_RANK = 0.90

# Tier count column -> tier label.
TIER_COLUMNS = dict(zip(
    ["tier_lt_4h", "tier_4_24h", "tier_1_3d", "tier_3_7d", "tier_1_4w", "tier_gt_1m"],
    [*LOS_TIERS, LAST_TIER],
))

READMISSION_INPUT = [
    "encounter_id", "patient_id", "encounter_class", "encounter_class_label", "admit_timestamp",
    "discharge_timestamp", "los_hours", "los_days", "service_provider", "location_display",
    "reason_for_visit", "is_inpatient", "is_emergency", "admit_year", "admit_month",
]

THROUGHPUT_COLUMNS = [
    "episode_id", "patient_id", "episode_type", "episode_start", "episode_end",
    "episode_los_hours", "encounter_id", "encounter_class", "encounter_class_label",
    "admit_timestamp", "discharge_timestamp", "los_hours", "location_display",
    "service_provider", "encounter_seq_in_episode", "total_encounters_in_episode",
    "hours_since_prev_encounter",
]


def stg_encounters(fact: DataFrame) -> DataFrame:
    """Valid stays with label, shift, weekend flag and tier. No shuffle; the filters are on stored
    columns and reach the scan."""
    los = F.col("los_hours")
    valid = fact.filter(
        F.col("admit_timestamp").isNotNull() & F.col("discharge_timestamp").isNotNull()
        & (los >= 0) & (los < MAX_LOS_HOURS)
    )
    return valid.select(
        *STAGED_COLUMNS,
        class_label(F.col("encounter_class")).alias("encounter_class_label"),
        admit_shift(F.col("admit_hour")).alias("admit_shift"),
        is_weekend(F.col("admit_dow")).alias("is_weekend_admission"),
        los_tier(los).alias("los_tier"),
    )


def los_kpis(stg: DataFrame, approx: bool = False) -> DataFrame:
    """Length-of-stay statistics per encounter class.

    The stays are reduced to (class, hours) -> counts in one combined aggregation; mean, deviation,
    percentiles and ranks are exact and computed from them. Hours rounded to two decimals in
    [0, 8760), as the ingest leaves them, give few counts; unrounded hours are ranked in blocks.
    ``approx`` uses a mergeable sketch for the percentiles and the outlier bound instead.
    """
    if approx:
        return _los_kpis_approx(stg)
    keys = ["encounter_class", "encounter_class_label"]
    weekend = F.col("is_weekend_admission")
    counts = value_counts(
        stg, [*keys, "los_tier"], "los_hours",
        n_weekend=F.count_if(weekend), n_weekday=F.count_if(~weekend),
    )
    ranked = with_ranks(counts, ["encounter_class"], "los_hours")
    rank = F.try_divide(F.col("_below").cast("double"), F.col("_total") - 1)
    x = F.col("los_hours")
    n = F.col("n")
    return ranked.groupBy(*keys).agg(
        F.sum(n).alias("encounter_count"),
        round_bin(weighted_mean("los_hours"), 2).alias("avg_los_hours"),
        round_bin(percentile_at("los_hours", 0.5), 2).alias("median_los_hours"),
        round_bin(F.min(x), 2).alias("min_los_hours"),
        round_bin(F.max(x), 2).alias("max_los_hours"),
        round_bin(weighted_stddev("los_hours"), 2).alias("stddev_los_hours"),
        round_bin(percentile_at("los_hours", 0.25), 2).alias("p25_los_hours"),
        round_bin(percentile_at("los_hours", 0.75), 2).alias("p75_los_hours"),
        round_bin(percentile_at("los_hours", 0.90), 2).alias("p90_los_hours"),
        F.sum(F.when(rank > OUTLIER_RANK, n).otherwise(0)).alias("long_stay_outlier_count"),
        round_bin(weighted_mean("los_hours", "n_weekend"), 2).alias("avg_los_weekend"),
        round_bin(weighted_mean("los_hours", "n_weekday"), 2).alias("avg_los_weekday"),
        *[F.sum(F.when(F.col("los_tier") == tier, n).otherwise(0)).alias(col)
          for col, tier in TIER_COLUMNS.items()],
    )


def _los_kpis_approx(stg: DataFrame) -> DataFrame:
    """One pass: percentiles and the number of stays above P90 come from one mergeable sketch per class, so
    no counts of exact values are built."""
    keys = ["encounter_class", "encounter_class_label"]
    x, weekend = F.col("los_hours"), F.col("is_weekend_admission")
    stats = stg.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("encounter_count"),
        round_bin(F.avg(x), 2).alias("avg_los_hours"),
        F.kll_sketch_agg_double(x, sketches.KLL_K).alias("_sketch"),
        round_bin(F.min(x), 2).alias("min_los_hours"),
        round_bin(F.max(x), 2).alias("max_los_hours"),
        round_bin(F.stddev_samp(x), 2).alias("stddev_los_hours"),
        round_bin(F.avg(F.when(weekend, x)), 2).alias("avg_los_weekend"),
        round_bin(F.avg(F.when(~weekend, x)), 2).alias("avg_los_weekday"),
        *[F.count_if(F.col("los_tier") == tier).alias(col) for col, tier in TIER_COLUMNS.items()],
    )
    at = lambda p: round_bin(sketches.quantile(p, "_sketch"), 2)
    return stats.withColumns({
        "median_los_hours": at(0.5), "p25_los_hours": at(0.25), "p75_los_hours": at(0.75),
        "p90_los_hours": at(0.9),
        "long_stay_outlier_count": sketches.above(sketches.quantile(0.9, "_sketch"), "_sketch"),
    }).select(
        *keys, "encounter_count", "avg_los_hours", "median_los_hours", "min_los_hours",
        "max_los_hours", "stddev_los_hours", "p25_los_hours", "p75_los_hours", "p90_los_hours",
        "long_stay_outlier_count", "avg_los_weekend", "avg_los_weekday", *TIER_COLUMNS,
    )


def los_sketches(stg: DataFrame, parts: tuple[str, ...] = ("admit_year",)) -> DataFrame:
    """Stored once per part, merged at read: stays per class and part, with sketches of the hours and of
    the patients."""
    return sketches.sketch(
        stg, ["encounter_class", "encounter_class_label", *parts], "los_hours", "patient_id")


def los_from_sketches(stored: DataFrame, by: tuple[str, ...] = ("encounter_class", "encounter_class_label")) -> DataFrame:
    """Length of stay for any coarser context, from the sketch rows alone."""
    merged = sketches.merge(stored, by)
    p90 = sketches.quantile(0.9)
    return merged.select(
        *by, F.col("n").alias("encounter_count"), sketches.distinct_count().alias("patient_count"),
        round_bin(F.col("mean"), 2).alias("avg_los_hours"),
        round_bin(sketches.stddev(), 2).alias("stddev_los_hours"),
        round_bin(sketches.quantile(0.5), 2).alias("median_los_hours"),
        round_bin(p90, 2).alias("p90_los_hours"), sketches.above(p90).alias("long_stays"))


def readmissions(
    stg: DataFrame,
    classes: Sequence[str] = READMISSION_CLASSES,
    window_days: int = 30,
    buckets: Sequence[int] = (7, 30, 90),
    ordered_output: bool = False,
) -> DataFrame:
    """Every acute encounter with its neighbours in the patient's history and the gaps to them.

    The class filter comes before the history: it decides which stay is the previous one. Equal
    admission times are ordered by encounter id. A patient of any size is handled in blocks. With
    ``ordered_output`` the rows come by patient and sequence number.
    """
    acute = stg.filter(F.col("encounter_class").isin(list(classes))).select(*READMISSION_INPUT)
    sequenced = add_history(
        acute, ["patient_id"], ["admit_timestamp", "encounter_id"],
        prev={
            "prev_encounter_id": "encounter_id",
            "prev_encounter_class": "encounter_class",
            "prev_admit_timestamp": "admit_timestamp",
            "prev_discharge_timestamp": "discharge_timestamp",
            "prev_service_provider": "service_provider",
        },
        following={
            "next_encounter_id": "encounter_id",
            "next_encounter_class": "encounter_class",
            "next_admit_timestamp": "admit_timestamp",
            "next_service_provider": "service_provider",
        },
        seq="encounter_seq_num", total="total_patient_encounters", ordered_output=ordered_output,
    )
    since = gap_seconds(F.col("admit_timestamp"), F.col("prev_discharge_timestamp"))
    until = gap_seconds(F.col("next_admit_timestamp"), F.col("discharge_timestamp"))
    return sequenced.withColumns({
        "days_since_prev_discharge": round_bin(since / DAY, 2),
        "days_until_next_admit": round_bin(until / DAY, 2),
        f"is_{window_days}d_readmission": within_days(since, window_days),
        "index_discharge_with_readmission": within_days(until, window_days),
        "readmission_type": readmission_bucket(since, buckets),
    })


def throughput(episodes: DataFrame, stg: DataFrame) -> DataFrame:
    """Encounters of each episode, in order, with the gap to the previous one.

    The history is computed before the join, on the join key: an inner join on that key keeps or
    drops whole histories, so the result is the same and large episodes are cut into blocks.
    ``episode_id`` is the key of ``episodes``.
    """
    linked = stg.withColumn(
        "episode_id", remove_text(F.col("episode_of_care_ref"), "EpisodeOfCare/")
    ).filter(F.col("episode_id").isNotNull()).select(
        "episode_id", "encounter_id", "encounter_class", "encounter_class_label",
        "admit_timestamp", "discharge_timestamp", "los_hours", "location_display",
        "service_provider",
    )
    sequenced = add_history(
        linked, ["episode_id"], ["admit_timestamp", "encounter_id"],
        prev={"_prev_discharge": "discharge_timestamp"},
        seq="encounter_seq_in_episode", total="total_encounters_in_episode",
    )
    gap = gap_seconds(F.col("admit_timestamp"), F.col("_prev_discharge"))
    described = episodes.select(
        "episode_id", "patient_id", "episode_type", "episode_start", "episode_end",
        "episode_los_hours",
    )
    return (
        described.join(sequenced, "episode_id")
        .withColumn("hours_since_prev_encounter", round_bin(gap / 3600.0, 2))
        .select(*THROUGHPUT_COLUMNS)
    )


def lab_kpis(
    obs: DataFrame,
    ranges: DataFrame | None = None,
    approx: bool = False,
) -> DataFrame:
    """Statistics of the results per code, name, category and unit.

    Results are reduced to distinct values with counts; patients are counted in a separate
    aggregation on (group, patient), so that no task holds all patients of a frequent code.
    With ``ranges`` the cohort range of the code is carried along.
    """
    x = F.col("result_value")
    valid = obs.filter(x.isNotNull())
    if approx:
        stats = _lab_kpis_approx(valid)
    else:
        counts = value_counts(
            valid, LAB_KEYS, "result_value", n_abnormal=F.count_if(F.col("is_abnormal")))
        ranked = with_ranks(counts, LAB_KEYS, "result_value")
        values = ranked.groupBy(*LAB_KEYS).agg(
            F.sum("n").alias("total_observations"),
            round_bin(weighted_mean("result_value"), 3).alias("mean_value"),
            round_bin(percentile_at("result_value", 0.5), 3).alias("median_value"),
            round_bin(weighted_stddev("result_value"), 3).alias("stddev_value"),
            round_bin(F.min(x), 3).alias("min_value"),
            round_bin(F.max(x), 3).alias("max_value"),
            round_bin(percentile_at("result_value", 0.025), 3).alias("p2_5"),
            round_bin(percentile_at("result_value", 0.975), 3).alias("p97_5"),
            F.sum("n_abnormal").alias("abnormal_count"),
        )
        patients = (
            valid.select(*LAB_KEYS, "patient_id").distinct()
            .groupBy(*LAB_KEYS).agg(F.count("patient_id").alias("patient_count"))
        )
        stats = merge_groups(LAB_KEYS, values, patients)
    rate = percent(F.col("abnormal_count"), F.col("total_observations"))
    out = stats.withColumn("abnormal_rate_pct", round_bin(rate, 1)).select(
        *LAB_KEYS, "total_observations", "patient_count", "mean_value", "median_value",
        "stddev_value", "min_value", "max_value", "p2_5", "p97_5", "abnormal_count",
        "abnormal_rate_pct",
    )
    if ranges is not None:
        out = out.join(ranges.select("loinc_code", "normal_low", "normal_high"), "loinc_code", "left")
    return out


def _lab_kpis_approx(valid: DataFrame, accuracy: int = 10_000) -> DataFrame:
    x = F.col("result_value")
    pick = lambda i: round_bin(F.get("_p", F.lit(i)), 3)
    return valid.groupBy(*LAB_KEYS).agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.approx_count_distinct("patient_id").alias("patient_count"),
        round_bin(F.avg(x), 3).alias("mean_value"),
        F.percentile_approx(x, [0.5, 0.025, 0.975], accuracy).alias("_p"),
        round_bin(F.stddev_samp(x), 3).alias("stddev_value"),
        round_bin(F.min(x), 3).alias("min_value"),
        round_bin(F.max(x), 3).alias("max_value"),
        F.count_if(F.col("is_abnormal")).alias("abnormal_count"),
    ).withColumns({"median_value": pick(0), "p2_5": pick(1), "p97_5": pick(2)}).drop("_p")


def by_volume(kpis: DataFrame) -> DataFrame:
    """Reading order of the lab statistics; a stored table has none."""
    return kpis.orderBy(
        F.desc("total_observations"), *[F.asc_nulls_last(c) for c in LAB_KEYS])
