"""Dashboard measures. Each takes its table and ``by``, the columns that stand for the filter
context, and returns one row per combination (one row in all for ``by=()``).

Length-of-stay measures run on the fact as it is given, not on the staged rows.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinflow.functions import gap_seconds, is_weekend, percent, within_days
from clinflow.operators.combine import merge_groups
from clinflow.operators.quantiles import percentile_at, value_counts, with_ranks
from clinflow.operators.ranking import top_k

By = Sequence[str]

# Fixed value: code of the pain score.
PAIN_SCORE = "72514-3"

def _rows() -> Column:
    return F.count(F.lit(1))


def _one(df: DataFrame, by: By, **measures: Column) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(name) for name, c in measures.items()])


def total_encounters(fact: DataFrame, by: By = ()) -> DataFrame:
    return _one(fact, by, total_encounters=_rows())


def total_patients(fact: DataFrame, by: By = ()) -> DataFrame:
    return _one(fact, by, total_patients=F.count_distinct("patient_id"))


def avg_los_hours(fact: DataFrame, by: By = ()) -> DataFrame:
    return _one(fact, by, avg_los_hours=F.avg("los_hours"))


def avg_los_days(fact: DataFrame, by: By = ()) -> DataFrame:
    return _one(fact, by, avg_los_days=F.avg("los_days"))


def _all_groups(measured: DataFrame, fact: DataFrame, by: By) -> DataFrame:
    """Groups without any LOS come back too, with NULL measures."""
    return merge_groups(list(by), measured, fact.select(*by).distinct()) if by else measured


def _los_percentile(fact: DataFrame, by: By, p: float, name: str) -> DataFrame:
    ranked = with_ranks(
        value_counts(fact, list(by), "los_hours"), list(by), "los_hours")
    return _one(ranked, by, **{name: percentile_at("los_hours", p)})


def median_los_hours(fact: DataFrame, by: By = ()) -> DataFrame:
    return _all_groups(_los_percentile(fact, by, 0.5, "median_los_hours"), fact, by)


def per_patient_totals(df: DataFrame, by: By, columns: Sequence[str]) -> DataFrame:
    """Rows, distinct patients and column means per group, from one scan: rows are first summed
    per (group, patient), so that no task holds all patients of a frequent group."""
    sums = {f"_sum_{c}": F.sum(c) for c in columns}
    filled = {f"_n_{c}": F.count(c) for c in columns}
    keys = list(dict.fromkeys([*by, "patient_id"]))
    patients = _one(df, keys, _rows=_rows(), **sums, **filled)
    mean = lambda c: F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_n_{c}"))
    # A grand total over no rows still gives one row with counts of zero.
    return _one(
        patients, by, rows=F.coalesce(F.sum("_rows"), F.lit(0)), patients=F.count("patient_id"),
        **{f"avg_{c}": mean(c) for c in columns})


def core_kpis(fact: DataFrame, by: By = ()) -> DataFrame:
    """Encounters, patients, mean LOS in hours and days, median LOS. The median comes from the
    distinct values and is merged to the totals per group."""
    totals = per_patient_totals(fact, by, ["los_hours", "los_days"]).withColumnsRenamed(
        {"rows": "total_encounters", "patients": "total_patients"})
    median = _los_percentile(fact, by, 0.5, "median_los_hours")
    return merge_groups(by, totals, median).select(
        *by, "total_encounters", "total_patients", "avg_los_hours", "avg_los_days",
        "median_los_hours")


def _avg_los_of(code: str) -> Column:
    return F.avg(F.when(F.col("encounter_class") == code, F.col("los_hours")))


def avg_los_inpatient(fact: DataFrame, by: By = ()) -> DataFrame:
    return _one(fact, by, avg_los_inpatient=_avg_los_of("IMP"))


def avg_los_emergency(fact: DataFrame, by: By = ()) -> DataFrame:
    return _one(fact, by, avg_los_emergency=_avg_los_of("EMER"))


def avg_los_home_health(fact: DataFrame, by: By = ()) -> DataFrame:
    return _one(fact, by, avg_los_home_health=_avg_los_of("HH"))


def los_by_class(fact: DataFrame, by: By = ()) -> DataFrame:
    return _one(
        fact, by, avg_los_inpatient=_avg_los_of("IMP"), avg_los_emergency=_avg_los_of("EMER"),
        avg_los_home_health=_avg_los_of("HH"))


def los_p90(fact: DataFrame, by: By = ()) -> DataFrame:
    return _all_groups(_los_percentile(fact, by, 0.9, "los_p90"), fact, by)


def long_stay_outliers(fact: DataFrame, by: By = ()) -> DataFrame:
    """P90 of the context and the stays at or above it. A distinct value is at or above the
    percentile exactly when its last rank reaches the upper neighbour of the percentile's rank,
    so the values are not joined back. Differs from the per-class count of the LOS mart."""
    ranked = with_ranks(
        value_counts(fact, list(by), "los_hours"), list(by), "los_hours")
    last = F.col("_below") + F.col("n") - 1
    upper = F.ceil((F.col("_total") - 1).cast("double") * F.lit(0.9))
    found = _one(
        ranked, by, los_p90=percentile_at("los_hours", 0.9),
        long_stay_outliers=F.sum(F.when(last >= upper, F.col("n")).otherwise(0)))
    return _all_groups(found, fact, by).withColumn(
        "long_stay_outliers", F.coalesce("long_stay_outliers", F.lit(0)))


def _of_classes(readm: DataFrame, index_classes: Sequence[str] | None) -> DataFrame:
    if index_classes is None:
        return readm
    return readm.filter(F.col("encounter_class").isin(list(index_classes)))


def readmission_rate_30d(
    readm: DataFrame, by: By = (), index_classes: Sequence[str] | None = None
) -> DataFrame:
    """Count and rate in percent. The denominator is every analysed encounter, or those of
    ``index_classes`` (for example only inpatient stays)."""
    n = F.count_if("is_30d_readmission")
    return _one(
        _of_classes(readm, index_classes), by,
        readmission_count_30d=n, readmission_rate_30d_pct=percent(n, _rows()))


def readmission_count_30d(readm: DataFrame, by: By = ()) -> DataFrame:
    return _one(readm, by, readmission_count_30d=F.count_if("is_30d_readmission"))


def readmission_count_7d(readm: DataFrame, by: By = ()) -> DataFrame:
    """By type, so overlapping stays are included."""
    return _one(
        readm, by, readmission_count_7d=F.count_if(F.col("readmission_type") == "7-day readmission"))


def avg_days_to_readmission(readm: DataFrame, by: By = ()) -> DataFrame:
    days = F.when(F.col("is_30d_readmission"), F.col("days_since_prev_discharge"))
    return _one(readm, by, avg_days_to_readmission=F.avg(days))


#: Windows (days, label): any table of them can be applied to one history.
WINDOWS = ((7, "7 days"), (30, "30 days"), (60, "60 days"), (90, "90 days"))


def readmission_windows(
    readm: DataFrame, windows: Sequence[tuple[int, str]] = WINDOWS, by: By = (),
    index_classes: Sequence[str] | None = None,
) -> DataFrame:
    """All readmission measures for each window, from one pass over one history: a row per group and
    window with the number of readmissions, their rate in percent, the mean days to them, and the discharges
    that were followed by one.

    The windows are data: the flags come from the exact gaps, not from a stored flag of one length. Gaps
    from 0 to the window's days count, both included.
    """
    since = gap_seconds(F.col("admit_timestamp"), F.col("prev_discharge_timestamp"))
    until = gap_seconds(F.col("next_admit_timestamp"), F.col("discharge_timestamp"))
    days = F.col("days_since_prev_discharge")
    cells = []
    for length, label in windows:
        again, followed = within_days(since, length), within_days(until, length)
        cells.append(F.struct(
            F.lit(length).alias("window_days"), F.lit(label).alias("window"),
            F.count_if(again).alias("readmissions"),
            percent(F.count_if(again), _rows()).alias("readmission_rate_pct"),
            F.avg(F.when(again, days)).alias("avg_days_to_readmission"),
            F.count_if(followed).alias("index_discharges")))
    grouped = _of_classes(readm, index_classes).groupBy(*by).agg(F.array(*cells).alias("_windows"))
    return grouped.select(*by, F.inline("_windows"))


def admissions_by_hour(fact: DataFrame, by: By = ()) -> DataFrame:
    return _one(fact, [*by, "admit_hour"], admissions=_rows())


def peak_hours(fact: DataFrame, by: By = ()) -> DataFrame:
    """Hours whose count reaches the 75th percentile of the counts per hour. The window runs over
    at most 25 rows per group: the 24 hours and NULL."""
    counts = admissions_by_hour(fact, by)
    bound = F.percentile("admissions", F.lit(0.75)).over(W.partitionBy(*by))
    return counts.withColumn("p75_admissions", bound).withColumn(
        "peak_flag",
        F.when(F.col("admissions") >= F.col("p75_admissions"), "Peak").otherwise("Normal"))


def weekend_share(stg: DataFrame, by: By = ()) -> DataFrame:
    """Needs only ``admit_dow``, so it runs on staged rows and on the fact."""
    n = F.count_if(is_weekend(F.col("admit_dow")))
    return _one(stg, by, weekend_admissions_pct=percent(n, _rows()))


def night_share(fact: DataFrame, by: By = ()) -> DataFrame:
    """Admissions from 23:00 to 06:59."""
    hour = F.col("admit_hour")
    n = F.count_if((hour >= 23) | (hour < 7))
    return _one(fact, by, night_admissions_pct=percent(n, _rows()))


def total_observations(obs: DataFrame, by: By = ()) -> DataFrame:
    return _one(obs, by, total_observations=_rows())


def abnormal_rate(obs: DataFrame, by: By = ()) -> DataFrame:
    """Abnormal results among all observations; those without a flag stay in the denominator."""
    n = F.count_if("is_abnormal")
    return _one(
        obs, by, total_observations=_rows(), abnormal_count=n,
        abnormal_rate_pct=percent(n, _rows()))


def avg_result(obs: DataFrame, code: str = PAIN_SCORE, by: By = (), name: str = "avg_result") -> DataFrame:
    """The code is a filter on a stored column: it reaches the scan, whose files skip what their bloom
    filters rule out. Groups without a result of the code come back too, with NULL."""
    measured = _one(obs.filter(F.col("loinc_code") == code), by, **{name: F.avg("result_value")})
    return _all_groups(measured, obs, by)


def avg_pain_score(obs: DataFrame, by: By = ()) -> DataFrame:
    return avg_result(obs, PAIN_SCORE, by, "avg_pain_score")


def busiest(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """The most frequent value of a column with its count, the smallest value on ties."""
    return top_k(_one(df, [column], **{name: _rows()}), name, 1, [column])
