from datetime import datetime, timedelta

import pytest
from helpers import rows

from clinflow.operators import merge_groups, slice_rows, star_join, top_k
from clinflow.plans import measures as M
from clinflow.plans import reports as R

T0 = datetime(2024, 1, 31, 22)


@pytest.fixture(scope="module")
def fact(spark):
    data = [
        (f"p{i % 3}", cls, los, los / 24, (T0 + timedelta(hours=i)).hour, 2009 + i, "h" if i else None,
         T0 + timedelta(hours=i), "Saturday" if i % 2 else "Monday")
        for i, (cls, los) in enumerate([
            ("IMP", 10.0), ("IMP", 30.0), ("EMER", 2.0), ("HH", 5.0), (None, 1.0), ("AMB", 30.0)])]
    return spark.createDataFrame(
        data, "patient_id string, encounter_class string, los_hours double, los_days double, "
        "admit_hour int, admit_year int, service_provider string, admit_timestamp timestamp, "
        "admit_dow string")


def test_core(fact):
    row = M.core_kpis(fact).first()
    assert (row["total_encounters"], row["total_patients"], row["avg_los_hours"]) == (6, 3, 13.0)
    assert row["median_los_hours"] == 7.5 and row["avg_los_days"] == pytest.approx(13 / 24)
    empty = M.core_kpis(fact.filter("false")).first()
    assert tuple(empty) == (0, 0, None, None, None)
    grouped = {r["encounter_class"]: r["median_los_hours"] for r in M.core_kpis(fact, ["encounter_class"]).collect()}
    assert grouped == {"IMP": 20.0, "EMER": 2.0, "HH": 5.0, None: 1.0, "AMB": 30.0}
    assert M.total_encounters(fact).first()[0] == 6 and M.total_patients(fact).first()[0] == 3
    assert M.avg_los_hours(fact).first()[0] == 13.0 and M.avg_los_days(fact).first()[0] == pytest.approx(13 / 24)
    assert M.median_los_hours(fact).first()[0] == 7.5


def test_los(fact):
    assert tuple(M.los_by_class(fact).first()) == (20.0, 2.0, 5.0)
    assert M.avg_los_inpatient(fact).first()[0] == 20.0
    assert M.avg_los_emergency(fact).first()[0] == 2.0
    assert M.avg_los_home_health(fact).first()[0] == 5.0
    assert tuple(M.long_stay_outliers(fact).first()) == (30.0, 2)
    assert M.los_p90(fact).first()[0] == 30.0
    assert rows(M.long_stay_outliers(fact, ["encounter_class"]))[0][0] in ("AMB", "EMER", "HH", "IMP", None)


@pytest.mark.parametrize("n", [1, 2, 7, 10, 11, 57])
def test_outliers_against_their_definition(spark, n):
    values = sorted(float(v * v % 23) for v in range(n))
    df = spark.createDataFrame([(v,) for v in values], "los_hours double")
    position = 0.9 * (n - 1)
    low = int(position)
    high = min(low + 1, n - 1)
    p90 = values[low] + (values[high] - values[low]) * (position - low)
    got = M.long_stay_outliers(df).first()
    assert got["los_p90"] == pytest.approx(p90)
    assert got["long_stay_outliers"] == sum(v >= p90 - 1e-9 for v in values)


def test_readmissions(spark):
    df = spark.createDataFrame(
        [("IMP", True, "7-day readmission", 2.0), ("IMP", False, "7-day readmission", -1.0),
         ("AMB", True, "30-day readmission", 10.0), ("AMB", False, "Initial admission", None)],
        "encounter_class string, is_30d_readmission boolean, readmission_type string, "
        "days_since_prev_discharge double")
    assert tuple(M.readmission_rate_30d(df).first()) == (2, 50.0)
    assert tuple(M.readmission_rate_30d(df.filter("false")).first()) == (0, 0.0)
    assert M.readmission_rate_30d(df, index_classes=["AMB"]).first()[1] == 50.0
    assert M.readmission_count_30d(df).first()[0] == 2
    assert M.readmission_count_7d(df).first()[0] == 2
    assert M.avg_days_to_readmission(df).first()[0] == 6.0
    assert tuple(R.readmission_cards(df).first()) == (2, 50.0, 2, 6.0)


def test_hours(fact):
    assert dict(rows(M.admissions_by_hour(fact))) == {22: 1, 23: 1, 0: 1, 1: 1, 2: 1, 3: 1}
    assert {r["peak_flag"] for r in M.peak_hours(fact).collect()} == {"Peak"}
    doubled = fact.unionByName(fact.filter("admit_hour = 2"))
    assert [r["admit_hour"] for r in M.peak_hours(doubled).collect() if r["peak_flag"] == "Normal"] == []
    tripled = doubled.unionByName(fact.filter("admit_hour in (1, 2, 3)"))
    assert {r["admit_hour"] for r in M.peak_hours(tripled).collect() if r["peak_flag"] == "Peak"} == {1, 2, 3}
    assert tuple(M.busiest(doubled, "admit_hour").first()) == (2, 2)
    assert M.weekend_share(fact).first()[0] == 50.0
    assert M.night_share(fact).first()[0] == pytest.approx(500 / 6)
    assert M.night_share(fact.filter("false")).first()[0] == 0.0


def test_labs(spark):
    obs = spark.createDataFrame(
        [("72514-3", 4.0, True), ("72514-3", 2.0, False), ("x", None, None), ("x", 1.0, None)],
        "loinc_code string, result_value double, is_abnormal boolean")
    assert M.total_observations(obs).first()[0] == 4
    assert tuple(M.abnormal_rate(obs).first()) == (4, 1, 25.0)
    assert M.avg_pain_score(obs).first()[0] == 3.0
    assert M.avg_result(obs, "x").first()[0] == 1.0
    assert tuple(R.lab_cards(obs).first()) == (4, 25.0, 3.0)


def test_report_datasets(fact):
    assert slice_rows(fact, ["IMP", "HH"], (2010, 2012)).count() == 2
    months = {str(r["month_start"]): r["encounters"] for r in R.monthly_volume(fact).collect()}
    assert months == {"2024-01-01": 2, "2024-02-01": 4}
    bands = {r["admit_hour"]: r["band"] for r in R.hourly_admissions(
        fact.unionByName(fact.filter("admit_hour < 3")).unionByName(fact.filter("admit_hour = 1")),
        bands={"red": 2, "amber": 1}).collect()}
    assert bands == {22: "normal", 23: "normal", 0: "amber", 1: "red", 2: "amber", 3: "normal"}
    providers = {r["service_provider"]: tuple(r)[1:] for r in R.provider_comparison(fact).collect()}
    assert providers == {None: (1, 1, 10.0), "h": (5, 3, 13.6)}
    assert tuple(R.provider_cards(fact).first()) == ("h", 5)
    assert tuple(R.los_cards(fact).first()) == (20.0, 2.0, 30.0, 2)
    assert R.throughput_cards(fact).first()["peak_hour"] == 0


def test_merge_groups_matches_null_keys(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, n int")
    b = spark.createDataFrame([(None, "v"), ("y", "w")], "k string, s string")
    assert rows(merge_groups(["k"], a, b)) == [("x", 1, None), ("y", None, "w"), (None, 2, "v")]


def test_top_k_and_star_join(spark):
    df = spark.createDataFrame([("a", 2), ("b", 3), ("c", 3), (None, 3)], "k string, n int")
    assert [tuple(r) for r in top_k(df, "n", 3, ["k"]).collect()] == [("b", 3), ("c", 3), (None, 3)]
    parent = spark.createDataFrame([("a", "A", 0)], "k string, label string, other int")
    got = star_join(df, parent, "k", ["label"], "parent_")
    assert got.columns == ["k", "n", "parent_label"] and got.count() == 4


def test_groups_without_a_stay_length_stay(spark):
    fact = spark.createDataFrame(
        [("a", None), ("b", 1.0), (None, 2.0)], "provider_name string, los_hours double")
    by = ["provider_name"]
    medians = {r[0]: r[1] for r in M.median_los_hours(fact, by).collect()}
    assert medians == {"a": None, "b": 1.0, None: 2.0}
    found = {r[0]: (r["los_p90"], r["long_stay_outliers"])
             for r in M.long_stay_outliers(fact, by).collect()}
    assert found == {"a": (None, 0), "b": (1.0, 1), None: (2.0, 1)}
    none = M.long_stay_outliers(fact.limit(0)).first()
    assert (none["los_p90"], none["long_stay_outliers"]) == (None, 0)
