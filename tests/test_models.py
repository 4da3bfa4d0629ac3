import random
from datetime import datetime, timedelta

import pytest
from helpers import by, rows, same_in_one_block_and_many
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinflow.plans import models, warehouse
from clinflow.schemas import FLAT, STAGED_COLUMNS, TABLES

T0 = datetime(2024, 1, 1)


def _flat(spark, encounters):
    """encounters: (id, patient, class, admit, discharge, los, provider, episode)"""
    data = [
        (e, p, "finished", c, "t", "s", ep, a, d, los, prov, "loc", "why")
        for e, p, c, a, d, los, prov, ep in encounters]
    return spark.createDataFrame(data, FLAT["fact_encounters"])


def _fact(spark, encounters, patients=None):
    flat = _flat(spark, encounters)
    known = flat.select("patient_id").distinct() if patients is None else spark.createDataFrame(
        [(p,) for p in patients], "patient_id string")
    return warehouse.build_encounters(flat, known)


def _stay(eid, start, hours, patient="p", cls="IMP", provider="h", episode="EpisodeOfCare/e"):
    admit = T0 + timedelta(hours=start)
    return (eid, patient, cls, admit, admit + timedelta(hours=hours), round(float(hours), 2),
            provider, episode)


def test_fact_columns_and_flags(spark):
    fact = _fact(spark, [
        _stay("a", 0, 36), _stay("b", 5, 1, cls=None), _stay("c", 0, 1, patient="stranger"),
        ("d", "p", "EMER", None, None, None, None, None)], patients=["p"])
    assert [(f.name, f.dataType) for f in fact.schema] == [
        (f.name, f.dataType) for f in TABLES["fact_patient_encounters"].fields]
    got = by(fact, "encounter_id")
    assert set(got) == {"a", "b", "d"}
    a = got["a"]
    assert (a["los_days"], a["admit_year"], a["admit_month"], a["admit_hour"], a["admit_dow"]) == (
        1.5, 2024, 1, 0, "Monday")
    assert (a["is_inpatient"], a["is_emergency"]) == (True, False)
    assert a["is_readmission_30d"] is False and a["days_since_last_enc"] is None
    assert got["b"]["is_inpatient"] is None and got["d"]["is_emergency"] is True


def test_staging_limits(spark):
    stays = [(f"e{i}", "p", "AMB", T0, T0, los, "h", None)
             for i, los in enumerate([-0.01, 0.0, 8759.99, 8760.0, None])]
    stays += [("no_end", "p", "AMB", T0, None, 1.0, "h", None),
              ("no_start", "p", "AMB", None, T0, 1.0, "h", None)]
    stg = models.stg_encounters(_fact(spark, stays))
    assert {r["encounter_id"] for r in stg.collect()} == {"e1", "e2"}
    assert stg.columns == [*STAGED_COLUMNS, "encounter_class_label", "admit_shift",
                           "is_weekend_admission", "los_tier"]


def _reference_mart(stg):
    """Plain formulation: one window per class and built-in percentiles."""
    rank = F.percent_rank().over(W.partitionBy("encounter_class").orderBy("los_hours"))
    x = F.col("los_hours")
    return stg.withColumn("r", rank).groupBy("encounter_class").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(x), 2), F.round(F.median(x), 2), F.min(x), F.max(x),
        F.round(F.stddev(x), 2), *[F.round(F.percentile(x, F.lit(p)), 2) for p in (0.25, 0.75, 0.9)],
        F.count_if(F.col("r") > 0.9))


def test_los_kpis_match_plain_windows(spark):
    rnd = random.Random(1)
    stays = [_stay(f"e{i}", i * 7, rnd.choice([0.25, 1.5, 30, 100, rnd.randrange(1, 90000) / 100]),
                   cls=rnd.choice(["IMP", "AMB", "AMB", "EMER", None])) for i in range(500)]
    stays.append(_stay("single", 3, 2.5, cls="VR"))
    stg = models.stg_encounters(_fact(spark, stays))
    mart = models.los_kpis(stg)
    got = {r["encounter_class"]: r for r in mart.collect()}
    for r in _reference_mart(stg).collect():
        m = got[r["encounter_class"]]
        values = [m[c] for c in (
            "encounter_count", "avg_los_hours", "median_los_hours", "min_los_hours",
            "max_los_hours", "stddev_los_hours", "p25_los_hours", "p75_los_hours",
            "p90_los_hours", "long_stay_outlier_count")]
        assert values == pytest.approx(list(r)[1:], abs=0.011)
        assert values[-1] == r[-1] and values[0] == r[1]
        tiers = sum(m[c] for c in models.TIER_COLUMNS)
        assert tiers == m["encounter_count"]
    assert got["VR"]["stddev_los_hours"] is None and got["VR"]["long_stay_outlier_count"] == 0
    assert got["VR"]["avg_los_weekend"] is None
    assert sum(m["encounter_count"] for m in got.values()) == 501


def test_los_kpis_approx_is_close(spark):
    stays = [_stay(f"e{i}", i, i % 200) for i in range(2000)]
    stg = models.stg_encounters(_fact(spark, stays))
    exact, approx = models.los_kpis(stg).first(), models.los_kpis(stg, approx=True).first()
    assert exact.asDict().keys() == approx.asDict().keys()
    assert approx["p90_los_hours"] == pytest.approx(exact["p90_los_hours"], abs=2)
    assert approx["long_stay_outlier_count"] == pytest.approx(exact["long_stay_outlier_count"], abs=20)


def test_readmission_gaps(spark):
    day = 24
    stays = [
        _stay("a", 0, 24), _stay("b", 24 + 30 * day, 24),  # exactly 30 days after a
        _stay("c", 24 + 30 * day + 24 + 30 * day + 1 / 3600, 1),  # 30 days and a second after b
        _stay("d", 24 + 30 * day + 24 + 30 * day + 0.5, 1, provider=None),  # overlaps c
        _stay("hh", 30, 1, cls="HH"),  # not part of the history
        _stay("x", 0, 1, patient="q", cls="EMER"),
        _stay("t2", 50, 1, patient="r"), _stay("t1", 50, 1, patient="r"),
    ]
    got = by(models.readmissions(models.stg_encounters(_fact(spark, stays))), "encounter_id")
    assert set(got) == {"a", "b", "c", "d", "x", "t1", "t2"}
    kind = {k: (r["readmission_type"], r["is_30d_readmission"], r["index_discharge_with_readmission"])
            for k, r in got.items()}
    assert kind["a"] == ("Initial admission", False, True)
    assert kind["b"] == ("30-day readmission", True, False)
    assert kind["c"] == ("90-day readmission", False, False)
    assert kind["d"] == ("7-day readmission", False, False)
    assert kind["x"] == ("Initial admission", False, False)
    assert got["d"]["days_since_prev_discharge"] < 0 and got["b"]["days_since_prev_discharge"] == 30.0
    assert got["b"]["prev_encounter_id"] == "a" and got["b"]["next_encounter_id"] == "c"
    assert got["d"]["total_patient_encounters"] == 4 and got["d"]["encounter_seq_num"] == 4
    assert got["t2"]["prev_encounter_id"] == "t1"  # equal admissions: by id
    assert (got["c"]["next_service_provider"], got["d"]["prev_service_provider"]) == (None, "h")


def test_readmissions_in_blocks(spark):
    rnd = random.Random(2)
    stays = [_stay(f"e{i:04d}", rnd.randrange(5000), rnd.randrange(1, 60),
                   patient="hot" if i % 3 == 0 else f"p{i % 40}") for i in range(900)]
    stg = models.stg_encounters(_fact(spark, stays))
    assert same_in_one_block_and_many(spark, lambda: models.readmissions(stg))


def test_neighbours_agree(spark):
    stays = [_stay(f"e{i}", i * 37 % 400, 3, patient=f"p{i % 3}") for i in range(60)]
    got = by(models.readmissions(models.stg_encounters(_fact(spark, stays))), "encounter_id")
    for r in got.values():
        if r["next_encounter_id"]:
            after = got[r["next_encounter_id"]]
            assert after["prev_encounter_id"] == r["encounter_id"]
            assert after["admit_timestamp"] == r["next_admit_timestamp"]
            assert after["is_30d_readmission"] == r["index_discharge_with_readmission"]
        if r["is_30d_readmission"]:
            assert r["readmission_type"] in ("7-day readmission", "30-day readmission")


def _episodes(spark, ids):
    data = [(e, "owner", "active", "T", T0, T0 + timedelta(hours=1, seconds=0.6)) for e in ids]
    return warehouse.build_episodes(spark.createDataFrame(data, FLAT["dim_episodes"]))


def test_throughput(spark):
    stays = [_stay("a", 0, 2), _stay("b", 3, 1), _stay("c", 3.5, 1), _stay("d", 0, 1, episode="e2"),
             _stay("lost", 0, 1, episode="EpisodeOfCare/none"), _stay("free", 0, 1, episode=None)]
    stg = models.stg_encounters(_fact(spark, stays))
    df = models.throughput(_episodes(spark, ["e", "e2", "unused"]), stg)
    got = by(df, "encounter_id")
    assert df.columns == models.THROUGHPUT_COLUMNS
    assert set(got) == {"a", "b", "c", "d"}
    assert [got[k]["encounter_seq_in_episode"] for k in "abcd"] == [1, 2, 3, 1]
    assert [got[k]["hours_since_prev_encounter"] for k in "abcd"] == [None, 1.0, -0.5, None]
    assert got["a"]["total_encounters_in_episode"] == 3 and got["a"]["patient_id"] == "owner"
    assert got["a"]["episode_los_hours"] == 3601 / 3600
    assert same_in_one_block_and_many(spark, lambda: models.throughput(_episodes(spark, ["e", "e2"]), stg))


def _obs(spark, results):
    """results: (id, patient, code, name, category, value, unit)"""
    data = [(i, p, "enc", "final", c, n, cat, T0, v, u, None) for i, p, c, n, cat, v, u in results]
    return spark.createDataFrame(data, FLAT["dim_observations"])


RESULTS = (
    [(f"o{i}", f"p{i % 4}", "c1", "name one", "lab", float(i), "mg") for i in range(1, 101)]
    + [(f"q{i}", "p0", "c1", "name 1", "lab", 1000.0 + i, "g") for i in range(3)]
    + [("s", "p9", "c2", "solo", "lab", 7.0, None), ("n", "p9", "c3", "none", "lab", None, "x"),
       ("t1", "p1", "c4", "tie b", "exam", 1.0, None), ("t2", "p1", "c4", "tie a", "exam", 2.0, None),
       ("z", "p1", None, "no code", "exam", 2.0, "u")]
)


def test_reference_ranges(spark):
    obs = _obs(spark, RESULTS)
    got = by(warehouse.reference_ranges(obs), "loinc_code")
    assert set(got) == {"c1", "c2", "c4"}
    values = [float(v) for v in range(1, 101)] + [1000.0, 1001.0, 1002.0]
    position = 102 * 0.975
    low = values[2] + (values[3] - values[2]) * (102 * 0.025 - 2)
    assert got["c1"]["normal_low"] == pytest.approx(low)
    assert got["c1"]["normal_high"] == pytest.approx(values[99] + (values[100] - values[99]) * (position - 99))
    assert (got["c1"]["observation_name"], got["c1"]["result_unit"]) == ("name one", "mg")
    assert (got["c2"]["normal_low"], got["c2"]["normal_high"], got["c2"]["result_unit"]) == (7.0, 7.0, None)
    assert got["c4"]["observation_name"] == "tie a"
    split = {(r["loinc_code"], r["result_unit"]): r for r in warehouse.reference_ranges(
        obs, by=("loinc_code", "result_unit")).collect()}
    assert split["c1", "g"]["normal_low"] == 1000.05 and ("c2", None) in split
    assert same_in_one_block_and_many(spark, lambda: warehouse.reference_ranges(obs))
    near = by(warehouse.reference_ranges(obs, approx=True), "loinc_code")
    assert near["c1"]["normal_low"] == pytest.approx(3, abs=1)


def test_flags_and_lab_kpis(spark):
    obs = _obs(spark, RESULTS)
    ranges = warehouse.reference_ranges(obs)
    flagged = warehouse.flag_abnormal(obs, ranges)
    flags = {r["observation_id"]: r["is_abnormal"] for r in flagged.collect()}
    assert len(flags) == len(RESULTS)
    assert flags["o1"] is True and flags["o50"] is False and flags["s"] is False
    assert flags["n"] is None and flags["z"] is None
    by_unit = warehouse.flag_abnormal(
        obs, warehouse.reference_ranges(obs, by=("loinc_code", "result_unit")),
        by=("loinc_code", "result_unit"))
    assert {r["observation_id"]: r["is_abnormal"] for r in by_unit.collect()}["s"] is False

    kpis = {(r["loinc_code"], r["result_unit"], r["observation_name"]): r
            for r in models.lab_kpis(flagged).collect()}
    assert len(kpis) == 6 and sum(r["total_observations"] for r in kpis.values()) == len(RESULTS) - 1
    one = kpis["c1", "mg", "name one"]
    assert (one["total_observations"], one["patient_count"], one["mean_value"], one["median_value"]) == (
        100, 4, 50.5, 50.5)
    assert one["stddev_value"] == 29.011 and one["abnormal_count"] == 3
    assert one["abnormal_rate_pct"] == 3.0
    assert kpis["c2", None, "solo"]["stddev_value"] is None
    assert kpis[None, "u", "no code"]["abnormal_rate_pct"] == 0.0
    carried = models.lab_kpis(flagged, ranges).filter("loinc_code = 'c2'").first()
    assert carried["normal_low"] == 7.0
    order = [r["total_observations"] for r in models.by_volume(models.lab_kpis(flagged)).collect()]
    assert order == sorted(order, reverse=True)
    assert same_in_one_block_and_many(spark, lambda: models.lab_kpis(flagged))
    assert models.lab_kpis(flagged, approx=True).columns == models.lab_kpis(flagged).columns


def test_fill_readmissions(spark):
    fact = _fact(spark, [_stay("a", 0, 24), _stay("b", 48, 24), _stay("h", 0, 1, cls="HH")])
    found = models.readmissions(models.stg_encounters(fact))
    got = by(warehouse.fill_readmissions(fact, found), "encounter_id")
    assert [got[k]["is_readmission_30d"] for k in "abh"] == [False, True, False]
    assert [got[k]["days_since_last_enc"] for k in "abh"] == [None, 1.0, None]


def test_empty_input_gives_empty_models(spark):
    fact = _fact(spark, [])
    stg = models.stg_encounters(fact)
    obs = warehouse.flag_abnormal(_obs(spark, []), warehouse.reference_ranges(_obs(spark, [])))
    for df, width in [(stg, 23), (models.los_kpis(stg), 20), (models.readmissions(stg), 31),
                      (models.throughput(_episodes(spark, []), stg), 17), (models.lab_kpis(obs), 15)]:
        assert len(df.columns) == width and df.count() == 0


# The column contract of the models, in order.
COLUMNS = {
    "los_kpis": """encounter_class encounter_class_label encounter_count avg_los_hours
        median_los_hours min_los_hours max_los_hours stddev_los_hours p25_los_hours p75_los_hours
        p90_los_hours long_stay_outlier_count avg_los_weekend avg_los_weekday tier_lt_4h tier_4_24h
        tier_1_3d tier_3_7d tier_1_4w tier_gt_1m""",
    "readmissions": """encounter_id patient_id encounter_class encounter_class_label
        admit_timestamp discharge_timestamp los_hours los_days service_provider location_display
        reason_for_visit is_inpatient is_emergency admit_year admit_month prev_encounter_id
        prev_encounter_class prev_admit_timestamp prev_discharge_timestamp prev_service_provider
        next_encounter_id next_encounter_class next_admit_timestamp next_service_provider
        encounter_seq_num total_patient_encounters days_since_prev_discharge
        days_until_next_admit is_30d_readmission index_discharge_with_readmission
        readmission_type""",
    "throughput": """episode_id patient_id episode_type episode_start episode_end
        episode_los_hours encounter_id encounter_class encounter_class_label admit_timestamp
        discharge_timestamp los_hours location_display service_provider encounter_seq_in_episode
        total_encounters_in_episode hours_since_prev_encounter""",
    "lab_kpis": """loinc_code observation_name obs_category result_unit total_observations
        patient_count mean_value median_value stddev_value min_value max_value p2_5 p97_5
        abnormal_count abnormal_rate_pct""",
    "ranges": "loinc_code observation_name obs_category result_unit normal_low normal_high",
}


def test_column_contract(spark):
    stg = models.stg_encounters(_fact(spark, []))
    obs = _obs(spark, [])
    ranges = warehouse.reference_ranges(obs)
    built = {
        "los_kpis": models.los_kpis(stg), "readmissions": models.readmissions(stg),
        "throughput": models.throughput(_episodes(spark, []), stg),
        "lab_kpis": models.lab_kpis(warehouse.flag_abnormal(obs, ranges)), "ranges": ranges,
    }
    for name, df in built.items():
        assert df.columns == COLUMNS[name].split(), name


def test_los_mart_on_unrounded_hours(spark):
    rnd = random.Random(8)
    stays = [_stay(f"e{i:04d}", rnd.randrange(5000), 1, patient="p") for i in range(400)]
    stg = models.stg_encounters(_fact(spark, stays)).withColumn(
        "los_hours", F.col("admit_timestamp").cast("double") / F.lit(7e6))
    exact = stg.groupBy("encounter_class").agg(F.round(F.percentile("los_hours", F.lit(0.9)), 2)).collect()
    assert {tuple(r) for r in exact} == {
        (r["encounter_class"], r["p90_los_hours"]) for r in models.los_kpis(stg).collect()}
    assert same_in_one_block_and_many(spark, lambda: models.los_kpis(stg))
