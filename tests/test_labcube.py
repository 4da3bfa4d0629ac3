"""The value-count cube against plain statistics over the rows."""

import statistics
from collections import Counter, defaultdict

import pytest
from helpers import plan, same_in_one_block_and_many

from clinflow.plans import labcube, models, warehouse

SCHEMA = ("observation_id string, patient_id string, loinc_code string, observation_name string, "
          "obs_category string, result_unit string, result_value double")


@pytest.fixture(scope="module")
def data():
    out = []
    for i in range(400):
        code = "hot" if i % 3 == 0 else f"c{i % 11}"
        out.append((f"o{i}", f"p{i % 23}", code, f"n{i % 2}", "lab" if i % 5 else None, "mg",
                    float((i * 7919) % 97) / 4))
    out += [("x1", "p1", "hot", "n0", "lab", "mg", None), ("x2", None, "hot", "n0", "lab", "mg", 3.0),
            ("x3", "p2", None, "n0", "lab", "mg", 1.0), ("x4", "p2", "only-null", "n", "lab", "mg", None)]
    return out


@pytest.fixture(scope="module")
def obs(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(5).cache()


def _quantile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
    return low + (high - low) * (at - int(at))


def test_statistics_equal_plain_ones(data, obs):
    by_code, by_group, patients = defaultdict(list), defaultdict(list), defaultdict(set)
    for _, patient, *key, value in data:
        if value is not None:
            by_group[tuple(key)].append(value)
            patients[tuple(key)].add(patient)
            if key[0] is not None:
                by_code[key[0]].append(value)
    bounds = {c: (_quantile(v, 0.025), _quantile(v, 0.975)) for c, v in by_code.items()}
    got = {tuple(r[k] for k in labcube.LAB_KEYS): r
           for r in labcube.lab_kpis(labcube.value_cube(obs), with_ranges=True).collect()}
    assert set(got) == set(by_group)
    for key, values in by_group.items():
        r, (low, high) = got[key], bounds.get(key[0], (None, None))
        assert (r["normal_low"], r["normal_high"]) == (pytest.approx(low), pytest.approx(high)) or low is None
        assert r["total_observations"] == len(values)
        assert r["patient_count"] == len(patients[key] - {None})
        assert r["mean_value"] == pytest.approx(statistics.mean(values), abs=6e-4)
        assert r["median_value"] == pytest.approx(statistics.median(values), abs=6e-4)
        assert r["p97_5"] == pytest.approx(_quantile(values, 0.975), abs=6e-4)
        if len(values) > 1:
            assert r["stddev_value"] == pytest.approx(statistics.stdev(values), abs=6e-4)
        abnormal = 0 if low is None else sum(v < low or v > high for v in values)
        assert r["abnormal_count"] == abnormal


def test_cube_equals_the_row_plans(obs):
    """What the plans over flagged rows give, the cube gives as well."""
    flagged = warehouse.flag_abnormal(obs, warehouse.reference_ranges(obs))
    cube = labcube.value_cube(obs)
    key = lambda r: repr(tuple(r))
    assert sorted(labcube.lab_kpis(cube).collect(), key=key) == sorted(
        models.lab_kpis(flagged).collect(), key=key)
    total, abnormal = len(flagged.collect()), flagged.where("is_abnormal").count()
    rate = labcube.abnormal_rate(cube).first()
    assert (rate["total_observations"], rate["abnormal_count"]) == (total, abnormal)
    card = labcube.lab_cards(cube, "hot").first()
    assert card["total_observations"] == total
    assert card["avg_score"] == pytest.approx(
        obs.where("loinc_code = 'hot'").agg({"result_value": "avg"}).first()[0])


def test_labels_are_the_most_frequent(data, obs):
    got = {r["loinc_code"]: r for r in labcube.cohort_ranges(labcube.value_cube(obs)).collect()}
    assert None not in got and "only-null" not in got
    votes = Counter(r[3] for r in data if r[2] == "hot" and r[6] is not None)
    assert got["hot"]["observation_name"] == min(votes, key=lambda v: (-votes[v], v))


def test_one_block_and_many(spark, obs):
    assert same_in_one_block_and_many(spark, lambda: labcube.lab_kpis(labcube.value_cube(obs)))


def test_results_are_read_once(obs, spark):
    cube = labcube.value_cube(obs)
    text = plan(labcube.lab_kpis(cube))
    assert "observation_id" not in text and "InMemoryTableScan" not in text  # only the cube is read
    empty = labcube.value_cube(spark.createDataFrame([], SCHEMA))
    assert labcube.lab_kpis(empty).count() == labcube.cohort_ranges(empty).count() == 0
    assert labcube.abnormal_rate(empty).first()["total_observations"] == 0
