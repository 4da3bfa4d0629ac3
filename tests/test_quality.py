import pytest
from helpers import rows

from clinflow.plans import quality

ROWS = [("a", "s1", 1), ("a", "s1", 2), ("a", "s2", 3), ("b", None, 4), ("b", None, 5), ("c", "s1", 6)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "id string, sys string, v int")


def test_key_check(table):
    assert tuple(quality.key_check(table, ["id", "sys"], "t").first()) == ("t", 1, 1, 2)
    clean = table.filter("v in (3, 6)")
    assert tuple(quality.key_check(clean, ["id", "sys"], "t").first()) == ("t", 0, 0, 0)


def test_split_and_enforce(table):
    good, bad = quality.split_by_key(table, ["id", "sys"])
    assert rows(good.select("v")) == [(3,), (6,)]
    assert rows(bad.select("v")) == [(1,), (2,), (4,), (5,)]
    keys = ["id", "sys"]
    assert quality.enforce_key(table, keys, "t").count() == 6
    assert quality.enforce_key(table, keys, "t", "quarantine").count() == 2
    with pytest.raises(ValueError, match="violated"):
        quality.enforce_key(table, keys, "t", "fail")
    assert quality.enforce_key(good, keys, "t", "fail").count() == 2


def test_references(spark):
    child = spark.createDataFrame([("p1", 1), ("p1", 2), ("px", 3), ("px", 4), (None, 5)], "p string, v int")
    parent = spark.createDataFrame([("p1",), ("p2",)], "p string")
    assert tuple(quality.referential_check(child, parent, "p", "c").first()) == ("c", 3, "WARN")
    assert tuple(quality.referential_check(child.filter("p = 'p1'"), parent, "p", "c").first()) == (
        "c", 0, "OK")
    assert rows(quality.orphan_rows(child, parent, "p").select("v")) == [(3,), (4,), (5,)]


def test_links_and_counts(spark):
    fact = spark.createDataFrame([("e1", "p1"), ("e2", "p9")], "encounter_id string, patient_id string")
    obs = spark.createDataFrame([("o1", "e1"), ("o2", "e1"), ("o3", "ex"), ("o4", None)],
                                "observation_id string, encounter_id string")
    patients = spark.createDataFrame([("p1",)], "patient_id string")
    assert quality.link_coverage(obs, fact).first()[0] == 2
    assert quality.link_coverage(obs.filter("false"), fact).first()[0] == 0
    tables = {"fact_patient_encounters": fact, "dim_patients": patients, "dim_clinical_observations": obs}
    got = {r["check"].split(".")[0]: (r["violations"], r["status"])
           for r in quality.foreign_key_checks(tables).collect()}
    assert got == {"fact_patient_encounters": (1, "WARN"), "dim_clinical_observations": (2, "WARN")}
    assert dict(map(tuple, quality.table_counts(tables).collect())) == {
        "fact_patient_encounters": 2, "dim_patients": 1, "dim_clinical_observations": 4}
