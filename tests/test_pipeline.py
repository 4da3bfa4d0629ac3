import csv

import pytest
from helpers import by, rows, write_lines
from pyspark.sql import functions as F

from clinflow.operators import materialize, scratch_path
from clinflow.operators import storage
from clinflow.plans import pipeline
from clinflow.schemas import EXPORTS, FLAT, KEYS, TABLES
from clinflow.sinks import create_tables, publish, save_table, write_csv, write_parquet
from clinflow.plans.flatten import FLATTENERS
from clinflow.sinks.writers import drop_versions, location, read_csv
from clinflow.sources import read_ndjson, read_parquet_tables, row_count, split_ndjson

LOINC = "http://loinc.org"


def _source(folder):
    write_lines(folder, "Patient", [
        {"id": "p1", "gender": "male", "name": [{"family": 'O"Neil, Jr', "given": ["José"]}]},
        {"id": "p2", "gender": "female"}])
    encounters = []
    for i in range(6):
        encounters.append({
            "id": f"e{i}", "status": "finished", "class": {"code": ["IMP", "EMER", "AMB"][i % 3]},
            "type": [{"text": "visit", "coding": [{"code": "1"}]}],
            "subject": {"reference": "Patient/" + ("p1" if i < 4 else "p2" if i < 5 else "ghost")},
            "episodeOfCare": [{"reference": "EpisodeOfCare/ep1"}],
            "period": {"start": f"2024-01-{1 + 3 * i:02d}T08:00:00Z",
                       "end": f"2024-01-{2 + 3 * i:02d}T08:00:00Z"}})
    write_lines(folder, "Encounter", encounters)
    write_lines(folder, "Condition", [
        {"id": "c1", "subject": {"reference": "Patient/p1"}, "encounter": {"reference": "Encounter/e0"},
         "code": {"coding": [{"system": "s", "code": "1"}, {"system": "t", "code": "2"}]}},
        {"id": "c2"}])
    for shard in range(2):
        write_lines(folder, "Observation", [
            {"id": f"o{shard}-{i}", "status": "final", "subject": {"reference": "Patient/p1"},
             "encounter": {"reference": "Encounter/" + ("e0" if i % 2 else "e5")},
             "code": {"coding": [{"system": LOINC, "code": "1-1", "display": "n"}]},
             "valueQuantity": {"value": i, "unit": "mg"}} for i in range(20)], shard)
    write_lines(folder, "EpisodeOfCare", [
        {"id": "ep1", "patient": {"reference": "Patient/p1"}, "status": "active",
         "period": {"start": "2024-01-01T00:00:00Z", "end": "2024-01-03T00:00:00Z"}}])


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    _source(root / "raw")
    return root, pipeline.run(spark, str(root / "raw"), str(root / "work"))


def test_counts_of_all_stages(done):
    _, counts = done
    assert counts["ingest"] == {
        "dim_patients": 2, "fact_encounters": 6, "dim_diagnoses": 3, "dim_observations": 40,
        "dim_episodes": 1}
    assert counts["load"] == {
        "dim_loinc_reference": 1, "dim_patients": 2, "dim_diagnoses": 3,
        "dim_clinical_observations": 40, "dim_episodes": 1, "fact_patient_encounters": 5}
    assert counts["models"] == {
        "mart_los_kpis": 3, "analytics_readmissions": 5, "analytics_throughput": 5,
        "analytics_lab_kpis": 1}
    assert set(counts["export"]) == set(EXPORTS)


def test_bad_lines_are_logged(spark, tmp_path, caplog):
    _source(tmp_path / "raw")
    write_lines(tmp_path / "raw", "Observation", [
        "{broken", {"id": "x", "valueQuantity": {"value": "high"}}], shard=5)
    with caplog.at_level("WARNING"):
        counts = pipeline.ingest(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert counts["dim_observations"] == 40  # lines without a LOINC coding add no row
    assert "Observation: 2 lines did not parse" in caplog.text


def test_fact_by_year(spark, done, tmp_path):
    root, counts = done
    loaded = pipeline.load(spark, f"{root}/work/parquet", str(tmp_path / "w"), fact_by_year=True)
    assert loaded == counts["load"]
    assert (tmp_path / "w/fact_patient_encounters/admit_year=2024").exists()
    fact = read_parquet_tables(spark, str(tmp_path / "w"), ["fact_patient_encounters"])
    stored = spark.read.parquet(f"{root}/work/warehouse/fact_patient_encounters")
    assert rows(fact["fact_patient_encounters"]) == rows(stored)


def test_stored_schemas(spark, done):
    root, _ = done
    for folder, schemas in (("parquet", FLAT), ("warehouse", TABLES)):
        for name, schema in schemas.items():
            stored = spark.read.parquet(f"{root}/work/{folder}/{name}").schema
            assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in schema]
    assert row_count(spark, f"{root}/work/warehouse/dim_diagnoses") == 3


def test_stored_models(spark, done):
    root, _ = done
    read = by(spark.read.parquet(f"{root}/work/warehouse/analytics_readmissions"), "encounter_id")
    assert read["e1"]["readmission_type"] == "7-day readmission"
    assert read["e1"]["days_since_prev_discharge"] == 2.0
    lab = spark.read.parquet(f"{root}/work/warehouse/analytics_lab_kpis").first()
    assert (lab["total_observations"], lab["p2_5"], lab["abnormal_count"]) == (40, 0.0, 0)


def test_validation(spark, done):
    root, _ = done
    checks = pipeline.validate(spark, f"{root}/work/warehouse")
    links = {r["check"].split(" ")[0]: r["violations"] for r in checks["links"].collect()}
    assert links == {
        "fact_patient_encounters.patient_id": 0, "dim_diagnoses.encounter_id": 1,
        "dim_clinical_observations.encounter_id": 20}
    assert checks["coverage"].first()[0] == 20
    keys = {r["table"]: (r["duplicate_keys"], r["null_key_rows"]) for r in checks["keys"].collect()}
    assert keys.pop("dim_diagnoses") == (0, 1)  # a condition without coding has no system
    assert set(keys) == set(KEYS) - {"dim_diagnoses"} and set(keys.values()) == {(0, 0)}
    assert checks["counts"].count() == 6
    links = pipeline.validate(spark, f"{root}/work/warehouse", with_models=True)["links"]
    assert links.count() == 5
    assert links.filter("check like 'analytics%' and violations = 0").count() == 2


def test_key_violations_at_load(spark, done, tmp_path):
    root, counts = done
    flat = f"{root}/work/parquet"
    kept = pipeline.load(spark, flat, str(tmp_path / "w"), on_violation="quarantine")
    apart = {k: n for k, n in kept.items() if k.endswith("_quarantine")}
    assert {k: n for k, n in apart.items() if n} == {"dim_diagnoses_quarantine": 1}
    for table, n in counts["load"].items():  # the row without a coding system is kept apart
        assert kept[table] + apart.get(f"{table}_quarantine", 0) == n
    bad = spark.read.parquet(str(tmp_path / "w/dim_diagnoses_quarantine"))
    assert bad.columns == TABLES["dim_diagnoses"].fieldNames() and bad.count() == 1
    with pytest.raises(ValueError, match="dim_diagnoses"):
        pipeline.load(spark, flat, str(tmp_path / "v"), on_violation="fail")


def test_csv_is_plain_csv(done):
    root, _ = done
    files = [p for p in (root / "work/dashboard/dim_patients.csv").glob("part-*.csv")]
    read = [r for f in files for r in csv.DictReader(f.open(encoding="utf-8"))]
    assert {r["name_family"] for r in read} == {'O"Neil, Jr', ""}
    assert "José" in {r["name_given"] for r in read}
    assert list(read[0]) == TABLES["dim_patients"].fieldNames()
    mart = list((root / "work/dashboard/mart_los_kpis.csv").glob("part-*.csv"))
    assert len(mart) == 1


def test_rerun_gives_the_same(spark, done):
    root, counts = done
    before = rows(spark.read.parquet(f"{root}/work/warehouse/fact_patient_encounters"))
    assert pipeline.load(spark, f"{root}/work/parquet", f"{root}/work/warehouse") == counts["load"]
    assert rows(spark.read.parquet(f"{root}/work/warehouse/fact_patient_encounters")) == before


def test_csv_round_trip_keeps_odd_text(spark, tmp_path):
    data = [("a", 'say "x", y'), ("b", ""), ("c", None), ("d", "two\nlines"), ("e", "back\\slash")]
    df = spark.createDataFrame(data, "k string, v string")
    assert write_csv(df, str(tmp_path / "t.csv")) == 5
    assert rows(read_csv(spark, str(tmp_path / "t.csv"), df.schema)) == rows(df)


def test_tables_and_views(spark, tmp_path):
    spark.sql(f"CREATE DATABASE star LOCATION '{tmp_path}/star'")
    create_tables(spark, "star")
    create_tables(spark, "star")
    assert spark.table("star.dim_episodes").count() == 0
    df = spark.range(3).selectExpr(
        "'T' AS episode_type", "string(id) AS episode_id", "'p' AS patient_id", "'a' AS episode_status",
        "current_timestamp() AS episode_start", "current_timestamp() AS episode_end",
        "0.5D AS episode_los_hours", "1 AS surplus")
    for _ in range(2):  # a full refresh, matched by name
        assert save_table(df, "star.dim_episodes") == 3
    stored = spark.table("star.dim_episodes")
    assert stored.columns == TABLES["dim_episodes"].fieldNames() and stored.count() == 3
    publish(stored.filter("episode_id > 0"), "later_episodes", "view")
    publish(stored, "star.copied")
    assert spark.table("later_episodes").count() == 2 and spark.table("star.copied").count() == 3
    spark.sql("DROP DATABASE star CASCADE")


def test_partitioned_write(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "int(id % 4) AS admit_year")
    path = str(tmp_path / "t")
    assert write_parquet(df, path, ["admit_year"]) == 100
    assert len(list((tmp_path / "t").glob("admit_year=*"))) == 4
    assert read_parquet_tables(spark, str(tmp_path), ["t"])["t"].filter("admit_year = 2").count() == 25


def test_scratch_folder(spark, monkeypatch):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert rows(materialize(spark.range(5).toDF("id"))) == [(i,) for i in range(5)]

    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, key, default=None):
            return self.master if key == "spark.master" else None

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    with pytest.raises(RuntimeError, match="checkpoint"):
        storage.scratch_root(Session("yarn"))
    assert storage.scratch_root(Session("local[2]")) == storage.scratch_root(Session("local[4]"))


def test_bad_lines_are_kept_aside(spark, tmp_path):
    write_lines(tmp_path / "raw", "Patient", [
        "{broken", {"id": "p1"}, {"id": "p2", "name": "not an array"}, '{"id": "p3", "gender": "male"}'])
    good, bad = split_ndjson(spark, str(tmp_path / "raw"), "Patient", str(tmp_path / "stage"))
    assert sorted(r["id"] for r in good.collect()) == ["p1", "p3"]
    kept = {r["line"]: r["file"] for r in bad.collect()}
    assert set(kept) == {"{broken", '{"id": "p2", "name": "not an array"}'}
    assert all(f.endswith("Patient_000.ndjson") for f in kept.values())
    assert FLATTENERS["dim_patients"][1](good).count() == 2
    raw = read_ndjson(spark, str(tmp_path / "raw"), "Patient")
    assert FLATTENERS["dim_patients"][1](raw).where("patient_id IS NULL").count() == 0
    _source(tmp_path / "all")
    write_lines(tmp_path / "all", "EpisodeOfCare", ["{cut"], shard=7)
    pipeline.ingest(spark, str(tmp_path / "all"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/dim_episodes")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out/bad_lines/EpisodeOfCare")).first()["line"] == "{cut"


def _failing(spark):
    return spark.range(100).selectExpr("id", "assert_true(id < 90) IS NULL AS ok")


def test_a_refresh_that_fails_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(spark.range(5).selectExpr("id", "true AS ok"), path)
    with pytest.raises(Exception, match="assert|USER_RAISED"):
        write_parquet(_failing(spark), path)
    assert spark.read.parquet(path).count() == 5
    # A plan may read what it refreshes.
    assert write_parquet(spark.read.parquet(path).where("id > 1"), path) == 3
    assert spark.read.parquet(path).count() == 3
    # A run that ended between the two renames.
    (tmp_path / "t").rename(tmp_path / "t.previous")
    assert write_parquet(spark.range(2).toDF("id"), path) == 2
    assert spark.read.parquet(path).count() == 2 and not (tmp_path / "t.previous").exists()


def test_tables_in_versions(spark, tmp_path):
    name, root = "kept_outside", str(tmp_path / "outside")
    good = spark.range(5).selectExpr("id", "true AS ok")
    assert save_table(good, name, root) == 5
    before = spark.table(name)
    with pytest.raises(Exception, match="assert|USER_RAISED"):
        save_table(_failing(spark), name)
    assert spark.table(name).count() == 5
    assert save_table(good.where("id < 2"), name) == 2
    assert spark.table(name).count() == 2 and before.count() in (2, 5)
    assert location(spark, name).split(":", 1)[-1].startswith(root)  # an external table stays where it was
    assert save_table(good.withColumn("more", F.lit("x")), name) == 5
    assert spark.table(name).columns == ["id", "ok", "more"]
    assert drop_versions(spark, name) >= 2 and spark.table(name).count() == 5
    assert drop_versions(spark, name) == 0
    for n in (40, 20):
        parts = spark.range(n).selectExpr("id", "id % 4 AS part")
        assert save_table(parts, "in_parts", str(tmp_path / "parts"), ["part"]) == n
        assert spark.table("in_parts").where("part = 1").count() == n // 4
    spark.sql(f"DROP TABLE {name}")
    spark.sql("DROP TABLE in_parts")
