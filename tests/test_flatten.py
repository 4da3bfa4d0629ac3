import gzip
from datetime import date

from helpers import by, read, rows, write_lines
from pyspark.sql import functions as F

from clinflow import roles
from clinflow.operators import dedup_first, explode_entries
from clinflow.plans import flatten
from clinflow.schemas import FLAT, RESOURCES
from clinflow.sources import corrupt_lines, read_ndjson

LOINC = "http://loinc.org"


def _same_columns(df, table):
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in FLAT[table].fields]


def test_patients(spark, tmp_path):
    raw = read(spark, tmp_path, "Patient", [
        {"id": "1", "gender": "female", "birthDate": "1990-01-02", "extra": {"a": 1},
         "name": [{"family": "A", "given": ["B", "C"]}, {"family": "old"}],
         "address": [{"city": "X", "state": "S", "country": "US"}], "maritalStatus": {"text": "M"}},
        {"id": "2", "name": [], "address": [{}]},
        {"id": "3", "name": [{"family": "F", "given": []}]},
        "",
    ])
    df = flatten.flatten_patients(raw)
    _same_columns(df, "dim_patients")
    got = by(df, "patient_id")
    assert tuple(got["1"]) == ("1", "female", "1990-01-02", "A", "B", "X", "S", "US", "M")
    assert tuple(got["2"])[1:] == (None,) * 8
    assert got["3"]["name_family"] == "F" and got["3"]["name_given"] is None
    assert len(got) == 3


def test_encounters(spark, tmp_path):
    base = {"status": "finished", "class": {"code": "AMB"}, "subject": {"reference": "Patient/p"}}
    raw = read(spark, tmp_path, "Encounter", [
        {**base, "id": "a", "type": [
            {"text": "first", "coding": [{"code": "11"}, {"code": "12"}]}, {"text": "second"}],
         "period": {"start": "2024-01-01T00:00:00-06:00", "end": "2024-01-01T07:00:18Z"},
         "episodeOfCare": [{"reference": "EpisodeOfCare/e"}],
         "serviceProvider": {"display": "H"}, "location": [{"location": {"display": "W"}}],
         "reasonCode": [{"coding": [{"display": "R"}]}]},
        {**base, "id": "b", "type": [], "period": {"start": "nonsense", "end": "2024-01-01"}},
        {**base, "id": "c", "type": [{"coding": []}], "period": {"start": "2024-01-02"}},
        {**base, "id": "d", "subject": {"reference": "urn:uuid:p"},
         "period": {"start": "2024-01-02T00:00:00Z", "end": "2024-01-01T00:00:00Z"}},
        {**base, "id": "a", "status": "entered-in-error", "type": [{"text": "zzz"}]},
    ])
    df = flatten.flatten_encounters(raw)
    _same_columns(df, "fact_encounters")
    got = by(df, "encounter_id")
    assert len(got) == 4
    a = got["a"]  # the version with the smaller status text wins, on every run
    assert a["status"] == "entered-in-error" and a["encounter_type"] == "zzz"
    assert got["b"]["admit_timestamp"] is None and got["b"]["los_hours"] is None
    assert got["c"]["encounter_snomed_code"] is None
    assert got["d"]["los_hours"] == -24.0 and got["d"]["patient_id"] == "urn:uuid:p"

    only = flatten.flatten_encounters(raw.filter("id = 'a' and status = 'finished'")).first()
    assert (only["encounter_type"], only["encounter_snomed_code"]) == ("first", "11")
    assert only["los_hours"] == 1.01 and only["patient_id"] == "p"
    assert only["episode_of_care_ref"] == "EpisodeOfCare/e" and only["reason_for_visit"] == "R"
    assert (only["service_provider"], only["location_display"]) == ("H", "W")


def test_conditions(spark, tmp_path):
    coding = [{"system": "s1", "code": "1", "display": "one"},
              {"system": "s2", "code": "2", "display": "two"},
              {"system": "s1", "code": "9", "display": "later"}]
    raw = read(spark, tmp_path, "Condition", [
        {"id": "a", "code": {"coding": coding}, "subject": {"reference": "Patient/p"},
         "encounter": {"reference": "Encounter/e"},
         "clinicalStatus": {"coding": [{"code": "active"}]},
         "verificationStatus": {"coding": []}, "category": [{"coding": [{"display": "C"}]}],
         "onsetDateTime": "2024-01-01T00:00:00Z", "abatementDateTime": "broken",
         "recordedDate": "2024-01-01T23:30:00-09:00"},
        {"id": "b", "code": {"coding": []}}, {"id": "c"},
    ])
    df = flatten.flatten_conditions(raw)
    _same_columns(df, "dim_diagnoses")
    got = {(r["condition_id"], r["coding_system"]): r for r in df.collect()}
    assert set(got) == {("a", "s1"), ("a", "s2"), ("b", None), ("c", None)}
    a = got["a", "s1"]
    assert a["diagnosis_code"] == "1"  # first coding of the system
    assert a["recorded_date"] == date(2024, 1, 1)
    assert a["is_resolved"] and a["abatement_date"] is None
    assert a["clinical_status"] == "active" and a["verification_status"] is None
    assert not got["c", None]["is_resolved"]


def test_observations_from_shards(spark, tmp_path):
    def obs(rid, codings, **more):
        return {"id": rid, "status": "final", "code": {"coding": codings}, **more}

    loinc = {"system": LOINC, "code": "1-1", "display": "n"}
    write_lines(tmp_path, "Observation", [
        obs("a", [{"system": "local", "code": "x"}, loinc, {**loinc, "code": "2-2"}],
            valueQuantity={"value": 3, "unit": "mg"}),
        obs("b", [{"system": "local", "code": "x"}]), obs("c", [{"code": "no system"}]), obs("d", []),
    ])
    write_lines(tmp_path, "Observation", [
        obs("a", [loinc], valueQuantity={"value": 2.5, "unit": "mg"}),
        obs("e", [loinc], valueCodeableConcept={"text": "pos"}),
    ], shard=7)
    df = flatten.flatten_observations(read_ndjson(spark, str(tmp_path), "Observation"))
    _same_columns(df, "dim_observations")
    got = {(r["observation_id"], r["loinc_code"]): r for r in df.collect()}
    assert set(got) == {("a", "1-1"), ("a", "2-2"), ("e", "1-1")}
    assert got["a", "2-2"]["result_value"] == 3.0
    assert got["e", "1-1"]["result_value"] is None and got["e", "1-1"]["result_text"] == "pos"


def test_episodes(spark, tmp_path):
    raw = read(spark, tmp_path, "EpisodeOfCare", [
        {"id": "e", "patient": {"reference": "Patient/p"}, "status": "active",
         "type": [{"coding": [{"display": "T"}]}],
         "period": {"start": "2024-01-01T00:00:00Z"}}, {"id": "f", "type": []}])
    df = flatten.flatten_episodes(raw)
    _same_columns(df, "dim_episodes")
    got = by(df, "episode_id")
    assert got["e"]["episode_type"] == "T" and got["e"]["patient_id"] == "p"
    assert got["e"]["episode_start"] is not None and got["f"]["episode_end"] is None


def test_bad_lines_are_kept_and_counted(spark, tmp_path):
    raw = read(spark, tmp_path, "Observation", [
        {"id": "a", "valueQuantity": {"value": 1.5}}, "{not json",
        {"id": "b", "valueQuantity": {"value": "text"}}, {"id": "c", "other": 1}])
    counts = corrupt_lines(raw).first()
    assert (counts["n_lines"], counts["n_corrupt"], counts["n_id"]) == (4, 2, 3)
    assert rows(raw.select("id", dig_value())) == [("a", 1.5), ("b", None), ("c", None), (None, None)]


def dig_value():
    return F.col("valueQuantity.value")


def test_readers_run_no_job_and_take_a_list(spark, tmp_path):
    write_lines(tmp_path, "Patient", [{"id": "1"}])
    write_lines(tmp_path, "Patient", [{"id": "2"}], shard=1)
    paths = [str(p) for p in sorted(tmp_path.iterdir())]
    assert read_ndjson(spark, paths[:1], "Patient").count() == 1
    assert read_ndjson(spark, str(tmp_path), "Patient").count() == 2
    assert "_corrupt_record" not in [f.name for f in RESOURCES["Patient"].fields]


def test_written_lines_take_a_fraction_of_their_text_in_files_of_bounded_length(
        spark, tmp_path, monkeypatch):
    monkeypatch.setattr(roles, "FILE_LINES", 700, raising=False)
    made = spark.range(0, 3000, 1, 2).select(
        F.col("id").cast("string").alias("id"), F.lit("final").alias("status"),
        F.struct(F.array(F.struct(
            F.lit(LOINC).alias("system"), F.concat(F.lit("c"), F.col("id") % 9).alias("code"),
            F.when(F.col("id") % 2 == 0, "é \n").alias("display"))).alias("coding")).alias("code"))
    for shard in (0, 1):
        roles.write_ndjson(made.where(F.col("id") % 2 == shard), str(tmp_path), "Observation", shard)
    files = sorted(tmp_path.glob("Observation_00[01].ndjson/part-*"))
    lines = [gzip.decompress(f.read_bytes()).splitlines(True) for f in files]
    assert len(files) == 8 and all(len(part) <= 700 for part in lines)
    text = sum(len(line) for part in lines for line in part)
    assert sum(f.stat().st_size for f in files) < text / 4
    found = read_ndjson(spark, str(tmp_path), "Observation")
    assert rows(found.select("id", "status", "code.coding")) == rows(
        made.select("id", "status", "code.coding"))


def test_dedup_does_not_depend_on_partitioning(spark):
    data = [(f"k{i % 5}", i % 3, f"v{i % 7}") for i in range(200)] + [(None, 1, "n"), (None, 0, "m")]
    df = spark.createDataFrame(data, "k string, pos int, v string")
    first = rows(dedup_first(df, ["k"], ["pos"]))
    for n in (1, 3, 16):
        assert rows(dedup_first(df.repartition(n), ["k"], ["pos"])) == first
    assert (None, 0, "m") in first and len(first) == 6
    assert rows(dedup_first(dedup_first(df, ["k"], ["pos"]), ["k"])) == first
    assert dedup_first(df.select("k"), ["k"]).count() == 6


def test_explode_keeps_empty_arrays(spark):
    df = spark.createDataFrame([("a", ["x", "y"]), ("b", []), ("c", None)], "k string, v array<string>")
    got = rows(explode_entries(df, F.col("v"), "e").select("k", "_pos", "e"))
    assert got == [("a", 0, "x"), ("a", 1, "y"), ("b", None, None), ("c", None, None)]
