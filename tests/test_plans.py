"""Shape of the physical plans: what must not be shuffled, broadcast or left out of the scan."""

import re

import pytest
from helpers import plan, rows

from clinflow.operators import add_history, materialize, value_counts
from clinflow.plans import measures, models, quality, reports, warehouse
from clinflow.schemas import TABLES
from clinflow.sinks import save_bucketed, write_parquet


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    out = {}
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}")
        out[name] = spark.read.schema(schema).parquet(f"{root}/{name}")
    return out


@pytest.fixture(scope="module")
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_staging_filters_reach_the_scan(stored):
    text = plan(models.stg_encounters(stored["fact_patient_encounters"]))
    assert "Exchange" not in text
    for pushed in ("IsNotNull(admit_timestamp)", "GreaterThanOrEqual(los_hours,0.0)", "LessThan(los_hours,8760.0)"):
        assert pushed in text


def test_readmissions_sort_each_block_once(stored):
    stg = models.stg_encounters(stored["fact_patient_encounters"])
    text = plan(models.readmissions(stg))
    # The blocks of a patient; the other exchanges are those of the summary of border groups.
    assert text.count("hashpartitioning(patient_id") == 3 and "rangepartitioning" not in text
    assert text.count("SortMergeJoin") == 0 and text.count("BroadcastHashJoin") == 2


def test_lab_plans_read_only_their_columns(stored):
    text = plan(models.lab_kpis(stored["dim_clinical_observations"]))
    assert "result_text" not in text and "observation_id" not in text


def test_los_mart_combines_before_its_shuffles(stored):
    stg = models.stg_encounters(stored["fact_patient_encounters"])
    assert "partial_count" in plan(value_counts(stg, ["encounter_class"], "los_hours"))
    assert "result_text" not in plan(models.los_kpis(stg))


def test_nothing_is_crossed_or_sent_to_python(stored, no_broadcast):
    fact, obs = stored["fact_patient_encounters"], stored["dim_clinical_observations"]
    stg = models.stg_encounters(fact)
    ranges = stored["dim_loinc_reference"]
    plans = {
        "readmissions": models.readmissions(stg),
        "throughput": models.throughput(stored["dim_episodes"], stg),
        "lab": models.lab_kpis(obs, ranges),
        "ranges": warehouse.reference_ranges(obs),
        "flags": warehouse.flag_abnormal(obs, ranges),
        "fact": warehouse.build_encounters(fact.drop("los_days"), stored["dim_patients"]),
        "links": quality.link_coverage(obs, fact),
        "core": measures.core_kpis(fact, ["encounter_class"]),
    }
    for name, df in plans.items():
        text = plan(df)
        for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
            assert unwanted not in text, name
        if name != "links":
            assert "SinglePartition" not in text, name


def test_a_single_code_reaches_the_scan(spark, tmp_path):
    obs = spark.range(1000).selectExpr(
        "concat('c', id % 50) AS loinc_code", "double(id) AS result_value", "string(id % 2) AS unit")
    write_parquet(obs, str(tmp_path / "obs"), bloom=["loinc_code"])
    stored = spark.read.parquet(str(tmp_path / "obs"))
    assert "EqualTo(loinc_code,c7)" in plan(measures.avg_result(stored, "c7"))
    assert measures.avg_result(stored, "c7").first()[0] == 482.0
    got = {r["unit"]: r["avg_result"] for r in measures.avg_result(stored, "c7", ["unit"]).collect()}
    assert got == {"1": 482.0, "0": None}
    assert measures.avg_result(stored, "none").first()[0] is None


def test_links_take_two_scans(spark, stored):
    text = plan(quality.link_coverage(
        stored["dim_clinical_observations"], stored["fact_patient_encounters"]))
    assert text.count("FileScan") == 2 and text.count("ReadSchema: struct<encounter_id:string>") == 2


def test_a_patient_sequence_is_ordered_by_its_blocks(spark, stored):
    stg = models.stg_encounters(stored["fact_patient_encounters"])
    text = plan(reports.patient_sequence(models.readmissions(stg, ordered_output=True), in_order=True))
    assert "rangepartitioning" not in text and "REPARTITION_BY_NUM" in text


def test_ordered_output_is_the_global_order(spark):
    df = materialize(spark.range(5000).selectExpr(
        "IF(id % 3 = 0, 'hot', IF(id % 7 = 0, NULL, string(id % 40))) AS k", "id * 7919 % 5000 AS at"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = add_history(df, ["k"], ["at"], prev={"p": "at"}, seq="n", ordered_output=True).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == df.selectExpr(
        "k", "at", "lag(at) OVER (PARTITION BY k ORDER BY at) AS p",
        "CAST(row_number() OVER (PARTITION BY k ORDER BY at) AS bigint) AS n").orderBy("k", "n").collect()


@pytest.mark.parametrize("key", ["encounter_id", "episode_id"])
def test_bucketed_tables_meet_without_a_shuffle(spark, no_broadcast, tmp_path, key):
    child = spark.range(3000).selectExpr(
        f"IF(id % 3 = 0, 'hot', IF(id % 10 = 1, NULL, string(id % 500))) AS {key}", "id AS v")
    parent = spark.range(400).selectExpr(f"IF(id = 0, 'hot', string(id)) AS {key}", "id % 4 AS class")
    for _ in range(2):  # the second time is a refresh
        assert save_bucketed(child, "b_child", key, 8, str(tmp_path / "child")) == 3000
        assert save_bucketed(parent, "b_parent", key, 8, str(tmp_path / "parent")) == 400
    try:
        joined = quality.linked_rows(spark.table("b_child"), spark.table("b_parent"), key)
        text = plan(joined)
        assert "Exchange" not in text and "SortMergeJoin" in text
        assert rows(joined.select(key, "v", "class")) == rows(child.join(parent, key).select(key, "v", "class"))
        counted = plan(spark.table("b_child").groupBy(key).count())
        assert "Exchange" not in counted
    finally:
        spark.sql("DROP TABLE b_child")
        spark.sql("DROP TABLE b_parent")


def test_one_plan_at_every_size(spark):
    def shape(df):
        text = plan(add_history(materialize(df), ["k"], ["at"], seq="n", total="t"))
        return re.findall(r"^[ +:-]*(?:\* ?\(\d+\) )?([A-Z]\w+)", text, re.M)

    small = spark.range(3).selectExpr("string(id) AS k", "id AS at")
    large = spark.range(100_000).selectExpr("IF(id < 50000, 'hot', string(id)) AS k", "id AS at")
    found = shape(small)
    assert found == shape(large) and "Window" in found
    assert "SortMergeJoin" not in found and "BroadcastNestedLoopJoin" not in found
