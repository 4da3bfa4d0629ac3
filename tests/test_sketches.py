"""Mergeable sketches: parts merged equal the whole within the bound."""

import pytest
from helpers import plan

from clinflow.operators import sketches
from clinflow.plans import measures, models
from clinflow.sinks import write_parquet


@pytest.fixture(scope="module")
def values(spark):
    # A third of all rows in one group; one group without a value.
    return spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('g', id % 5)) AS g", "int(id % 7) AS part",
        "double((id * 7919) % 10007) AS x", "string(id % 1500) AS who").unionByName(
        spark.sql("SELECT 'none' AS g, 1 AS part, CAST(NULL AS double) AS x, 'w' AS who")).cache()


def test_merged_parts_equal_the_whole(spark, values, tmp_path):
    write_parquet(sketches.sketch(values, ["g", "part"], "x", "who"), str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    merged = sketches.merge(stored, ["g"])
    got = {r["g"]: r for r in merged.select(
        "*", sketches.quantile(0.5).alias("p50"), sketches.quantile(0.9).alias("p90"),
        sketches.above(sketches.quantile(0.9)).alias("above"), sketches.stddev().alias("sd"),
        sketches.distinct_count().alias("who")).collect()}
    whole = {r["g"]: r for r in values.groupBy("g").agg(
        {"x": "count", "*": "count"}).collect()}
    assert set(got) == set(whole)
    for g, r in got.items():
        mine = sorted(v[0] for v in values.where(f"g = '{g}' AND x IS NOT NULL").select("x").collect())
        assert r["n"] == len(mine)
        if not mine:
            assert r["p50"] is None and r["value_sketch"] is None
            continue
        for p, value in ((0.5, r["p50"]), (0.9, r["p90"])):
            rank = sum(v <= value for v in mine) / len(mine)
            assert abs(rank - p) <= 2 * sketches.rank_error() + 1 / len(mine)
        exact = values.where(f"g = '{g}'").selectExpr("stddev_samp(x)", "avg(x)", "min(x)", "max(x)").first()
        assert r["sd"] == pytest.approx(exact[0]) and r["mean"] == pytest.approx(exact[1])
        assert (r["least"], r["largest"]) == (exact[2], exact[3])
        n = values.where(f"g = '{g}'").select("who").distinct().count()
        assert abs(r["who"] - n) <= 4 * sketches.distinct_error() * n + 1
        assert abs(r["above"] - sum(v > r["p90"] for v in mine)) <= 2 * sketches.rank_error() * len(mine) + 1


def test_small_groups_are_exact(spark):
    few = spark.createDataFrame([("a", float(i), "p") for i in range(1, 11)], "g string, x double, who string")
    r = sketches.sketch(few, ["g"], "x").select(
        sketches.quantile(0.5).alias("p50"), sketches.above(sketches.quantile(0.9)).alias("above")).first()
    assert (r["p50"], r["above"]) == (5.0, 1)


def test_no_exact_counts_behind_the_approximate_statistics(spark):
    stg = spark.createDataFrame(
        [("IMP", "Inpatient", float(i), i % 2 == 0, "< 4h") for i in range(50)],
        "encounter_class string, encounter_class_label string, los_hours double, "
        "is_weekend_admission boolean, los_tier string")
    text = plan(models.los_kpis(stg, approx=True))
    assert text.count("Exchange") == 1 and "Join" not in text
    assert models.los_kpis(stg, approx=True).first()["long_stay_outlier_count"] == 5
    assert models.los_kpis(stg.limit(0), approx=True).count() == 0


def test_windows_are_data(spark):
    readm = spark.sql("""
        SELECT * FROM VALUES
            ('IMP', 0), ('IMP', 7), ('IMP', 31), ('IMP', 60), ('EMER', 91), ('EMER', -1), ('IMP', NULL)
            AS t(encounter_class, gap)""").selectExpr(
        "encounter_class", "timestamp'2024-06-01' AS admit_timestamp",
        "timestamp'2024-06-01' - make_dt_interval(gap) AS prev_discharge_timestamp",
        "timestamp'2024-06-02' AS discharge_timestamp",
        "timestamp'2024-06-02' + make_dt_interval(gap) AS next_admit_timestamp",
        "double(gap) AS days_since_prev_discharge")
    got = {(r["encounter_class"], r["window_days"]): r
           for r in measures.readmission_windows(readm, by=["encounter_class"]).collect()}
    assert [got["IMP", d]["readmissions"] for d in (7, 30, 60, 90)] == [2, 2, 4, 4]
    assert got["IMP", 60]["readmission_rate_pct"] == pytest.approx(80.0)
    assert got["IMP", 60]["avg_days_to_readmission"] == pytest.approx((0 + 7 + 31 + 60) / 4)
    assert [got["EMER", d]["index_discharges"] for d in (7, 30, 60, 90)] == [0, 0, 0, 0]
    own = measures.readmission_windows(readm, [(91, "a quarter")], index_classes=["EMER"]).collect()
    assert [(r["window"], r["readmissions"]) for r in own] == [("a quarter", 1)]
