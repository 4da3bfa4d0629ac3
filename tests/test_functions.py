import random

import duckdb
import pytest
from pyspark.sql import functions as F

from clinflow import functions as C


def _one(spark, col, schema="x double", value=None):
    return spark.createDataFrame([(value,)], schema).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize("digits", [0, 1, 2, 3])
def test_round_like_a_warehouse(spark, digits):
    rnd = random.Random(digits)
    values = [s / d for d in (3600.0, 86400.0, 24.0, 8.0) for s in rnd.sample(range(-400000, 400000), 400)]
    values += [1.005, -1.005, 0.125, -0.125, 2.5, 1e13 + 0.3, 1e300, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r["v"] for r in df.select(C.round_bin(F.col("x"), digits).alias("v")).collect()]
    con = duckdb.connect()
    expected = [con.execute("SELECT round(?::DOUBLE, ?)", [v, digits]).fetchone()[0] for v in values]
    assert got == expected


def test_round_keeps_null_and_nan(spark):
    assert _one(spark, C.round_bin(F.col("x"), 2)) is None
    assert str(_one(spark, C.round_bin(F.col("x"), 2), value=float("nan"))) == "nan"


def test_ingest_hours_round_decimal_text(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00.9' a, timestamp'2024-01-01 01:00:18.1' b")
    row = df.select(
        C.los_hours(F.col("a"), F.col("b")).alias("h"),  # 3618 s = 1.005 h
        C.los_hours(F.col("b"), F.col("a")).alias("n"),
        C.round_bin(C.gap_seconds(F.col("b"), F.col("a")) / 3600.0, 4).alias("g"),
    ).first()
    assert (row["h"], row["n"]) == (1.01, -1.01)
    assert row["g"] == pytest.approx(1.0048)  # the gap keeps the fraction


def test_safe_div(spark):
    assert _one(spark, C.safe_div(F.lit(1), F.lit(0))) == 0.0
    assert _one(spark, C.safe_div(F.lit(1), F.lit(None).cast("int"))) == 0.0
    assert _one(spark, C.percent(F.lit(1), F.lit(8))) == 12.5


def test_dig(spark):
    schema = "a array<struct<b: array<struct<c: string>>>>, s struct<b: array<struct<c: string>>>"
    df = spark.createDataFrame([
        ([([("x",), ("y",)],), ([("z",)],)], ([("p",)],)),
        ([([],)], ([],)), ([], None), (None, (None,)), ([(None,)], ([None],)),
    ], schema)
    got = [tuple(r) for r in df.select(C.dig("a[].b[].c"), C.dig("s.b[].c")).collect()]
    assert got == [("x", "p")] + [(None, None)] * 4


@pytest.mark.parametrize("ref, patient, episode", [
    ("Patient/x", "x", "Patient/x"), ("x", "x", "x"), ("urn:uuid:x", "urn:uuid:x", "urn:uuid:x"),
    ("a/Patient/x", "a/Patient/x", "a/Patient/x"), (None, None, None),
    ("EpisodeOfCare/EpisodeOfCare/7", "EpisodeOfCare/EpisodeOfCare/7", "7"),
])
def test_references(spark, ref, patient, episode):
    x = F.col("x")
    assert _one(spark, C.strip_prefix(x, "Patient"), "x string", ref) == patient
    assert _one(spark, C.remove_text(x, "EpisodeOfCare/"), "x string", ref) == episode


def test_parsing(spark):
    text = ["2024-03-01T10:00:00-06:00", "2024-03-01T10:00:00.25Z", "2024-03-01", "bad", "", None]
    df = spark.createDataFrame([(t,) for t in text], "x string")
    got = df.select(
        C.parse_instant(F.col("x")).cast("timestamp_ntz").cast("string").alias("t"),
        C.parse_date(F.col("x")).cast("string").alias("d")).collect()
    assert [r["t"] for r in got] == [
        "2024-03-01 16:00:00", "2024-03-01 10:00:00.25", "2024-03-01 00:00:00", None, None, None]
    assert [r["d"] for r in got] == ["2024-03-01"] * 3 + [None] * 3


@pytest.mark.parametrize("session_zone", ["UTC", "America/Chicago"])
def test_wall_clock_ignores_the_session_zone(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        df = spark.sql("SELECT timestamp'2024-07-01T05:00:00Z' t")
        row = df.select(
            F.hour(C.wall_clock(F.col("t"), "UTC")).alias("u"),
            F.hour(C.wall_clock(F.col("t"), "Asia/Tokyo")).alias("j"),
            C.month_start(F.col("t"), "America/Chicago").cast("string").alias("m")).first()
        assert tuple(row) == (5, 14, "2024-07-01")
        twice = spark.sql(  # the repeated hour of Chicago, both times
            "SELECT timestamp'2023-11-05T06:30:00Z' a, timestamp'2023-11-05T07:30:00.000001Z' b")
        assert tuple(map(str, twice.select(*[C.wall_clock(F.col(c), z) for z in (
            "UTC", "America/Chicago") for c in "ab"]).first())) == (
            "2023-11-05 06:30:00", "2023-11-05 07:30:00.000001",
            "2023-11-05 01:30:00", "2023-11-05 01:30:00.000001")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_labels(spark):
    codes = ["IMP", "EMER", "AMB", "HH", "VR", "whatever", None]
    df = spark.createDataFrame([(c,) for c in codes], "x string")
    assert [r[0] for r in df.select(C.class_label(F.col("x"))).collect()] == [
        "Inpatient", "Emergency", "Ambulatory", "Home Health", "Virtual", "Other", "Other"]
    hours = spark.createDataFrame([(h,) for h in (6, 7, 14, 15, 22, 23, 0)], "x int")
    assert [r[0][:3] for r in hours.select(C.admit_shift(F.col("x"))).collect()] == [
        "Nig", "Day", "Day", "Eve", "Eve", "Nig", "Nig"]
    stays = spark.createDataFrame(
        [(float(h),) for h in (0, 3.99, 4, 23.99, 24, 72, 168, 719.99, 720)], "x double")
    assert [r[0] for r in stays.select(C.los_tier(F.col("x"))).collect()] == [
        "< 4h", "< 4h", "4-24h", "4-24h", "1-3 days", "3-7 days", "1-4 weeks", "1-4 weeks",
        "> 1 month"]


def test_range_flag(spark):
    rows = [(1.0, 1.0, 2.0), (2.0, 1.0, 2.0), (0.9, 1.0, 2.0), (2.1, 1.0, 2.0),
            (None, 1.0, 2.0), (1.0, None, 2.0), (1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "v double, lo double, hi double")
    assert [r[0] for r in df.select(C.out_of_range(*map(F.col, ("v", "lo", "hi")))).collect()] == [
        False, False, True, True, None, None, None]


def test_gap_flags(spark):
    day = 86400
    gaps = [None, -1.0, 0.0, 7.0 * day, 7.0 * day + 1, 30.0 * day, 30.0 * day + 1, 90.0 * day, 91.0 * day]
    df = spark.createDataFrame([(g,) for g in gaps], "g double")
    got = df.select(
        C.within_days(F.col("g"), 30), C.readmission_bucket(F.col("g"), (7, 30, 90))).collect()
    assert [tuple(r) for r in got] == [
        (False, "Initial admission"), (False, "7-day readmission"), (True, "7-day readmission"),
        (True, "7-day readmission"), (True, "30-day readmission"), (True, "30-day readmission"),
        (False, "90-day readmission"), (False, "90-day readmission"), (False, "Not a readmission")]
