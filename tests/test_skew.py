"""Windows in blocks give the same rows as one window over everything."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinflow.operators import add_history, cut, value_counts, with_ranks
from clinflow.operators.quantiles import percentile_at
from clinflow.operators.skew import BLOCK, border_rows


def _rows(seed=3):
    """A third of all rows belongs to one key, with many equal times; one key is NULL."""
    rnd = random.Random(seed)
    keys = ["hot"] * 400 + [None] * 150 + [f"k{i % 90}" for i in range(650)]
    return [(k, rnd.randrange(40), f"id{i:05d}", f"v{rnd.randrange(9)}") for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(_rows(), "k string, at int, id string, v string").repartition(6)


@pytest.fixture(params=[1, 3, 8, 29])
def partitions(spark, request):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, (str(request.param), "false")):
        spark.conf.set(name, value)
    yield request.param
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def _history(df):
    return add_history(
        df, ["k"], ["at", "id"], prev={"prev_id": "id", "prev_v": "v"}, following={"next_id": "id"},
        seq="seq", total="total")


def test_history_in_blocks(events, partitions):
    group = W.partitionBy("k")
    along = group.orderBy("at", "id")
    plain = events.withColumns({
        "prev_id": F.lag("id").over(along), "prev_v": F.lag("v").over(along),
        "next_id": F.lead("id").over(along), "seq": F.row_number().over(along).cast("bigint"),
        "total": F.count(F.lit(1)).over(group)})
    blocks = _history(events)
    assert blocks.dtypes == plain.dtypes
    assert sorted(map(tuple, blocks.collect()), key=repr) == sorted(
        map(tuple, plain.collect()), key=repr)


def test_history_matches_hand_count(events, partitions):
    rows = sorted(_rows(), key=lambda r: (str(r[0]), r[1], r[2]))
    by_id = {r["id"]: r for r in _history(events).collect()}
    for i, (k, _, rid, _) in enumerate(rows):
        before = rows[i - 1] if i and rows[i - 1][0] == k else None
        after = rows[i + 1] if i + 1 < len(rows) and rows[i + 1][0] == k else None
        got = by_id[rid]
        assert got["prev_id"] == (before and before[2])
        assert got["prev_v"] == (before and before[3])
        assert got["next_id"] == (after and after[2])
        assert got["total"] == sum(r[0] == k for r in rows)
        assert got["seq"] == 1 + sum(r[0] == k for r in rows[:i])


def test_large_group_lies_in_many_ordered_blocks(events, partitions):
    blocked = cut(events, ["k"], ["at", "id"])
    assert blocked.count() == 1200
    if partitions == 29:
        assert max(r["count"] for r in blocked.groupBy(BLOCK).count().collect()) < 150
        assert blocked.where("k = 'hot'").select(BLOCK).distinct().count() > 5
    edges = sorted(
        (r[BLOCK], r["lo"], r["hi"]) for r in blocked.filter("k = 'hot'").groupBy(BLOCK).agg(
            F.min(F.struct("at", "id")).alias("lo"), F.max(F.struct("at", "id")).alias("hi")
        ).collect())
    for (_, _, hi), (_, lo, _) in zip(edges, edges[1:]):
        assert tuple(hi) < tuple(lo)


def test_only_groups_in_several_blocks_are_summarised(events, partitions):
    blocked = cut(events, ["k"], ["at", "id"])
    several = {r["k"] for r in blocked.groupBy("k").agg(
        F.count_distinct(BLOCK).alias("n")).where("n > 1").collect()}
    found = border_rows(blocked, ["k"])
    assert {r["k"] for r in found.select("k").distinct().collect()} == several
    assert found.select("k", BLOCK).distinct().count() <= 2 * partitions


def test_empty_table(spark):
    empty = spark.createDataFrame([], "k string, at int, id string, v string")
    assert _history(empty).collect() == []
    assert with_ranks(value_counts(empty, ["k"], "at"), ["k"], "at").collect() == []


def test_one_time_holds_the_whole_group(spark, partitions):
    rows = [("k", 7, f"id{i:04d}", "v") for i in range(500)]
    df = spark.createDataFrame(rows, "k string, at int, id string, v string").repartition(4)
    got = {r["id"]: r for r in _history(df).collect()}
    assert [got[f"id{i:04d}"]["seq"] for i in range(500)] == list(range(1, 501))
    assert got["id0123"]["prev_id"] == "id0122" and got["id0123"]["next_id"] == "id0124"


def _percentiles(df):
    return with_ranks(value_counts(df, ["k"], "x"), ["k"], "x").groupBy("k").agg(
        F.max("_total").alias("n"), F.round(F.max("_mean"), 9).alias("mean"),
        *[percentile_at("x", p).alias(f"p{int(p * 1000)}") for p in (0.025, 0.25, 0.5, 0.9, 0.975)])


def test_percentiles_in_blocks(spark, partitions):
    rnd = random.Random(5)
    rows = [("hot", rnd.gauss(0, 10)) for _ in range(900)]
    rows += [(None, float(rnd.randrange(5))) for _ in range(300)]
    rows += [(f"k{i % 7}", rnd.random()) for i in range(200)] + [("empty", None), ("one", 4.0)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    exact = {r["k"]: list(r)[1:] for r in df.filter("x is not null").groupBy("k").agg(
        F.count("x"), F.round(F.avg("x"), 9),
        *[F.percentile("x", F.lit(p)) for p in (0.025, 0.25, 0.5, 0.9, 0.975)]).collect()}
    got = {r["k"]: list(r)[1:] for r in _percentiles(df).collect()}
    assert got.keys() == exact.keys()
    for k in exact:
        assert got[k] == pytest.approx(exact[k], abs=1e-9)


def test_global_percentile_in_blocks(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 0.5).alias("x"))
    ranked = with_ranks(value_counts(df, [], "x"), [], "x")
    row = ranked.agg(percentile_at("x", 0.9).alias("p"), F.max("_below").alias("b")).first()
    assert row["p"] == pytest.approx(0.9 * 999 * 0.5) and row["b"] == 999
