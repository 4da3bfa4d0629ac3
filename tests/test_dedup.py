"""De-duplication by key hashes against the plain first row per key."""

from helpers import plan, rows

from clinflow.operators import dedup_first
from clinflow.operators.dedup import repeated_hashes

SCHEMA = "k string, l bigint, a string, b double"


def _plain(data, order=()):
    """The least row per key, NULL first, as the contract of the operator says."""
    least = {}
    for r in data:
        rank = tuple((v is not None, v) for v in [*[r[i] for i in order], *r[2:]])
        if r[:2] not in least or rank < least[r[:2]][0]:
            least[r[:2]] = (rank, r)
    return sorted((r for _, r in least.values()), key=repr)


def _data():
    data = [(f"k{i}", i % 3, f"a{i % 7}", float(i)) for i in range(300)]
    data += [("hot", 1, f"a{(i * 37) % 100:03d}", float(i % 5)) for i in range(200)]  # a third, differing
    data += [("same", 2, "x", 1.0)] * 50
    data += [(None, None, "z", 1.0), (None, None, "y", None), (None, None, "y", 2.0), (None, 1, None, None)]
    data += [("k1", 1, None, None), ("k2", 2, "", -1.0)]
    return data


def test_survivors_are_the_first_rows(spark):
    data = _data()
    for parts in (1, 7):
        df = spark.createDataFrame(data, SCHEMA).repartition(parts)
        assert rows(dedup_first(df, ["k", "l"])) == _plain(data)
    by_b = sorted(_plain(data, order=(3,)), key=repr)
    assert rows(dedup_first(spark.createDataFrame(data, SCHEMA), ["k", "l"], ["b"])) == by_b


def test_no_copies_all_copies_and_no_rows(spark):
    single = spark.createDataFrame([(f"k{i}", i, "a", 0.0) for i in range(50)], SCHEMA)
    assert rows(dedup_first(single, ["k", "l"])) == rows(single)
    one = spark.createDataFrame([("k", 1, "a", 0.0)] * 100, SCHEMA)
    assert rows(dedup_first(one, ["k", "l"])) == [("k", 1, "a", 0.0)]
    assert dedup_first(spark.createDataFrame([], SCHEMA), ["k", "l"]).count() == 0
    assert rows(dedup_first(one, one.columns)) == [("k", 1, "a", 0.0)]


def test_rows_without_copies_are_not_shuffled_or_sorted(spark, tmp_path):
    spark.createDataFrame(_data(), SCHEMA).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    text = plan(dedup_first(stored, ["k", "l"]))
    assert "SortAggregate" not in text and "SortMergeJoin" not in text
    single, copies = text.split("Union")[1].split("Window", 1)
    assert "Exchange hashpartitioning" not in single and "Sort " not in single
    # Every task keeps one row per key before the shuffle.
    assert copies.count("WindowGroupLimit") == 2
    keys = plan(repeated_hashes(stored, ["k", "l"]))
    assert "SortAggregate" not in keys and "partial_count" in keys
    assert "ReadSchema: struct<k:string,l:bigint>" in keys
