"""Every registered query against its SQL on the smallest data."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from clinflow.oracles import ORACLES
from clinflow.registry import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _sorted(columns, names, data):
    order = [names.index(c) for c in columns]
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def test_registry_is_complete():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


# Queries over texts have no SQL form and tests of their own.
@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, str(DATA))
    data = df.collect()
    assert data
    expected = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(df.columns)
    columns = sorted(names)
    assert _sorted(columns, df.columns, data) == _sorted(columns, names, expected.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
