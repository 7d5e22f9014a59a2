"""Each registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import normal
from weirflow.plans.oracles import ORACLES
from weirflow.plans.queries import QUERIES

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    got = entry.queries()[name](spark, str(FOLDER)).toPandas()
    want = con.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0 and normal(got) == normal(want)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
