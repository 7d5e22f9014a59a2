from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tools.check import normal
from weirflow.llm.queries import ORACLES, QUERIES

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, str(FOLDER)).toPandas()
    assert len(got) > 0
    if name in ORACLES:
        con = duckdb.connect()
        for path in FOLDER.glob("*.parquet"):
            con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        want = con.sql(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and normal(got) == normal(want)


def test_pipeline_keeps_columns_and_packs_what_is_left(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, str(FOLDER)), f"test-{name}")
        assert docs.columns == columns
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left and left <= ids
        ids = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(FOLDER))
    assert {r.doc_id for r in packed.collect()} == ids


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(FOLDER)).count() == 0
